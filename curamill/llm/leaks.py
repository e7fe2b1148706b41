"""Evaluation passages inside training documents, by winnowed fingerprints and exact extension."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curamill.functions.skew import join_unique
from curamill.llm.words import WordHasher, gram_hashes, words
from curamill.session import settle

_SCHEMA = "doc bigint, item bigint, n_words int, doc_word int, item_word int"


@dataclass(frozen=True)
class Winnow:
    """Every shared run of at least ``min_words`` words is found: fingerprints are the least ``k``-gram hash in each
    window of ``min_words - k + 1``. Items up to ``broadcast_bytes`` of text go to every executor; beyond, documents
    and items meet in a shuffle join."""

    min_words: int = 12
    k: int = 6
    broadcast_bytes: int = 32 << 20

    def __post_init__(self):
        if not 1 <= self.k <= self.min_words:
            raise ValueError("k must lie between 1 and min_words")


def fingerprints(hashes: np.ndarray, options: Winnow) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the fingerprints of a text given as word hashes."""
    k, window = options.k, options.min_words - options.k + 1
    grams = gram_hashes(hashes, k)
    n = len(grams)
    if n < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least = np.lib.stride_tricks.sliding_window_view(grams, window).argmin(axis=1) + np.arange(n - window + 1)
    at = np.unique(least)
    return at, grams[at]


def longest_runs(doc: list[str], hits: list[tuple[int, int, int]], items: dict[int, list[str]], least: int) -> dict[int, tuple[int, int, int]]:
    """For each item its longest run shared with the document: (words, start in document, start in item). ``hits``:
    (document position, item, item position) of matching fingerprints; equal hashes are checked word by word."""
    best: dict[int, tuple[int, int, int]] = {}
    done: dict[tuple[int, int], int] = {}
    for d, item, i in hits:
        if done.get((item, d - i), -1) > d:
            continue
        other = items[item]
        a, b = d, i
        while a > 0 and b > 0 and doc[a - 1] == other[b - 1]:
            a, b = a - 1, b - 1
        e, f = d, i
        while e < len(doc) and f < len(other) and doc[e] == other[f]:
            e, f = e + 1, f + 1
        done[item, d - i] = e
        if e - a >= least and (e - a, -a, -b) > (lambda x: (x[0], -x[1], -x[2]))(best.get(item, (0, 0, 0))):
            best[item] = (e - a, a, b)
    return best


def _index(rows: list[tuple[int, str]], options: Winnow) -> tuple[np.ndarray, list[list[tuple[int, int]]], dict[int, list[str]]]:
    hasher, items, by_hash = WordHasher(), {}, {}
    for item, text in rows:
        run = words(text)
        if len(run) < options.min_words:
            continue
        items[item] = run
        for at, h in zip(*(x.tolist() for x in fingerprints(hasher(run), options))):
            by_hash.setdefault(h, []).append((item, at))
    keys = np.array(sorted(by_hash), dtype=np.uint64)
    return keys, [by_hash[k] for k in keys.tolist()], items


def _batch(found: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *[pa.array(c, pa.int32()) for c in columns[2:]]], ["doc", "item", "n_words", "doc_word", "item_word"])


_held: list = []  # of this Python worker: the items it last saw and their index


def _held_index(rows: list[tuple[int, str]], options: Winnow) -> tuple[np.ndarray, list[list[tuple[int, int]]], dict[int, list[str]]]:
    """The index of a broadcast value, made once a worker and not once a task."""
    if not _held or _held[0] is not rows or _held[1] != options:
        _held[:] = [rows, options, _index(rows, options)]
    return _held[2]


def _by_broadcast(documents: DataFrame, items: DataFrame, options: Winnow) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast([(r["item"], r["text"]) for r in items.collect()])  # size was checked

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, places, runs = _held_index(shared.value, options)
        hasher = WordHasher()
        for batch in batches:
            found = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                run = words(text)
                at, marks = fingerprints(hasher(run), options)
                if not len(at) or not len(keys):
                    continue
                slot = np.minimum(np.searchsorted(keys, marks), len(keys) - 1)
                hit = np.flatnonzero(keys[slot] == marks)
                if not len(hit):
                    continue
                hits = [(int(at[x]), item, i) for x in hit for item, i in places[slot[x]]]
                found += [(doc, item, *run_at) for item, run_at in longest_runs(run, hits, runs, options.min_words).items()]
            yield _batch(found)

    return documents.mapInArrow(scan, _SCHEMA)


def _marks(df: DataFrame, options: Winnow, names: tuple[str, str]) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            ids, at_all, marks_all = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, marks = fingerprints(hasher(words(text)), options)
                ids += [key] * len(at)
                marks_all.append(marks.view(np.int64))
            marks = np.unique(np.column_stack([np.array(ids, np.int64), np.concatenate(marks_all or [np.empty(0, np.int64)])]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(marks[:, 0]), pa.array(marks[:, 1])], list(names))

    return df.mapInArrow(scan, f"{names[0]} bigint, {names[1]} bigint")


def _by_shuffle(documents: DataFrame, items: DataFrame, options: Winnow) -> DataFrame:
    # A mark in many documents, and an item or document in many pairs, are hot keys of the left sides.
    of_items = settle(_marks(items, options, ("item", "mark")).distinct(), "item_marks")
    of_docs = settle(_marks(documents, options, ("doc", "mark")).join(of_items.select("mark").distinct(), "mark", "left_semi"), "doc_marks")
    pairs = settle(join_unique(of_docs, of_items, ["mark"], "inner").select("doc", "item").distinct(), "pairs")
    both = join_unique(pairs, items.select("item", F.col("text").alias("item_text")), ["item"], "inner")
    both = join_unique(both, documents, ["doc"], "inner")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            found = []
            for doc, item, item_text, text in zip(*(batch.column(n).to_pylist() for n in ("doc", "item", "item_text", "text"))):
                keys, places, runs = _index([(item, item_text)], options)
                run = words(text)
                at, marks = fingerprints(hasher(run), options)
                slot = np.minimum(np.searchsorted(keys, marks), len(keys) - 1)
                hits = [(int(at[x]), i, p) for x in np.flatnonzero(keys[slot] == marks) for i, p in places[slot[x]]]
                found += [(doc, i, *run_at) for i, run_at in longest_runs(run, hits, runs, options.min_words).items()]
            yield _batch(found)

    return both.select("doc", "item", "item_text", "text").mapInArrow(extend, _SCHEMA)


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", options: Winnow = Winnow()) -> DataFrame:
    """One row per document and item that share at least ``min_words`` consecutive words: the length of their longest
    shared run in words and where it starts, in words, in the document and in the item. Of equally long runs the
    first in the document counts.

    Case, punctuation, line breaks and Unicode composition don't matter. Null or empty texts, rows with a null id and
    texts under ``min_words`` words match nothing. Repeated rows give one row; where several documents have one id,
    the longest run counts. Only the named columns are read, so extra columns may have any names. Ids must be whole numbers.
    Documents pass once, without a shuffle, while the items' size allows a broadcast.
    """
    docs = documents.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).filter("doc IS NOT NULL AND text IS NOT NULL")
    tests = items.select(F.col(item_id).cast("bigint").alias("item"), F.col(text).alias("text")).filter("item IS NOT NULL AND text IS NOT NULL")
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = _by_broadcast(docs, tests, options) if size <= options.broadcast_bytes else _by_shuffle(docs, tests, options)
    best = found.groupBy("doc", "item").agg(F.min(F.struct((-F.col("n_words")).alias("n"), "doc_word", "item_word")).alias("b"))
    return best.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), (-F.col("b.n")).alias("n_words"), "b.doc_word", "b.item_word")
