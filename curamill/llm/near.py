"""Near-duplicate texts: banded MinHash candidates, checked with odd sketches."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from curamill.functions.columns import fenced
from curamill.functions.skew import hot_keys, join_unique
from curamill.llm.words import WordHasher, gram_hashes, mixed, words
from curamill.operators.components import connected_components
from curamill.session import settle


@dataclass(frozen=True)
class Sketching:
    """Texts are sets of runs of ``shingle`` words, alike from a Jaccard similarity of ``threshold`` on.

    ``bands`` x ``rows`` MinHash samples make the candidates. Estimates within ``margin`` of the threshold are decided
    exactly. Buckets beyond ``bucket`` members are compared block by block instead of by a join. ``seed`` fixes the hashes."""

    shingle: int = 5
    threshold: float = 0.8
    bands: int = 40
    rows: int = 4
    bits: int = 1024
    margin: float = 0.15
    bucket: int = 100
    block: int = 512
    seed: int = 7

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def words(self) -> int:
        return self.bits // 64

    def estimate(self, differing: float) -> float:
        """Similarity of two sets whose sketches differ in so many bits."""
        share = 2 * differing / self.bits
        return -1.0 if share >= 1 else 1 + self.bits / (4 * self.samples) * math.log1p(-share)

    def most_differing(self, similarity: float) -> int:
        """The most bits in which the sketches of sets of at least this similarity may differ, by estimate."""
        return int(self.bits / 2 * (1 - math.exp(4 * self.samples / self.bits * (similarity - 1))))


@dataclass
class NearDuplicates:
    """``members``: (id, class_id), a class being the texts with one shingle set, named by its lowest id; texts too
    short for a shingle have a null class. ``links``: (class_a, class_b, similarity) of different classes that are alike."""

    members: DataFrame
    links: DataFrame

    def groups(self) -> DataFrame:
        """A row per id: its class, the classes linked to that class, and its group, named by the group's lowest class."""
        found = connected_components(self.links, "class_a", "class_b")
        ends = self.links.select(F.col("class_a").alias("class_id")).union(self.links.select("class_b"))
        facts = found.select(F.col("node").alias("class_id"), F.col("component").alias("group_id")).join(ends.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links")), "class_id")
        out = join_unique(self.members, facts, ["class_id"], "left")
        return out.select("id", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


class Sketcher:
    """MinHash bands and odd sketch of shingle sets."""

    def __init__(self, options: Sketching):
        rng = np.random.default_rng(options.seed)
        k = options.samples
        self.options = options
        self.a = rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, k, dtype=np.uint64)
        self.salt = rng.integers(0, 2**63, k, dtype=np.uint64)
        self.hasher = WordHasher()

    def grams(self, text: str) -> np.ndarray:
        return np.unique(gram_hashes(self.hasher(words(text)), self.options.shingle))

    def __call__(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        o = self.options
        least = np.full(o.samples, np.iinfo(np.uint64).max, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(0, len(grams), 512):
                np.minimum(least, (self.a[:, None] * grams[None, i : i + 512] + self.b[:, None]).min(axis=1), out=least)
            marked = mixed(least ^ self.salt)
            rows = marked.reshape(o.bands, o.rows)
            keys = np.zeros(o.bands, np.uint64)
            for j in range(o.rows):
                keys = mixed(keys * np.uint64(31) + rows[:, j])
        flips = np.bincount((marked >> np.uint64(40)).astype(np.int64) % o.bits, minlength=o.bits) & 1
        return keys.view(np.int64), np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def _signatures(docs: DataFrame, options: Sketching) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(options)
        for batch in batches:
            ids, names, sizes, bands, sketches = [], [], [], [], []
            last: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
            for key, text in zip(batch.column(0), batch.column(1).to_pylist()):
                grams = sketcher.grams(text or "")
                ids.append(key.as_py())
                sizes.append(len(grams))
                if not len(grams):
                    names.append(None)
                    bands.append(None)
                    sketches.append(None)
                    continue
                name = xxhash.xxh3_128_digest(grams.tobytes())
                if name not in last:
                    last[name] = sketcher(grams)
                names.append(name)
                bands.append(last[name][0])
                sketches.append(last[name][1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.column(0).type), pa.array(names, pa.binary()), pa.array(sizes, pa.int32()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())), batch.column(2)],
                ["id", "cls", "size", "bands", "sketch", "text_key"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text", F.md5("text").alias("text_key")).mapInArrow(scan, f"id {kind}, cls binary, size int, bands array<bigint>, sketch array<bigint>, text_key string")


def _differing(x: str, y: str, options: Sketching) -> Column:
    """In how many bits two sketches differ; spelled out word by word, which stays in generated code."""
    return reduce(Column.__add__, [F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(options.words)])


def _from_large_buckets(large: DataFrame, classes: DataFrame, options: Sketching) -> DataFrame:
    """Pairs of buckets too large for a join: members fall into blocks, each pair of blocks is a task of bounded size
    that compares sketches and gives only pairs that may be alike."""
    blocks = F.ceil(F.col("n") / options.block).cast("int")
    own = F.pmod(F.xxhash64("c"), blocks).cast("int")
    facts = join_unique(large.select("band", "c", own.alias("own"), blocks.alias("blocks")), classes.select("c", "size", "sketch"), ["c"], "inner")
    spread = facts.select("band", "c", "own", "size", "sketch", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    spread = spread.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "c", "size", "sketch")
    most = options.most_differing(options.threshold - options.margin)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        i, j = group["i"].iloc[0], group["j"].iloc[0]
        left, right = group[group["own"] == i], group[group["own"] == j]
        found_a, found_b = [], []
        if len(left) and len(right):
            x, y = (np.stack(g["sketch"].to_list()).view(np.uint64) for g in (left, right))
            names, sizes = right["c"].to_numpy(), right["size"].to_numpy()
            for row, name, size in zip(x, left["c"], left["size"]):
                near = np.minimum(sizes, size) >= options.threshold * np.maximum(sizes, size)
                at = np.flatnonzero(near)
                at = at[np.bitwise_count(y[at] ^ row).sum(axis=1) <= most]
                for other in names[at]:
                    if name < other or (i != j and name > other):
                        found_a.append(min(name, other))
                        found_b.append(max(name, other))
        return pd.DataFrame({"a": np.array(found_a, np.int64), "b": np.array(found_b, np.int64)})

    return spread.groupBy("band", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(df: DataFrame, doc_id: str, text: str = "text", options: Sketching = Sketching()) -> NearDuplicates:
    """Find all texts whose sets of ``shingle``-word runs overlap by ``threshold`` or more (those in both divided by
    those in either), words being runs of letters or digits, case aside.

    Texts with equal sets are folded into a class first, so copies cost nothing after one map-side combined
    aggregation. Classes sharing a MinHash band are candidates; the odd sketches of their samples (parities of hashed
    samples) are XORed, and the population count estimates the similarity. Only estimates within ``margin`` of the
    threshold are settled on the texts themselves. Every candidate is examined: there is no cap on partners, and
    buckets too large for a join are compared in blocks of bounded size.

    Rows with a null id are left out. Null, empty and very short texts (no shingle) get a null class and no link.
    Repeated rows fall into one class; an id with several texts is a member of each one's class. Only the named
    columns are read, so extra columns may have any names. An empty table gives empty results.
    """
    docs = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter("id IS NOT NULL")
    signed = settle(_signatures(docs, options), "signatures")
    classes = signed.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n"), F.any_value("size").alias("size"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"), F.any_value("text_key").alias("text_key")
    )
    classes = settle(classes.withColumn("c", F.monotonically_increasing_id()), "classes")

    near = _estimated(classes, options)
    sure = F.col("similarity") >= options.threshold + options.margin
    decided = near.filter(sure).select("a", "b", "similarity").unionByName(_decided(near.filter(~sure), classes, docs, options))
    named = settle(decided, "decided")
    hot = {end: hot_keys(named, None, [end]) for end in ("a", "b")}
    for end in ("a", "b"):
        named = join_unique(named, classes.select(F.col("c").alias(end), F.col("class_id").alias(f"class_{end}")), [end], "inner", hot=hot[end])
    links = named.select(F.least("class_a", "class_b").alias("class_a"), F.greatest("class_a", "class_b").alias("class_b"), "similarity")
    members = join_unique(signed.select("id", "cls"), classes.select("cls", "class_id", "n"), ["cls"], "left", sizes="n").select("id", "class_id").distinct()
    return NearDuplicates(members, settle(links, "links"))


def _estimated(classes: DataFrame, options: Sketching) -> DataFrame:
    """(a, b, similarity) of the candidate classes whose sketches say that they may be alike, settled."""
    rows = classes.select("c", F.explode("bands").alias("band"))
    shared = settle(rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared")
    rows = settle(join_unique(rows, shared, ["band"], "inner", sizes="n"), "bands")
    small = rows.filter(F.col("n") <= options.bucket)
    pairs = small.select("band", F.col("c").alias("a")).join(small.select("band", F.col("c").alias("b")), "band").filter("a < b").select("a", "b")
    large = rows.filter(F.col("n") > options.bucket)
    if large.limit(1).count():
        pairs = pairs.unionByName(_from_large_buckets(large, classes, options))
    pairs = settle(pairs.distinct(), "pairs")

    side = classes.select("c", "size", "sketch")
    hot = {end: hot_keys(pairs, None, [end]) for end in ("a", "b")}
    for end in ("a", "b"):
        pairs = join_unique(pairs, side.select(F.col("c").alias(end), F.col("size").alias(f"size_{end}"), F.col("sketch").alias(f"sketch_{end}")), [end], "inner", hot=hot[end])
    pairs = pairs.filter(F.least("size_a", "size_b") >= options.threshold * F.greatest("size_a", "size_b"))
    pairs = pairs.select("a", "b", _differing("sketch_a", "sketch_b", options).alias("differing")).filter(F.col("differing") <= options.most_differing(options.threshold - options.margin))
    estimate = F.greatest(F.lit(0.0), 1 + F.lit(options.bits / (4 * options.samples)) * F.log1p(-2 * F.col("differing") / options.bits))
    return settle(pairs.select("a", "b", estimate.alias("similarity")), "near")


def _decided(doubtful: DataFrame, classes: DataFrame, docs: DataFrame, options: Sketching) -> DataFrame:
    """(a, b, similarity) of those pairs whose texts are alike."""
    wanted = doubtful.select(F.col("a").alias("c")).union(doubtful.select("b")).distinct()
    keys = settle(classes.select("c", "text_key").join(wanted, "c", "left_semi"), "keys")  # its size is known, so texts are only shuffled if they are many
    once = docs.select(F.md5("text").alias("text_key"), "text").join(keys, "text_key").groupBy("c").agg(F.any_value("text").alias("text"))
    texts = settle(once, "texts")
    hot = {end: hot_keys(doubtful, None, [end]) for end in ("a", "b")}
    for end in ("a", "b"):
        doubtful = join_unique(doubtful, texts.select(F.col("c").alias(end), F.col("text").alias(f"text_{end}")), [end], "inner", hot=hot[end])

    @F.arrow_udf("double")
    def exact(x: pa.Array, y: pa.Array) -> pa.Array:
        sketcher, out, last = Sketcher(options), [], {}
        for s, t in zip(x.to_pylist(), y.to_pylist()):
            last = {v: last[v] if v in last else sketcher.grams(v) for v in (s, t)}
            p, q = last[s], last[t]
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(both / (len(p) + len(q) - both))
        return pa.array(out, pa.float64())

    settled = fenced(doubtful.select("a", "b", "text_a", "text_b"), similarity=exact("text_a", "text_b"))
    return settled.select("a", "b", "similarity").filter(F.col("similarity") >= options.threshold)


def expand(found: NearDuplicates, block: int = 4096) -> DataFrame:
    """Every pair of different ids that are alike, (a, b) with a < b: within classes and across links. A class of many
    copies is cut into blocks of about ``block`` members, each with the class's other blocks in a task of its own."""
    members = settle(found.members.filter("class_id IS NOT NULL"), "members")
    sizes = settle(members.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")), "sizes").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    several = settle(join_unique(members, sizes.filter("n > 1"), ["class_id"], "inner", sizes="n").withColumn("part", F.pmod(F.xxhash64("id"), "blocks")), "several")
    left = several.select("class_id", "part", F.col("id").alias("a"), every("blocks").alias("other"))
    right = several.select("class_id", F.col("part").alias("other"), F.col("id").alias("b"), every("blocks").alias("part"))
    same = left.join(right, ["class_id", "part", "other"]).select("a", "b")

    one = join_unique(members, sizes, ["class_id"], "inner", sizes="n").withColumn("part", F.pmod(F.xxhash64("id"), "blocks"))
    ends = found.links.select("class_a", "class_b")
    hot = {end: hot_keys(ends, None, [f"class_{end}"]) for end in ("a", "b")}
    for end in ("a", "b"):
        ends = join_unique(ends, sizes.select(F.col("class_id").alias(f"class_{end}"), F.col("blocks").alias(f"blocks_{end}")), [f"class_{end}"], "inner", hot=hot[end]).withColumn(f"part_{end}", every(f"blocks_{end}"))
    for end, name in (("a", "x"), ("b", "y")):
        ends = ends.join(one.select(F.col("class_id").alias(f"class_{end}"), F.col("part").alias(f"part_{end}"), F.col("id").alias(name)), [f"class_{end}", f"part_{end}"])
    across = ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return same.unionByName(across).filter("a < b").distinct()
