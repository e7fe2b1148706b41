"""Splitting oversized texts at natural boundaries, with a stated overlap."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from curamill.functions.columns import fenced, make_room

# Strength of a place where a piece may begin; a sentence start or better counts as clean.
NONE, SPACE, CLAUSE, LINE, SENTENCE, PARAGRAPH = range(6)
_PLACES = (
    (SPACE, regex.compile(r"\s+")),
    (CLAUSE, regex.compile(r"[,;:]\s+|[、，；：]")),
    (LINE, regex.compile(r"\n\s*")),
    (SENTENCE, regex.compile(r"(?<![\p{Lu}]|\b\p{Lu}\p{Ll}{1,2}|\.\p{L})[.!?…]+[\"'»”’)\]]*\s+(?=[\"'«„“‘(\[¿¡]*\s?(?:\p{Lu}|\p{Lo}))|[。！？।]+[」』”’）\"]*\s*")),
    (PARAGRAPH, regex.compile(r"\n[^\S\n]*\n\s*")),
)
NAMES = ("hard", "space", "clause", "line", "sentence", "paragraph")
OUTPUTS = ("piece_index", "piece_count", "piece_start", "piece_end", "overlap_chars", "piece_tokens", "starts_at", "ends_at", "piece_text")
_PIECE = pa.struct([("piece_start", pa.int32()), ("piece_end", pa.int32()), ("overlap_chars", pa.int32()), ("starts_at", pa.string()), ("ends_at", pa.string())])


@dataclass(frozen=True)
class Limits:
    """A text's tokens are its characters divided by ``chars_per_token``, rounded down. ``overlap_tokens`` is the
    least overlap of consecutive pieces; a piece starts at the nearest clean place before that, at most ``overlap_reach``
    times as far back. ``max_bytes`` (of UTF-8) is a second limit, off by default."""

    max_tokens: int = 1000
    overlap_tokens: int = 50
    chars_per_token: int = 4
    overlap_reach: int = 3
    max_bytes: int | None = None

    def __post_init__(self):
        if self.max_tokens < 1 or self.overlap_tokens < 0 or self.chars_per_token < 1 or self.overlap_reach < 1:
            raise ValueError("limits must be positive")
        if self.overlap_tokens * self.overlap_reach * 2 > self.max_tokens:
            raise ValueError("overlap_tokens * overlap_reach may be half of max_tokens at most")
        if self.max_bytes is not None and self.max_bytes < 8 * (self.overlap + 1) * self.overlap_reach:
            raise ValueError("max_bytes is too small for this overlap")

    @property
    def max_chars(self) -> int:
        return (self.max_tokens + 1) * self.chars_per_token - 1

    @property
    def overlap(self) -> int:
        return self.overlap_tokens * self.chars_per_token


def _strengths(text: str) -> np.ndarray:
    at = np.zeros(len(text) + 1, dtype=np.int8)
    for strength, pattern in _PLACES:
        at[[m.end() for m in pattern.finditer(text)]] = strength
    at[0] = at[len(text)] = PARAGRAPH
    return at


def _unbroken(text: str, at: int) -> int:
    """``at``, moved back so that a character keeps its marks and joiners."""
    k = at
    while 0 < k < len(text) and at - k < 16 and (unicodedata.category(text[k])[0] == "M" or text[k] == "‍" or text[k - 1] == "‍"):
        k -= 1
    return k if k > 0 else at


def _nearest(at: np.ndarray, lo: int, hi: int, target: int, clean: bool) -> int | None:
    """The strongest place in [lo, hi], of equals the nearest to ``target``; with ``clean``, every clean place is equal."""
    if lo > hi:
        return None
    window = np.minimum(at[lo : hi + 1], SENTENCE) if clean else at[lo : hi + 1]
    best = window.max()
    if best == NONE:
        return None
    found = np.flatnonzero(window == best) + lo
    return int(found[np.abs(found - target).argmin()])


def _bytes(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass"))


def cuts(text: str, limits: Limits) -> list[tuple[int, int, int, int, int]]:
    """(start, end, overlap with the piece before, strength at start, strength at end) of each piece of ``text``.

    The fewest pieces that can do are tried first: equal-length targets, each snapped to the strongest boundary near
    it; while a piece breaks a limit, one more piece is tried. Texts without boundaries are cut at the targets.
    """
    size, most, overlap, back = len(text), limits.max_chars, limits.overlap, limits.overlap * limits.overlap_reach

    def fits(piece: str) -> bool:
        return len(piece) <= most and (limits.max_bytes is None or _bytes(piece) <= limits.max_bytes)

    if fits(text):
        return [(0, size, 0, PARAGRAPH, PARAGRAPH)]
    at = _strengths(text)
    fewest = -(-(size - overlap) // (most - overlap))
    if limits.max_bytes is not None:
        fewest = max(fewest, -(-_bytes(text) // limits.max_bytes))
    for n in range(max(2, fewest), 4 * max(2, fewest) + 9):
        length = size / n
        slack = int(min(length * 0.3, max(0, most - length) + length * 0.1))
        pieces, start, ok = [], 0, True
        since, shared = PARAGRAPH, 0
        for i in range(1, n + 1):
            if i == n:
                end = size
            else:
                target = round(i * length)
                floor = max(start + back, start + 1)
                end = _nearest(at, max(floor, target - slack), min(size - 1, target + slack, start + most), target, False)
                if end is None:
                    end = _unbroken(text, min(target, start + most, size - 1))
            if not fits(text[start:end]) or end <= start:
                ok = False
                break
            pieces.append((start, end, shared, since, int(at[end])))
            if i < n:
                wanted = end - overlap
                start_next = _nearest(at, max(start + 1, end - back), wanted, wanted, True) if overlap else end
                if start_next is None or (at[start_next] < LINE and wanted - start_next > overlap // 2):
                    start_next = _unbroken(text, wanted) if at[max(0, wanted)] == NONE else wanted
                if start_next <= start:
                    ok = False
                    break
                start, since, shared = start_next, int(at[start_next]), end - start_next
        if ok:
            return pieces
    # Limits so tight that boundaries cannot be kept: plain strides, still under every limit and overlapping.
    stride = most if limits.max_bytes is None else min(most, limits.max_bytes // 4)
    pieces, start, shared = [], 0, 0
    while True:
        end = size if start + stride >= size else _unbroken(text, start + stride)
        pieces.append((start, end, shared, int(at[start]), int(at[end])))
        if end == size:
            return pieces
        start_next = max(start + 1, end - min(overlap, stride // 2))
        start, shared = start_next, end - start_next


def split_oversized(df: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """One row per piece: the input's columns and ``piece_index`` (from 0), ``piece_count``, ``piece_start`` and
    ``piece_end`` (characters of the text), ``overlap_chars`` shared with the piece before, ``piece_tokens``,
    ``starts_at`` and ``ends_at`` (the kind of boundary, ``hard`` where there was none) and ``piece_text``.

    Only texts over a limit reach Python; all others pass as one piece inside the JVM, and nothing is shuffled.
    Null texts give one piece with null text, null tokens and bounds 0; empty texts one empty piece. Repeated rows
    are split each for itself, so ties and duplicates need no rule. Input columns named like an output come out as
    ``<name>_input``. An empty table gives an empty result.
    """
    df = make_room(df, OUTPUTS, keep=[text])
    large = F.length(text) > limits.max_chars
    if limits.max_bytes is not None:
        large = large | (F.octet_length(text) > limits.max_bytes)

    @F.arrow_udf("array<struct<piece_start:int,piece_end:int,overlap_chars:int,starts_at:string,ends_at:string>>")
    def cut(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts.to_pylist():
            rows.append(None if value is None else [{"piece_start": a, "piece_end": b, "overlap_chars": o, "starts_at": NAMES[p], "ends_at": NAMES[q]} for a, b, o, p, q in cuts(value, limits)])
        return pa.array(rows, pa.list_(_PIECE))

    whole = df.filter(~F.coalesce(large, F.lit(False))).select(
        "*",
        F.lit(0).alias("piece_index"),
        F.lit(1).alias("piece_count"),
        F.lit(0).alias("piece_start"),
        F.coalesce(F.length(text), F.lit(0)).alias("piece_end"),
        F.lit(0).alias("overlap_chars"),
        F.floor(F.length(text) / limits.chars_per_token).cast("int").alias("piece_tokens"),
        F.lit("paragraph").alias("starts_at"),
        F.lit("paragraph").alias("ends_at"),
        F.col(text).alias("piece_text"),
    )
    own = df.columns
    parts = fenced(df.filter(large), __cuts=cut(F.col(text)))
    parts = parts.select(*own, F.size("__cuts").alias("piece_count"), F.posexplode("__cuts").alias("piece_index", "__c"))
    length = F.col("__c.piece_end") - F.col("__c.piece_start")
    parts = parts.select(
        *own,
        "piece_index",
        "piece_count",
        "__c.piece_start",
        "__c.piece_end",
        "__c.overlap_chars",
        F.floor(length / limits.chars_per_token).cast("int").alias("piece_tokens"),
        "__c.starts_at",
        "__c.ends_at",
        F.substring(F.col(text), F.col("__c.piece_start") + 1, length).alias("piece_text"),
    )
    return whole.unionByName(parts)
