"""Text kernel: Column functions, all but the language built of Spark's own. Lengths and positions count code points."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from curamill.functions import lexicons as L


#: The characters of ``lexicons.BLANK``.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_LETTERS = re.compile(r"[^\W\d_]+")
_OF_WORD = {w: [v for v, listed in L.LANGUAGE_WORDS.items() if w in listed] for listed in L.LANGUAGE_WORDS.values() for w in listed}
_KANA, _HAN = re.compile("[\u3040-\u30ff]"), re.compile("[\u4e00-\u9fff]")


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: str | Column) -> Column:
    """Without blanks at both ends, as Python strips them."""
    return F.btrim(_c(x), F.lit(BLANKS))


def fields(x: str | Column) -> Column:
    """Words between blanks."""
    return F.filter(F.split(_c(x), f"{L.BLANK}+"), lambda w: w != "")


def tokens(x: str | Column) -> Column:
    """Runs of letters or digits, and single other marks."""
    return F.regexp_extract_all(_c(x), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"), F.lit(0))


def letters_only(x: Column) -> Column:
    """The alphabetic tokens among ``x``."""
    return F.filter(x, lambda w: w.rlike(r"^\p{L}+$"))


def sentences(x: str | Column) -> Column:
    """Stretches ending in ``.``, ``!`` or ``?`` before a blank; stripped, without empty ones."""
    marked = F.regexp_replace(_c(x), r"([.!?]+)\s+", "$1\x01")
    return F.filter(F.transform(F.split(marked, "\x01"), strip), lambda s: s != "")


def ratio_removed(x: str | Column, kept: str) -> Column:
    """Share of characters left after removing those in the class ``kept``; null for an empty text."""
    c = _c(x)
    return F.when(F.length(c) > 0, F.length(F.regexp_replace(c, kept, "")) / F.length(c))


def special_ratio(x: str | Column) -> Column:
    """Share of characters neither alphanumeric nor blank."""
    return ratio_removed(x, r"[\p{L}\p{N}\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0b}\x{1c}-\x{1f}]")


def non_ascii_ratio(x: str | Column) -> Column:
    return ratio_removed(x, r"[\x{00}-\x{7f}]")


def comparable(x: str | Column) -> Column:
    """Lower case, one blank between words, without marks: the form texts are compared in."""
    c = F.regexp_replace(F.lower(_c(x)), f"{L.BLANK}+", " ")
    return strip(F.regexp_replace(c, r"[^\p{L}\p{M}\p{N}_ ]", ""))


def content_hash(x: str | Column) -> Column:
    return F.md5(comparable(x))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, even where a lambda inside uses it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def windows(items: Column, k: int, joined: str) -> Column:
    """Distinct runs of ``k`` neighbouring strings; empty for shorter arrays, null for null."""
    empty = F.array().cast("array<string>")
    run = lambda a: F.transform(F.sequence(F.lit(1), F.size(a) - k + 1), lambda i: F.concat_ws(joined, *[F.element_at(a, i + j) for j in range(k)]))
    return F.when(items.isNotNull(), let(items, lambda a: F.when(F.size(a) >= k, F.array_distinct(run(a))).otherwise(empty)))


def char_shingles(x: Column, k: int = 3) -> Column:
    """Distinct runs of ``k`` characters; empty for shorter texts."""
    return windows(F.filter(F.split(x, ""), lambda v: v != ""), k, "")


def word_shingles(x: Column, k: int = 5) -> Column:
    """Distinct runs of ``k`` words of a comparable text; empty for shorter ones."""
    return windows(F.filter(F.split(x, " +"), lambda v: v != ""), k, " ")


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays of distinct values; null if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) > 0, both / (F.size(a) + F.size(b) - both))


def approx_tokens(x: str | Column) -> Column:
    """Characters divided by four, rounded down."""
    return F.floor(F.length(_c(x)) / 4).cast("int")


def clamp(x: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def language_of(text: str) -> str:
    """The language of one text."""
    if not text.isascii():
        kana, han = len(_KANA.findall(text)), len(_HAN.findall(text))
        if (kana + han) * 4 > len(text):
            return "ja" if kana * 5 > han else "zh"
    counts = dict.fromkeys(L.LANGUAGE_WORDS, 0)
    for word in _LETTERS.findall(text.lower()):
        # Numerals beyond the digits stand between letters, too; they part words.
        for w in (word,) if word in _OF_WORD or word.isalpha() else "".join(c if c.isalpha() else " " for c in word).split():
            for v in _OF_WORD.get(w, ()):
                counts[v] += 1
    best = max(counts, key=counts.get)
    return best if counts[best] else "unknown"


@F.arrow_udf(T.StringType())
def _languages(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else language_of(t) for t in texts.to_pylist()], pa.string())


def language(x: str | Column) -> Column:
    """en, fr, de or es by its function words, ja or zh by script, ``unknown`` otherwise. Of equal counts the first
    in that order wins."""
    return _languages(_c(x))
