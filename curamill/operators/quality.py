"""Document quality: five families of scores between 0 and 1, a weighted composite, a category and a verdict."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from curamill.functions import lexicons as L
from curamill.functions.columns import fenced, make_room
from curamill.session import settle

FAMILIES = ("readability", "coherence", "information_density", "completeness", "linguistic_quality")
WEIGHTS = {"readability": 0.20, "coherence": 0.25, "information_density": 0.25, "completeness": 0.15, "linguistic_quality": 0.15}
DETAILS = ("flesch_reading_ease", "flesch_kincaid_grade", "avg_sentence_length", "transition_ratio", "lexical_cohesion", "length_variance", "lexical_diversity", "content_word_ratio", "avg_word_length", "number_ratio", "ends_properly", "has_truncation", "has_conclusion", "capitalization_ratio", "words_per_sentence", "alpha_ratio")
RESULTS = ("composite_score", "category", "passes_threshold", "weakest_metric", "weakest_score")
COUNTS = ("n_sentences", "n_tokens", "n_words")
_FLAGS = ("ends_properly", "has_truncation", "has_conclusion")
_ARROW = pa.struct([(d, pa.bool_() if d in _FLAGS else pa.float64()) for d in DETAILS] + [(c, pa.int32()) for c in COUNTS])
_KIND = T.StructType([T.StructField(d, T.BooleanType() if d in _FLAGS else T.DoubleType()) for d in DETAILS] + [T.StructField(c, T.IntegerType()) for c in COUNTS])
_SENTENCE_END = re.compile(r"([.!?]+)[ \t\n\x0b\f\r]+")
_TOKEN = re.compile(r"[^\W_]+|[^ \t\n\x0b\f\r]")
_VOWELS = re.compile("[aeiouyàâäéèêëîïôöùûüáíóúñ]+")
_TRANSITION_PHRASES = re.compile("|".join(L.TRANSITION_PHRASES))
_TRUNCATION = re.compile(L.TRUNCATION.replace(r"\z", r"\Z"))
_CONCLUSIONS = re.compile("|".join(L.CONCLUSIONS))
_STOP, _TRANSITIONS, _DIGITS = frozenset(L.STOP_WORDS), frozenset(L.TRANSITIONS), frozenset("0123456789")


@lru_cache(maxsize=1 << 17)
def _syllables(word: str) -> int:
    return max(1, len(_VOWELS.findall(word)))


def _cohesion(contents: list[set[str]]) -> float:
    """Mean similarity of neighbouring sentences both of which hold content words; .1 if there are none."""
    shared = [len(a & b) / len(a | b) for a, b in zip(contents, contents[1:]) if a and b]
    return sum(shared) / len(shared) if shared else 0.1


def details(text: str) -> dict:
    """The values of ``DETAILS`` and ``COUNTS`` for one text; None where a family has too little text for one."""
    s = [x for x in (v.strip() for v in _SENTENCE_END.sub("\\1\x01", text).split("\x01")) if x]
    low = [v.lower() for v in s]
    st = [_TOKEN.findall(v) for v in low]
    t = [x for v in st for x in v]
    w = [x for x in t if x.isalpha()]
    n_s, n_t, n_w = len(s), len(t), len(w)
    row = dict.fromkeys(DETAILS) | {"n_sentences": n_s, "n_tokens": n_t, "n_words": n_w}
    if n_s and n_w:
        length, syllables = n_w / n_s, sum(map(_syllables, w)) / n_w
        row |= {"flesch_reading_ease": 206.835 - 1.015 * length - 84.6 * syllables, "flesch_kincaid_grade": 0.39 * length + 11.8 * syllables - 15.59, "avg_sentence_length": length}
    if n_s >= 2:
        linked = sum(not _TRANSITIONS.isdisjoint(v) or _TRANSITION_PHRASES.search(x) is not None for v, x in zip(st, low))
        mean = sum(map(len, st)) / n_s
        spread = (sum((len(v) - mean) ** 2 for v in st) / n_s) ** 0.5
        row |= {"transition_ratio": linked / n_s, "lexical_cohesion": _cohesion([set(v) - _STOP for v in st]), "length_variance": spread / (mean + 1)}
    if n_t >= 10:
        row |= {"lexical_diversity": len(set(t)) / n_t, "content_word_ratio": sum(x not in _STOP for x in w) / n_t, "number_ratio": sum(not _DIGITS.isdisjoint(x) for x in t) / n_t}
        if n_w:
            row["avg_word_length"] = sum(map(len, w)) / n_w
    if n_s:
        lower = text.lower()
        row |= {
            "ends_properly": s[-1][-1] in ".!?",
            "has_truncation": _TRUNCATION.search(lower) is not None,
            "has_conclusion": _CONCLUSIONS.search(lower) is not None,
            "capitalization_ratio": sum(unicodedata.category(v[0]) == "Lu" for v in s) / n_s,
            "words_per_sentence": n_w / n_s,
        }
    if text:
        row["alpha_ratio"] = sum(map(str.isalpha, text)) / len(text)
    return row


@F.arrow_udf(_KIND)
def _details(texts: pa.Array) -> pa.Array:
    return pa.array([details(t or "") for t in texts.to_pylist()], _ARROW)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns, ``DETAILS`` and ``COUNTS``; null where a family has too little text for one. Clashing input
    columns come out as ``<name>_input``.

    One visit to Python per batch: the measures share tokens and sets of them, which Spark's array functions would make
    and copy anew for each, interpreted."""
    df = make_room(df, (*DETAILS, *COUNTS), keep=[text])
    return fenced(df, __d=_details(F.col(text))).select(*df.columns, "__d.*")


def _band(x: Column, lo: float, hi: float, fall: float, floor: float) -> Column:
    """1 within [lo, hi]; x / lo below; above, down by the excess over ``fall``, but not under ``floor``."""
    return F.when(x < lo, x / lo).when(x <= hi, 1.0).otherwise(F.greatest(F.lit(floor), 1 - (x - hi) / fall))


def _scores() -> dict[str, Column]:
    ease, grade, asl = F.col("flesch_reading_ease"), F.col("flesch_kincaid_grade"), F.col("avg_sentence_length")
    ease_score = F.when(ease < 0, 0.0).when(ease < 30, ease / 60).when(ease <= 80, 0.5 + (ease - 30) / 100).otherwise(1.0)
    grade_score = F.when(grade < 6, 0.5).when(grade <= 12, 1.0).when(grade <= 16, 1 - (grade - 12) * 0.075).otherwise(0.5)
    readability = F.when(ease.isNotNull(), 0.4 * ease_score + 0.3 * grade_score + 0.3 * _band(asl, 10, 25, 25, 0.0)).otherwise(0.5)
    cohesion = _band(F.col("lexical_cohesion"), 0.2, 0.4, 0.6, 0.5)
    coherence = F.when(F.col("n_sentences") < 2, 0.5).otherwise(0.3 * F.least(F.lit(1.0), 3 * F.col("transition_ratio")) + 0.5 * cohesion + 0.2 * F.greatest(F.lit(0.0), 1 - F.col("length_variance") / 2))
    word = F.when(F.col("avg_word_length").isNull(), 0.5).otherwise(_band(F.col("avg_word_length"), 4, 7, 5, 0.5))
    density = F.when(F.col("n_tokens") < 10, 0.3).otherwise(0.3 * F.least(F.lit(1.0), F.col("lexical_diversity") / 0.6) + 0.3 * F.least(F.lit(1.0), F.col("content_word_ratio") / 0.6) + 0.2 * word + 0.2 * _band(F.col("number_ratio"), 0.05, 0.15, 0.15, 0.5))
    n = F.col("n_tokens")
    complete = F.when(F.col("n_sentences") == 0, 0.0).otherwise(
        0.3 * F.when(F.col("ends_properly"), 1.0).otherwise(0.3) + 0.3 * F.when(F.col("has_truncation"), 0.2).otherwise(1.0) + 0.2 * F.when(F.col("has_conclusion"), 1.0).otherwise(0.7) + 0.2 * F.when(n < 50, 0.3).when(n < 100, 0.7).otherwise(1.0)
    )
    linguistic = F.when((F.col("n_sentences") == 0) | (F.col("n_words") == 0), 0.5).otherwise(0.3 * F.col("capitalization_ratio") + 0.4 * _band(F.col("words_per_sentence"), 10, 25, 25, 0.5) + 0.3 * F.least(F.lit(1.0), F.col("alpha_ratio") / 0.7))
    return dict(zip(FAMILIES, (readability, coherence, density, complete, linguistic)))


def score(df: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``measure`` with the five scores, unrounded, and the composite, category, verdict and weakest family.

    Texts too short for a family get its fixed score (readability and coherence .5, density .3, completeness 0);
    null texts are scored like empty ones. Of equal scores the first family in ``FAMILIES`` is the weakest. Clashing
    input columns come out as ``<name>_input``."""
    df = make_room(df, (*FAMILIES, *RESULTS, *DETAILS, *COUNTS), keep=[text])
    out = measure(df, text)
    for name, column in _scores().items():
        out = out.withColumn(name, column)
    total = sum((w * F.col(f) for f, w in WEIGHTS.items()), F.lit(0.0))
    out = out.withColumn("composite_score", total)
    weakest = F.array_min(F.array(*[F.struct(F.col(f).alias("score"), F.lit(i).alias("o"), F.lit(f).alias("name")) for i, f in enumerate(FAMILIES)]))
    return (
        out.withColumn("category", category("composite_score"))
        .withColumn("passes_threshold", F.col("composite_score") >= threshold)
        .withColumn("__weak", weakest)
        .withColumn("weakest_metric", F.col("__weak.name"))
        .withColumn("weakest_score", F.col("__weak.score"))
        .drop("__weak")
    )


def category(x: str | Column) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.when(c >= 0.8, "excellent").when(c >= 0.65, "good").when(c >= 0.5, "acceptable").when(c >= 0.35, "poor").when(c.isNotNull(), "very_poor")


def stats(scored: DataFrame) -> DataFrame:
    """Per category the count and the range of the composite, most frequent first."""
    return scored.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.min("composite_score").alias("min_score"), F.avg("composite_score").alias("mean_score"), F.max("composite_score").alias("max_score")).orderBy(F.desc("n"), "category")


def report(scored: DataFrame, name: str) -> DataFrame:
    """The flat report, best first, by name among equals. The sort samples its input, so that is settled before."""
    return settle(scored.select(name, "composite_score", "category", "passes_threshold", *FAMILIES, "weakest_metric"), "report").orderBy(F.desc("composite_score"), name)
