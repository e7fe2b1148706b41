"""Text cleaning: ten steps whose order is part of the contract, then language and metrics."""

from __future__ import annotations

import codecs
import html
import unicodedata
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from curamill.functions import lexicons as L, text as X
from curamill.functions.columns import fenced, make_room

OUTPUTS = ("cleaned_text", "extracted_urls", "extracted_emails", "detected_language", "original_length", "cleaned_length", "chars_removed", "cleanup_ratio_percent", "compression_ratio", "original_lines", "cleaned_lines", "status")


@dataclass(frozen=True)
class Cleaning:
    """``compat`` keeps the known slips of the original patterns: a run of final marks becomes a backslash and a 1,
    a mark glued to a letter becomes five literal characters, and three other steps do nothing."""

    keep_urls: bool = False
    keep_emails: bool = False
    compat: bool = False


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def html_to_text(value: str) -> str:
    """Text nodes in order without a separator; comments and tags go, script and style bodies stay."""
    parser = _Text()
    parser.feed(value)
    parser.close()
    return "".join(parser.parts)


#: Windows-1252 with its five unassigned bytes kept as control characters, as most software reads it.
WINDOWS = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(256))
_BYTES = codecs.charmap_build(WINDOWS)


def _round_trip(value: str) -> str:
    """UTF-8 that was read as Windows-1252, once or several times over, read again rightly, as long as all of it decodes
    and it gets shorter."""
    while True:
        try:
            back = codecs.charmap_encode(value, "strict", _BYTES)[0].decode("utf-8")
        except UnicodeError:
            return value
        if len(back) >= len(value):
            return value
        value = back


#: Typographic characters and what plain text writes for them.
PLAIN = str.maketrans({"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "‘": "'", "’": "'", "“": '"', "”": '"'})


def repair(value: str) -> str:
    """Entities, wrong decoding, ligatures, curly quotes and line ends, line by line where it matters."""
    if "&" in value and "<" not in value:
        value = html.unescape(value)
    if not value.isascii():
        value = "\n".join(_round_trip(x) if not x.isascii() else x for x in value.split("\n")).translate(PLAIN)
    return value.replace("\r\n", "\n").replace("\r", "\n")


@F.arrow_udf(T.StringType())
def repaired(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else repair(t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def html_text(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else html_to_text(t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def nfkc(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else t if t.isascii() else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _prepared(texts: pa.Array) -> pa.Array:
    """Repair, markup and NFKC in one visit to Python."""
    out = []
    for t in texts.to_pylist():
        if t is not None:
            t = repair(t)
            if "<" in t and ">" in t:
                t = html_to_text(t)
            t = t if t.isascii() else unicodedata.normalize("NFKC", t)
        out.append(t)
    return pa.array(out, pa.string())


def urls(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(L.URL), F.lit(0))


def mask_urls(x: Column) -> Column:
    return F.regexp_replace(x, L.URL, "[URL]")


def emails(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(L.EMAIL), F.lit(0))


def mask_emails(x: Column) -> Column:
    return F.regexp_replace(x, L.EMAIL, "[EMAIL]")


def drop_page_lines(x: Column) -> Column:
    """Without lines holding just a page number; form feeds become line breaks."""
    lines = F.filter(F.split(x, "\n", -1), lambda v: ~v.rlike(r"(?i)^[ \t]*(?:page[ \t]*)?[0-9]+[ \t]*(?:of[ \t]*[0-9]+)?[ \t]*\z"))
    return F.regexp_replace(F.array_join(lines, "\n"), r"\x{0c}", "\n")


def join_hyphens(x: Column) -> Column:
    return F.regexp_replace(x, r"(?<=[\p{L}\p{N}_])-[ \t]*\n\s*(?=[\p{L}\p{N}_])", "")


def bullets(x: Column) -> Column:
    return F.regexp_replace(x, rf"(^|\n)\s*{L.BULLET}\s+", "$1- ")


def numbered(x: Column) -> Column:
    """``1)`` and ``1 .`` at a line's head become ``1. ``."""
    return F.regexp_replace(x, r"(^|\n)[ \t]*([0-9]+)[ \t]*[.)][ \t]+", "$1$2. ")


def punctuation(x: Column, compat: bool = False) -> Column:
    if compat:
        return F.regexp_replace(F.regexp_replace(x, r"[.!?]{2,}", r"\\1"), r"[.,!?;:][a-zA-Z]", r"\\1 \\2")
    once = F.regexp_replace(x, r"([.!?])[.!?]+", "$1")
    closed = F.regexp_replace(once, r"\s+([.,!?;:])", "$1")
    return F.regexp_replace(closed, r"([.,!?;:])([a-zA-Z])", "$1 $2")


def drop_repeated_lines(x: Column) -> Column:
    """Without a line equal to the one right before it; blank lines stay."""
    before = lambda lines, i: F.get(lines, i - 1)
    kept = X.let(F.split(x, "\n", -1), lambda lines: F.filter(lines, lambda v, i: ~v.eqNullSafe(before(lines, i)) | ~v.rlike(L.SOLID)))
    return F.array_join(kept, "\n")


def whitespace(x: Column) -> Column:
    """Without control characters and line-end variants; lines stripped, blanks and blank lines collapsed."""
    c = F.regexp_replace(F.regexp_replace(x, L.CONTROL, ""), r"\r\n?", "\n")
    c = F.array_join(F.transform(F.split(c, "\n", -1), X.strip), "\n")
    return X.strip(F.regexp_replace(F.regexp_replace(c, " {2,}", " "), r"\n{3,}", "\n\n"))


def metrics(original: Column, cleaned: Column) -> list[Column]:
    a, b = F.length(original), F.length(cleaned)
    lines = lambda c: F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))
    return [
        a.alias("original_length"),
        b.alias("cleaned_length"),
        (a - b).alias("chars_removed"),
        F.when(a > 0, F.round((a - b) * 100 / a, 2)).otherwise(0.0).alias("cleanup_ratio_percent"),
        F.when(a > 0, F.round(b / a, 3)).otherwise(0.0).alias("compression_ratio"),
        lines(original).alias("original_lines"),
        lines(cleaned).alias("cleaned_lines"),
    ]


def clean(df: DataFrame, text: str = "text", options: Cleaning = Cleaning()) -> DataFrame:
    """Adds the cleaned text, what was extracted, the language and the metrics. Null texts stay null with status
    ``failed``; clashing input columns come out as ``<name>_input``."""
    df = make_room(df, OUTPUTS, keep=[text])
    step = fenced(df, __p=_prepared(F.col(text)))
    p = F.col("__p")
    step = step.withColumn("extracted_urls", urls(p)).withColumn("__u", p if options.keep_urls else mask_urls(p))
    u = F.col("__u")
    step = step.withColumn("extracted_emails", emails(u)).withColumn("__e", u if options.keep_emails else mask_emails(u))
    steps = [drop_page_lines, *([] if options.compat else [join_hyphens]), bullets, *([] if options.compat else [numbered]), lambda c: punctuation(c, options.compat), drop_repeated_lines, whitespace]
    cleaned = F.col("__e")
    for one in steps:
        cleaned = one(cleaned)
    step = fenced(step, cleaned_text=cleaned).drop("__p", "__u", "__e")
    return step.select("*", X.language("cleaned_text").alias("detected_language"), *metrics(F.col(text), F.col("cleaned_text")), F.when(F.col(text).isNull(), "failed").otherwise("success").alias("status"))


def clean_stats(cleaned: DataFrame) -> DataFrame:
    """One row of totals over the output of ``clean``."""
    return cleaned.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.sum("chars_removed").alias("chars_removed"),
        F.round(F.avg("cleanup_ratio_percent"), 4).alias("mean_cleanup_ratio"),
    )
