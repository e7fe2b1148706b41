"""Enrichment of chunks: keywords, entities, summary, questions, topics and structure."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from curamill.functions import lexicons as L, text as X
from curamill.functions.columns import fenced, make_room
from curamill.functions.encoders import Encoder
from curamill.operators.keywords import by_frequency, cascade

OUTPUTS = ("keywords", "keyword_details", "entities", "entity_types", "entity_count", "summary", "potential_questions", "topics", "primary_topic", "topic_scores", "structure", "enrichment_timestamp", "enrichment_version", "enrichment_error")


@dataclass(frozen=True)
class Features:
    """Which columns are made; structure always is. A column switched off comes out null. ``keyword_methods`` are tried
    in turn until one finds any; ``encoder`` is what embedding uses, and without one it is passed over."""

    keywords: bool = True
    entities: bool = True
    summary: bool = True
    questions: bool = True
    topics: bool = True
    n_keywords: int = 5
    keyword_methods: tuple[str, ...] = ("embedding", "statistical", "frequency")
    encoder: Encoder | None = None


_KEYWORD = T.StructType([T.StructField("keyword", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("method", T.StringType())])
_KEYWORD_ARROW = pa.list_(pa.struct([("keyword", pa.string()), ("score", pa.float64()), ("method", pa.string())]))


def keywords(x: str | Column, n: int = 5) -> Column:
    """The ``n`` most frequent lower-cased alphabetic words without stop words; of equally frequent ones the first."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def frequent(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else [k for k, _ in by_frequency(t, n)] for t in texts.to_pylist()], pa.list_(pa.string()))

    return frequent(x)


def described(x: str | Column, features: Features) -> Column:
    """Struct of ``keywords`` (keyword, score, method), ``entities`` and ``error``. What fails on a text leaves that text
    without both and with the message, and doesn't touch the others."""
    kind = T.StructType([T.StructField("keywords", T.ArrayType(_KEYWORD)), T.StructField("entities", _ENTITY_TYPE), T.StructField("error", T.StringType())])
    arrow = pa.struct([("keywords", _KEYWORD_ARROW), ("entities", _ENTITY_ARROW), ("error", pa.string())])

    def one(text: str) -> dict:
        try:
            found = cascade(text, features.n_keywords, features.keyword_methods, features.encoder) if features.keywords or features.questions or features.topics else []
            return {"keywords": [dict(zip(_KEYWORD.names, k)) for k in found], "entities": find_entities(text) if features.entities else None, "error": None}
        except Exception as e:  # noqa: BLE001 - the chunk is kept, without what failed
            return {"keywords": None, "entities": None, "error": f"{type(e).__name__}: {e}"[:500]}

    @F.arrow_udf(kind)
    def describe(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else one(t) for t in texts.to_pylist()], arrow)

    return describe(x)


def corpus_keywords(df: DataFrame, key: str, text: str = "text", n: int = 5) -> DataFrame:
    """(key, keywords): as ``keywords``, with the counting done by the shuffle; quicker on long texts."""
    stop = F.array(*[F.lit(w) for w in L.STOP_WORDS])
    words = df.select(key, F.posexplode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("i", "w")).filter(F.col("w").rlike(r"^\p{L}{2,}$") & ~F.array_contains(stop, F.col("w")))
    counted = words.groupBy(key, "w").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("first"))
    return counted.groupBy(key).agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "first", "w"))), 1, n), lambda k: k["w"]).alias("keywords"))


# What each label looks like, in order of precedence.
ENTITY_PATTERNS = (
    ("DATE", r"\b\d{4}-\d{2}-\d{2}\b|\b\d{1,2}/\d{1,2}/\d{4}\b|\b(?:January|February|March|April|May|June|July|August|September|October|November|December) \d{1,2}\b|\b\d{1,2} (?:January|February|March|April|May|June|July|August|September|October|November|December)\b"),
    ("TIME", r"\b\d{1,2}:\d{2}(?:\s?[ap]\.?m\.?)?\b|\b\d{1,2} [ap]\.m\."),
    ("MONEY", r"[$€£]\s?\d+(?:[.,]\d+)*|\b\d+(?:[.,]\d+)*\s?(?:€|euros?|dollars?|USD|EUR)\b|\b\d+(?:[.,]\d+)*\s?€|(?<![\d.,])\d+\.\d{2}(?![\d.,%])"),
    ("PERCENT", r"\b\d+(?:[.,]\d+)?\s?(?:%|percent\b)"),
    ("ORDINAL", r"\b(?:\d+(?:st|nd|rd|th)|first|second|third|fourth|fifth)\b"),
    ("PERSON", r"\b(?:Mr|Mrs|Ms|Dr|Prof)\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?"),
    ("ORG", r"\b\p{Lu}[\p{L}&]+(?: \p{Lu}[\p{L}&]+)* (?:Inc|Ltd|LLC|GmbH|Corp|Co)\b\.?"),
    ("CARDINAL", r"(?<![\w.,])\d+(?:[.,]\d+)*(?![\w%])"),
)
# Given names and places that names of persons and places are told by.
GIVEN_NAMES = "Alice Amelia Anna Anne Antonio Arthur Barbara Carlos Carmen Charles Charlotte Claire David Elena Emily Emma Fatima Franz George Hans Helen Henri Henry Isabel Jack James Jane Javier Jean John Jorge José Juan Julia Karl Klaus Laura Linda Louis Lucas Lucy Luis Manuel Marc María Maria Marie Mark Martin Mary Michael Miguel Nicole Nina Olivia Oscar Paul Pedro Peter Pierre Pilar Rachel Robert Rosa Sarah Simon Sofia Sophie Susan Thomas Victor William Wolfgang".split()
PLACES = "Argentina Australia Austria Belgium Brazil Canada Chile China Colombia Denmark Egypt England Europe Finland France Germany Greece India Indonesia Ireland Israel Italy Japan Kenya Malaysia Mexico Morocco Netherlands Nigeria Norway Peru Philippines Poland Portugal Russia Scotland Singapore Spain Sweden Switzerland Taiwan Thailand Turkey Ukraine Vietnam Wales Amsterdam Athens Bangkok Barcelona Beijing Berlin Boston Brussels Budapest Cairo Chicago Copenhagen Delhi Dublin Edinburgh Frankfurt Geneva Hamburg Helsinki Istanbul Jakarta Lisbon London Lyon Madrid Melbourne Milan Moscow Mumbai Munich Oslo Paris Prague Rome Seattle Seoul Shanghai Stockholm Sydney Tokyo Toronto Vienna Warsaw Zurich".split()
PLACES_LONG = ["United States", "United Kingdom", "New York", "New Zealand", "Hong Kong", "Kuala Lumpur", "Los Angeles", "San Francisco", "South Africa", "South Korea", "Saudi Arabia"]
ENTITY_PATTERNS += (
    ("PERSON2", rf"\b(?:{'|'.join(GIVEN_NAMES)})(?: \p{{Lu}}\.)?(?: \p{{Lu}}\p{{Ll}}+)+"),
    ("GPE", rf"\b(?:{'|'.join([*PLACES_LONG, *PLACES])})\b"),
)
_ENTITY = regex.compile("|".join(f"(?P<{label}>{pattern})" for label, pattern in ENTITY_PATTERNS))
_ENTITY_TYPE = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ENTITY_ARROW = pa.list_(pa.struct([("text", pa.string()), ("label", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_entities(text: str) -> list[dict]:
    """Spans with label and character offsets, by rules; overlapping readings go to the label that comes first."""
    return [{"text": m.group(), "label": m.lastgroup.rstrip("2"), "start": m.start(), "end": m.end()} for m in _ENTITY.finditer(text)]


@F.arrow_udf(_ENTITY_TYPE)
def entities(texts: pa.Array) -> pa.Array:
    """``find_entities`` of each text."""
    return pa.array([None if t is None else find_entities(t) for t in texts.to_pylist()], _ENTITY_ARROW)


def entity_types(x: str | Column) -> Column:
    """Label -> sorted distinct texts."""
    c = F.col(x) if isinstance(x, str) else x
    labels = F.array_sort(F.array_distinct(F.transform(c, lambda e: e["label"])))
    return F.map_from_arrays(labels, F.transform(labels, lambda v: F.array_sort(F.array_distinct(F.transform(F.filter(c, lambda e: e["label"] == v), lambda e: e["text"])))))


def summary(x: str | Column) -> Column:
    """The text itself up to two sentences, else the first and the last one."""
    c = F.col(x) if isinstance(x, str) else x
    s = X.sentences(c)
    return F.when(F.size(s) <= 2, c).otherwise(F.concat_ws(" ", F.element_at(s, 1), F.element_at(s, -1)))


def questions(keys: Column, x: Column) -> Column:
    """The first three keywords in the templates, then the pattern questions; distinct, at most five."""
    low = F.lower(x)
    made = [F.when(F.size(keys) > i, F.format_string(t, F.get(keys, F.lit(i)))) for i, t in enumerate(L.QUESTION_TEMPLATES)]
    for marks, question in L.PATTERN_QUESTIONS:
        hit = F.lit(False)
        for m in marks:
            hit = hit | F.contains(low, F.lit(m))
        made.append(F.when(hit, F.lit(question)))
    return F.slice(F.array_distinct(F.array_compact(F.array(*made))), 1, 5)


def topic_ranking(x: Column, keys: Column) -> Column:
    """(score, name) of each topic with a score: shared distinct words plus twice the shared keywords; best first,
    equal ones in the order of the list."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    ranked = []
    for i, (name, listed) in enumerate(L.TOPICS.items()):
        own = F.array(*[F.lit(w) for w in listed])
        points = F.size(F.array_intersect(words, own)) + 2 * F.size(F.array_intersect(keys, own))
        ranked.append(F.struct((-points).alias("minus"), F.lit(i).alias("o"), F.lit(name).alias("name")))
    return F.filter(F.array_sort(F.array(*ranked)), lambda t: t["minus"] < 0)


def structure(x: str | Column) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    lines = F.split(c, "\n", -1)
    pairs = F.when(F.size(lines) > 1, F.arrays_zip(F.slice(lines, 1, F.size(lines) - 1).alias("a"), F.slice(lines, 2, F.size(lines) - 1).alias("b")))
    code = F.lit(False)
    for mark in L.CODE_MARKS:
        code = code | F.contains(c, F.lit(mark))
    blocks = F.filter(F.split(c, r"\n\n"), lambda b: X.strip(b) != "")
    return F.struct(
        F.coalesce(F.exists(pairs, lambda p: (F.length(X.strip(p["a"])) > 0) & (F.length(X.strip(p["a"])) < 100) & (F.length(X.strip(p["b"])) > 50)), F.lit(False)).alias("has_headings"),
        c.rlike(r"(^|\n)\s*[-*•]\s+|[0-9]+\.\s+").alias("has_lists"),
        c.rlike("[0-9]").alias("has_numbers"),
        code.alias("has_code"),
        c.rlike("https?://").alias("has_urls"),
        F.size(blocks).alias("paragraph_count"),
        (F.length(c) - F.length(F.replace(c, F.lit("?"), F.lit("")))).alias("question_marks"),
    )


def enrich(df: DataFrame, text: str = "text", features: Features = Features()) -> DataFrame:
    """The input's columns and ``OUTPUTS``. Null texts have null in each of them but the stamp. A text whose description
    fails stays, without keywords and entities and with ``enrichment_error``. Clashing input columns come out as
    ``<name>_input``. Nothing is shuffled; Python sees each text once."""
    df = make_room(df, OUTPUTS, keep=[text])
    c = F.col(text)
    out = fenced(df, __d=described(c, features))
    out = out.withColumn("keywords", F.transform("__d.keywords", lambda k: k["keyword"]))
    details = F.map_from_entries(F.transform("__d.keywords", lambda k: F.struct(k["keyword"].alias("key"), F.struct(k["score"].alias("score"), k["method"].alias("method")).alias("value"))))
    out = out.withColumn("keyword_details", details).withColumn("entities", F.col("__d.entities"))
    out = out.withColumn("entity_types", entity_types("entities")).withColumn("entity_count", F.when(F.col("entities").isNotNull(), F.size("entities")))
    out = out.withColumn("summary", summary(c) if features.summary else F.lit(None).cast("string"))
    out = out.withColumn("potential_questions", questions(F.col("keywords"), c) if features.questions else F.lit(None).cast("array<string>"))
    out = out.withColumn("__t", topic_ranking(c, F.col("keywords")))
    topics = F.transform(F.filter("__t", lambda t: t["minus"] <= -2), lambda t: t["name"])
    primary = F.when(c.isNull(), None).when(F.size("__t") > 0, F.element_at("__t", 1)["name"]).otherwise("general")
    best = F.map_from_entries(F.transform(F.slice("__t", 1, 3), lambda t: F.struct(t["name"].alias("key"), (-t["minus"]).alias("value"))))
    if features.topics:
        out = out.withColumn("topics", topics).withColumn("primary_topic", primary).withColumn("topic_scores", best)
    else:
        out = out.withColumn("topics", F.lit(None).cast("array<string>")).withColumn("primary_topic", F.lit(None).cast("string")).withColumn("topic_scores", F.lit(None).cast("map<string,int>"))
    out = out.withColumn("structure", structure(c)).withColumn("enrichment_error", F.col("__d.error")).drop("__t", "__d")
    if not features.keywords:
        out = out.withColumn("keywords", F.lit(None).cast("array<string>")).withColumn("keyword_details", F.lit(None).cast("map<string,struct<score:double,method:string>>"))
    out = out.withColumn("enrichment_timestamp", F.current_timestamp()).withColumn("enrichment_version", F.lit("1.0"))
    return out.select(*df.columns, *OUTPUTS)


def stats(enriched: DataFrame) -> DataFrame:
    """One row of totals; the means are over rows that have any."""
    n_keys, n_entities = F.size(F.coalesce("keywords", F.array().cast("array<string>"))), F.coalesce("entity_count", F.lit(0))
    return enriched.agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.count_if(n_keys > 0).alias("with_keywords"),
        F.round(F.avg(F.when(n_keys > 0, n_keys)), 4).alias("mean_keywords"),
        F.count_if(n_entities > 0).alias("with_entities"),
        F.round(F.avg(F.when(n_entities > 0, n_entities)), 4).alias("mean_entities"),
    )
