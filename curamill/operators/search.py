"""Queries over enriched chunks: lookup, statistics, search, comparison, export. Lists have a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def lookup(chunks: DataFrame, chunk_id: str | None = None, position: int = 0) -> DataFrame:
    """The chunk with that id, or the one at a position of the order by source file, index and id; at most one row."""
    order = ["source_file", "chunk_index", "chunk_id"]
    if chunk_id is not None:
        return chunks.filter(F.col("chunk_id") == chunk_id).orderBy(*order).limit(1)
    return chunks.orderBy(*order).limit(position + 1).orderBy(*[F.desc(c) for c in order]).limit(1) if position else chunks.orderBy(*order).limit(1)


def detail(chunks: DataFrame) -> DataFrame:
    """What a reader sees of each chunk: capped lists, a short summary and a preview."""
    return chunks.select(
        "chunk_id", "source_file", "chunk_index", "total_chunks", "token_count", "quality_score", "primary_topic",
        F.slice("keywords", 1, 10).alias("keywords"),
        F.transform_values("entity_types", lambda _, v: F.slice(F.array_sort(v), 1, 5)).alias("entity_types"),
        F.slice("potential_questions", 1, 5).alias("questions"),
        F.substring("summary", 1, 200).alias("summary"),
        F.substring("text", 1, 300).alias("preview"),
    )


def overview(chunks: DataFrame) -> DataFrame:
    """Chunks, chunks with keywords, and the mean number of keywords over all chunks."""
    n = F.size(F.coalesce("keywords", F.array().cast("array<string>")))
    return chunks.agg(F.count(F.lit(1)).alias("total_chunks"), F.count_if(n > 0).alias("with_keywords"), F.round(F.sum(n) / F.count(F.lit(1)), 4).alias("mean_keywords"))


def top_keywords(chunks: DataFrame, n: int = 10) -> DataFrame:
    counted = chunks.select(F.explode("keywords").alias("keyword")).groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "keyword").limit(n)


def entity_distribution(chunks: DataFrame, n: int = 10) -> DataFrame:
    """The types with most entity texts."""
    typed = chunks.select(F.explode("entity_types").alias("label", "texts")).groupBy("label").agg(F.sum(F.size("texts")).alias("n"))
    return typed.orderBy(F.desc("n"), "label").limit(n)


def topic_distribution(chunks: DataFrame, n: int | None = None) -> DataFrame:
    """Chunks by primary topic, most first; all of them without ``n``."""
    counted = chunks.filter(F.col("primary_topic").isNotNull()).groupBy(F.col("primary_topic").alias("topic")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "topic")
    return counted if n is None else counted.limit(n)


def structure_counts(chunks: DataFrame) -> DataFrame:
    return chunks.agg(*[F.count_if(F.col(f"structure.has_{k}")).alias(f"with_{k}") for k in ("headings", "lists", "code", "numbers", "urls")])


def quality_bins(chunks: DataFrame) -> DataFrame:
    """Chunks by quality bin with their share in percent."""
    q = F.col("quality_score")
    named = chunks.select(F.when(q >= 0.9, "excellent").when(q >= 0.7, "good").when(q >= 0.5, "fair").when(q.isNotNull(), "poor").alias("bin")).filter("bin IS NOT NULL")
    counted = named.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n").alias("total"))  # one row
    return counted.crossJoin(total).select("bin", "n", F.round(100 * F.col("n") / F.col("total"), 2).alias("percent"))


def keyword_search(chunks: DataFrame, word: str) -> DataFrame:
    """All chunks with the word among their keywords or anywhere in their text, case aside."""
    low = F.lit(word.lower())
    return chunks.filter(F.coalesce(F.exists("keywords", lambda k: F.lower(k) == low), F.lit(False)) | F.contains(F.lower("text"), low))


def snippet(word: str, around: int = 50) -> Column:
    """The text around the first hit; null without one."""
    at = F.instr(F.lower("text"), F.lit(word.lower()))
    start = F.greatest(at - around, F.lit(1))
    return F.when(at > 0, F.substring(F.col("text"), start, at + len(word) + around - start))


def entity_search(chunks: DataFrame, needle: str) -> DataFrame:
    """Chunks with an entity containing the text, case aside, and the first type by name that has one."""
    low = F.lit(needle.lower())
    hits = F.filter(F.array_sort(F.map_keys("entity_types")), lambda k: F.exists(F.col("entity_types")[k], lambda t: F.contains(F.lower(t), low)))
    return chunks.withColumn("matched_type", F.get(hits, F.lit(0))).filter(F.col("matched_type").isNotNull())


def topic_search(chunks: DataFrame, topic: str) -> DataFrame:
    return chunks.filter(F.coalesce(F.exists("topics", lambda t: F.lower(t) == topic.lower()), F.lit(False)))


def list_topics(chunks: DataFrame) -> DataFrame:
    return chunks.select(F.explode("topics").alias("topic")).groupBy("topic").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "topic")


def list_entities(chunks: DataFrame, label: str | None = None, n: int = 50) -> DataFrame:
    rows = chunks.select(F.explode("entity_types").alias("label", "texts"))
    if label:
        rows = rows.filter(F.col("label") == label.upper())
    return rows.select("label", F.explode("texts").alias("entity")).groupBy("label", "entity").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label", "entity").limit(n)


def compare(chunks: DataFrame, first: str, second: str) -> DataFrame:
    """Two chunks side by side with what they share; one row, none if either is missing."""
    names = ["chunk_id", "token_count", "quality_score", "keywords", "topics"]
    a = chunks.filter(F.col("chunk_id") == first).select(*[F.col(c).alias(f"{c}_a") for c in names]).limit(1)
    b = chunks.filter(F.col("chunk_id") == second).select(*[F.col(c).alias(f"{c}_b") for c in names]).limit(1)
    return a.crossJoin(b).withColumn("shared_keywords", F.array_intersect("keywords_a", "keywords_b")).withColumn("shared_topics", F.array_intersect("topics_a", "topics_b"))


def export_summary(chunks: DataFrame, n: int = 20) -> DataFrame:
    """One row: totals, means, the top keywords and topics, and chunks by entity type."""
    empty = F.array().cast(T.ArrayType(T.StringType()))
    totals = chunks.agg(
        F.count(F.lit(1)).alias("total_chunks"), F.countDistinct("source_file").alias("total_documents"), F.round(F.avg("token_count"), 4).alias("mean_tokens"),
        F.round(F.avg("quality_score"), 4).alias("mean_quality"), F.sum(F.size(F.coalesce("keywords", empty))).alias("n_keywords"),
    )
    words = top_keywords(chunks, n).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus"), "keyword"))).alias("top_keywords"))
    topics = topic_distribution(chunks, n).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus"), "topic"))).alias("top_topics"))
    kinds = chunks.select(F.explode(F.map_keys("entity_types")).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("chunks_by_entity_type"))
    return totals.crossJoin(words).crossJoin(topics).crossJoin(kinds).withColumn("generated_at", F.current_timestamp())  # one row each
