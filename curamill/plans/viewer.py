"""Command line over enriched chunks: one action a call, statistics by default."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from curamill.operators import search
from curamill.session import build
from curamill.sources import files


def read(spark: SparkSession, path: str) -> DataFrame:
    """Enriched chunks from parquet, or from JSON lines if the files are named so."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(folder)]
    if any(".json" in n for n in names):
        return files.read_json_lines(spark, path, files.ENRICHED)
    return spark.read.parquet(path)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(description="Look at enriched chunks")
    p.add_argument("path", help="parquet or JSON-lines folder of enriched chunks")
    for name in ("chunk", "search-keyword", "search-entity", "search-topic"):
        p.add_argument(f"--{name}")
    p.add_argument("--list-entities", nargs="?", const="")
    p.add_argument("--compare", nargs=2)
    p.add_argument("--list-topics", action="store_true")
    p.add_argument("--export", action="store_true")
    p.add_argument("--limit", type=int, default=10)
    a = p.parse_args(argv)
    spark = spark or build()
    chunks = read(spark, a.path)
    order = ["source_file", "chunk_index", "chunk_id"]
    if a.chunk is not None:
        shown = [search.detail(search.lookup(chunks, a.chunk))]
    elif a.compare:
        shown = [search.compare(chunks, *a.compare)]
    elif a.search_keyword is not None:
        found = search.keyword_search(chunks, a.search_keyword)
        shown = [found.orderBy(*order).select("chunk_id", search.snippet(a.search_keyword).alias("snippet")).limit(a.limit)]
    elif a.search_entity is not None:
        shown = [search.entity_search(chunks, a.search_entity).orderBy(*order).select("chunk_id", "matched_type").limit(a.limit)]
    elif a.search_topic is not None:
        shown = [search.topic_search(chunks, a.search_topic).orderBy(*order).select("chunk_id", "primary_topic").limit(a.limit)]
    elif a.list_topics:
        shown = [search.list_topics(chunks)]
    elif a.list_entities is not None:
        shown = [search.list_entities(chunks, a.list_entities or None)]
    elif a.export:
        shown = [search.export_summary(chunks)]
    else:
        shown = [search.overview(chunks), search.top_keywords(chunks), search.entity_distribution(chunks), search.topic_distribution(chunks, 10), search.structure_counts(chunks), search.quality_bins(chunks)]
    for df in shown:
        df.show(50, truncate=100)
    return 0


if __name__ == "__main__":
    sys.exit(main())
