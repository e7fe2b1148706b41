"""Writing results. Sources are never moved or changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_routed(df: DataFrame, path: str, flag: str) -> None:
    """Parquet, one folder per value of ``flag`` (pass or fail, valid or rejected)."""
    df.write.mode("overwrite").partitionBy(flag).parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One object a line; null fields are left out."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def write_chunk_text(chunks: DataFrame, path: str) -> None:
    """A readable dump of each chunk."""
    line = F.concat(F.lit("=== "), F.col("chunk_id"), F.lit(" ("), F.col("token_count").cast("string"), F.lit(" tokens) ===\n"), F.col("chunk_text"), F.lit("\n"))
    chunks.select(line.alias("value")).write.mode("overwrite").text(path)


def write_csv_report(report: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header; nested columns become JSON."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in report.dtypes]
    report.select(*flat).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def write_json_report(report: DataFrame, path: str) -> None:
    """A report of few rows as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def score_dashboard(scored: DataFrame, name: str, bins: int = 20, ends: int = 5) -> dict[str, DataFrame]:
    """The data of the four panels: histogram, categories, mean by family, best and worst."""
    from curamill.operators.quality import FAMILIES

    binned = F.least(F.floor(F.col("composite_score") * bins), F.lit(bins - 1)).cast("int")
    return {
        "histogram": scored.groupBy(binned.alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy("bin"),
        "categories": scored.groupBy("category").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category"),
        "means": scored.agg(*[F.avg(f).alias(f) for f in FAMILIES]),
        "best": scored.select(name, "composite_score").orderBy(F.desc("composite_score"), name).limit(ends),
        "worst": scored.select(name, "composite_score").orderBy("composite_score", name).limit(ends),
    }
