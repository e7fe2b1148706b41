"""Extension: the stages that need no other document, over a stream of (filename, text, arrival time)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curamill.functions import text as X
from curamill.operators import clean, ingest, quality


def curate_stream(stream: DataFrame, time: str, key: str = "filename", text: str = "text", late: str = "1 hour", threshold: float = 0.5) -> DataFrame:
    """Validate, clean and score each text, and drop texts equal to one that came within ``late`` before.

    State holds one hash per text within the watermark. Rows that arrive later than that aren't deduplicated against
    forgotten ones; null texts and times are dropped."""
    rows = stream.filter(F.col(text).isNotNull() & F.col(time).isNotNull()).select(F.col(key).alias("filename"), F.col(text).alias("text"), F.col(time).alias("arrived"))
    valid = ingest.validate(rows).filter("validation_status = 'valid'").select("filename", "text", "arrived")
    cleaned = clean.clean(valid).select("filename", F.col("cleaned_text").alias("text"), "arrived", "detected_language")
    scored = quality.score(cleaned, threshold=threshold).select("filename", "text", "arrived", "detected_language", "composite_score", "passes_threshold")
    return scored.withColumn("hash", X.content_hash("text")).withWatermark("arrived", late).dropDuplicatesWithinWatermark(["hash"])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows by window and value of ``by``; a window comes out when the watermark has passed it."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), F.col(by)).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), by, "n")
