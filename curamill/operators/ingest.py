"""Validation of extracted text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curamill.functions import text as X
from curamill.functions.columns import make_room

OUTPUTS = ("stripped_length", "special_ratio", "non_ascii_ratio", "n_words", "word_diversity", "validation_issues", "validation_status")


def validate(df: DataFrame, text: str = "text", min_length: int = 50, max_special: float = 0.3, max_non_ascii: float = 0.5, min_diversity: float = 0.3) -> DataFrame:
    """Adds the measures, the ordered list of issues and the status of each text.

    A text without anything but blanks is invalid and has that one issue; a null text is in error. Every other
    issue is a warning. Diversity is judged from 11 words on. Clashing input columns come out as ``<name>_input``."""
    df = make_room(df, OUTPUTS, keep=[text])
    t = F.col(text)
    out = df.withColumn("stripped_length", F.length(X.strip(t)))
    out = out.withColumn("special_ratio", X.special_ratio(t)).withColumn("non_ascii_ratio", X.non_ascii_ratio(t))
    out = out.withColumn("__w", X.fields(t)).withColumn("n_words", F.when(t.isNotNull(), F.size("__w")))
    out = out.withColumn("word_diversity", F.when(F.col("n_words") > 0, F.size(F.array_distinct("__w")) / F.col("n_words"))).drop("__w")
    percent = lambda c: F.format_string("%.2f%%", F.round(F.col(c) * 100, 2))
    issues = F.array_compact(
        F.array(
            F.when(F.col("stripped_length") < min_length, F.format_string("Text too short: %d characters", F.col("stripped_length"))),
            F.when(F.col("special_ratio") > max_special, F.concat(F.lit("High special character ratio: "), percent("special_ratio"))),
            F.when(F.col("non_ascii_ratio") > max_non_ascii, F.concat(F.lit("High non-ASCII ratio: "), percent("non_ascii_ratio"))),
            F.when((F.col("n_words") > 10) & (F.col("word_diversity") < min_diversity), F.concat(F.lit("Low word diversity: "), percent("word_diversity"))),
        )
    )
    empty = F.col("stripped_length") == 0
    return out.withColumn("validation_issues", F.when(t.isNull(), F.array(F.lit("No text"))).when(empty, F.array(F.lit("Empty text"))).otherwise(issues)).withColumn(
        "validation_status", F.when(t.isNull(), "error").when(empty, "invalid").otherwise("valid")
    )


def validation_stats(validated: DataFrame) -> DataFrame:
    """One row of totals over the output of ``validate``."""
    return validated.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("validation_status") == "valid").alias("successful"),
        F.count_if(F.col("validation_status") == "invalid").alias("empty"),
        F.count_if(F.col("validation_status") == "error").alias("failed"),
        F.count_if(F.size("validation_issues") > 0).alias("with_issues"),
        F.round(100 * F.count_if(F.col("validation_status") == "valid") / F.greatest(F.count(F.lit(1)), F.lit(1)), 2).alias("success_percent"),
    )
