"""The text kernel under SQL names, for use from ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


def register(spark: SparkSession) -> None:
    """Create temporary SQL functions ``cm_strip``, ``cm_comparable``, ``cm_content_hash``, ``cm_tokens``,
    ``cm_approx_tokens`` (all inside the JVM) and the table function ``cm_split(text)`` of (chunk_index, chunk_text)."""
    from curamill.functions import lexicons as L

    blank = L.BLANK.replace("\\", "\\\\")
    one = f"regexp_replace(lower(t), '{blank}+', ' ')"
    strip = lambda x: f"regexp_replace({x}, '^{blank}+|{blank}+$', '')"
    comparable = strip(f"regexp_replace({one}, '[^\\\\p{{L}}\\\\p{{M}}\\\\p{{N}}_ ]', '')")
    for name, kind, body in (
        ("cm_strip", "STRING", strip("t")),
        ("cm_comparable", "STRING", comparable),
        ("cm_content_hash", "STRING", f"md5({comparable})"),
        ("cm_tokens", "ARRAY<STRING>", "regexp_extract_all(t, '[\\\\p{L}\\\\p{N}]+|[^\\\\p{L}\\\\p{N}\\\\s]', 0)"),
        ("cm_approx_tokens", "INT", "CAST(floor(length(t) / 4) AS INT)"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS {kind} RETURN {body}")
    from pyspark.sql.functions import udtf

    from curamill.operators.chunk import Chunking, split_text

    class Split:
        def eval(self, text: str):
            for i, piece in enumerate(split_text(text or "", Chunking())):
                yield i, piece

    spark.udtf.register("cm_split", udtf(Split, returnType="chunk_index int, chunk_text string"))
