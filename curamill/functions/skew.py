"""Joining against a side with unique keys when single keys hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

#: A key of no more rows than this is never hot.
LEAST = 1000


def hot_keys(left: DataFrame, right: DataFrame | None, keys: list[str], share: int = 1000, sizes: str | None = None) -> list[tuple]:
    """The keys holding at least 1/``share`` of the left rows and more than ``LEAST`` of them, so at most ``share`` keys.
    Without ``sizes``, a column of ``right``, they are counted."""
    if sizes:
        counts = right.select(*keys, F.col(sizes).alias("__n"))
        total = counts.agg(F.sum("__n")).first()[0] or 0
    else:
        total = left.count()
        counts = left.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    if total <= LEAST:
        return []
    return [tuple(r)[:-1] for r in counts.filter((F.col("__n") > LEAST) & (F.col("__n") * share >= total)).collect()]


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", share: int = 1000, sizes: str | None = None, spread: int = 64, hot: list[tuple] | None = None) -> DataFrame:
    """``left`` joined to ``right``, whose ``keys`` are unique, without one task per hot key.

    A key is hot when it holds at least 1/``share`` of the left rows. There are at most ``share`` such keys, whatever
    the input's size, and only they reach the driver. Their left rows are salted over ``spread`` parts and their right
    rows, one a key, repeated for each part, so nothing of the right side is broadcast. Without hot keys it is an
    ordinary join. ``sizes`` names a column of ``right`` that already holds the number of left rows of a key; otherwise
    they are counted, so ``left`` should be cheap to read twice, or ``hot`` be given, the ``hot_keys`` of a table that is. Null keys match nothing; with ``how='left'`` they stay
    with nulls, with ``'inner'`` they go.
    """
    found = hot_keys(left, right, keys, share, sizes) if hot is None else hot
    if not found:
        return left.join(right, keys, how)
    kinds = T.StructType([T.StructField(k, right.schema[k].dataType) for k in keys])
    marked = F.broadcast(left.sparkSession.createDataFrame(found, kinds).withColumn("__hot", F.lit(True)))
    part = F.when(F.col("__hot"), F.monotonically_increasing_id() % spread).otherwise(0)
    parts = F.when(F.col("__hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))
    salted = left.join(marked, keys, "left").withColumn("__part", part).drop("__hot")
    repeated = right.join(marked, keys, "left").withColumn("__part", F.explode(parts)).drop("__hot")
    return salted.join(repeated, [*keys, "__part"], how).drop("__part")
