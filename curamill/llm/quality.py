"""Per-document text statistics, their exact ranks within a language, and outlier scores from tail probabilities."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from curamill.functions.columns import make_room
from curamill.functions.skew import join_unique
from curamill.llm.prose import ANY_COMMON, analyse, symbol_ratio
from curamill.session import settle

#: Statistic -> the side on which lists, tables and junk lie (-1 low, 1 high, 0 either).
STATISTICS = {
    "sentence_share": -1,
    "common_share": -1,
    "line_end_share": -1,
    "words_per_line": -1,
    "distinct_share": -1,
    "symbol_ratio": 1,
    "digit_share": 1,
    "mean_word_length": 0,
}
MEASURES = ("word_count", "language", *STATISTICS)
SCORES = ("outlier_score", "junk_score", "most_unusual", "is_prose")
_MEASURES = "word_count int, language string, " + ", ".join(f"{s} double" for s in STATISTICS)
FINAL = ".!?。！？।…｡\"'”’»)]」』）"


def measure(text: str) -> tuple:
    """The values of ``MEASURES`` for one text; without words all shares are 0."""
    found = analyse(text)
    n = len(found.words)
    lines = [x for x in map(str.rstrip, text.split("\n")) if x]
    lower = [w.lower() for w in found.words]
    return (
        n,
        found.language,
        found.share,
        sum(w in ANY_COMMON for w in lower) / n if n else 0.0,
        sum(x[-1] in FINAL for x in lines) / len(lines) if lines else 0.0,
        n / len(lines) if lines else 0.0,
        len(set(lower)) / n if n else 0.0,
        symbol_ratio(text),
        sum(w[0].isdigit() for w in lower) / n if n else 0.0,
        sum(map(len, lower)) / n if n else 0.0,
    )


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns and the statistics of each text; null for null texts, 0 and language ``und`` for empty ones.

    Input columns named like an output come out as ``<name>_input``. One pass, no shuffle, whole texts."""
    df = make_room(df, MEASURES, keep=[text])

    @F.arrow_udf(f"struct<{_MEASURES.replace(' ', ':').replace(',:', ',')}>")
    def measures(texts: pa.Array) -> pa.Array:
        rows = [None if t is None else dict(zip(MEASURES, measure(t))) for t in texts.to_pylist()]
        kinds = [("word_count", pa.int32()), ("language", pa.string()), *((s, pa.float64()) for s in STATISTICS)]
        return pa.array(rows, pa.struct(kinds))

    return df.withColumn("__m", measures(text)).select(*df.columns, "__m.*")


@dataclass(frozen=True)
class Judging:
    """Two references: rows with ``prose_from`` or more of their words in sentences are prose, rows with ``junk_to`` or less are
    junk; what lies between is too near a half to tell. A language with at least ``least`` prose rows is held against its own
    rows, any other against those of all languages. Where one of the references is empty there is nothing to hold a text against, and
    the share of words in sentences decides, with the limit ``least_share``. Detection misses some short sentences, so that is
    a little under a half. ``others`` is the weight of all statistics but that share, together, where its own is 1."""

    prose_from: float = 0.55
    junk_to: float = 0.4
    least: int = 100
    least_share: float = 0.46
    others: float = 0.5


def tail_probabilities(values: DataFrame, parts: int | None = None) -> DataFrame:
    """Exact empirical tails of (stat, language, value, ...) rows: for each distinct value ``n``, ``p_left``, the share
    of its group's rows not above it, and ``p_right``, the share not below it.

    With a boolean column ``clear`` in ``values`` the same against the group's clear rows alone: ``r``, their number, and
    ``r_left`` and ``r_right``, the share of them not above or not below, the row itself counted to either: a value beyond all
    of them has 1 / (r + 1). With a boolean column ``junk`` the same against those rows: ``j``, ``j_left`` and ``j_right``.

    Equal values are counted first, map-side; the distinct ones are sorted by range partition, numbered within each
    partition, and moved up by the number of rows in the partitions before it. No group passes through one task."""
    values = values.withColumns({c: F.lit(False) for c in ("clear", "junk") if c not in values.columns})
    counts = values.groupBy("stat", "language", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if("clear").alias("c"), F.count_if("junk").alias("d"))
    ranged = counts.repartitionByRange(*([parts] if parts else []), "stat", "language", "value")
    ranged = settle(ranged.select("*", F.spark_partition_id().alias("part")), "ranged")
    sums = ranged.groupBy("stat", "language", "part").agg(*[F.sum(x).alias(f"{x}_part") for x in "ncd"])
    group = W.partitionBy("stat", "language")  # a row per partition and group
    offsets = sums.select(
        "stat", "language", "part",
        *[(F.sum(f"{x}_part").over(group.orderBy("part")) - F.col(f"{x}_part")).alias(f"{x}_before") for x in "ncd"],
        *[F.sum(f"{x}_part").over(group).alias(f"{x}_total") for x in "ncd"],
    )
    inside = W.partitionBy("stat", "language", "part").orderBy("value")
    at = ranged.select("*", *[F.sum(x).over(inside).alias(f"{x}_local") for x in "ncd"]).join(offsets, ["stat", "language", "part"])
    n_upto, c_upto, d_upto = (F.col(f"{x}_before") + F.col(f"{x}_local") for x in "ncd")
    n_all, r, j = (F.col(f"{x}_total") for x in "ncd")
    return at.select(
        "stat", "language", "value", "n",
        (n_upto / n_all).alias("p_left"), ((n_all - n_upto + F.col("n")) / n_all).alias("p_right"),
        r.alias("r"), ((c_upto + 1) / (r + 1)).alias("r_left"), ((r - c_upto + F.col("c") + 1) / (r + 1)).alias("r_right"),
        j.alias("j"), ((d_upto + 1) / (j + 1)).alias("j_left"), ((j - d_upto + F.col("d") + 1) / (j + 1)).alias("j_right"),
    )


def score_quality(df: DataFrame, text: str = "text", options: Judging = Judging()) -> DataFrame:
    """``text_statistics`` without the text itself, and for each row

    - ``outlier_score``: the larger of three sums over the statistics of -ln tail probability among all rows of the
      language: all left tails, all right tails, and each statistic's longer tail by its skewness;
    - ``junk_score``: how much further a row lies from the table's prose than from its lists, tables and junk. For each statistic,
      -ln tail probability among the prose rows, on the side on which junk lies, less -ln tail probability among the junk rows,
      on the other side, either in units of what a value beyond its whole reference has; to that of ``sentence_share``, which is
      what is asked, half the mean of the others, which go together, is added. Null where one of the references is empty;
    - ``most_unusual``: the statistic with the least tail probability (of equals the first by name);
    - ``is_prose``: a ``junk_score`` not above 0 or, where it is null, the share of words in sentences (``Judging``).

    Ranks are exact and over all rows; ties share a rank. A language with few prose rows is ranked among the rows of all
    languages. Rows with null text have null scores and ``is_prose`` null; a text without words is no prose. Repeated
    rows count as often as they occur. Clashing input columns come out as ``<name>_input``.
    """
    df = make_room(df, (*MEASURES, *SCORES, "row_id"), keep=[text])
    measured = settle(text_statistics(df, text).drop(text).withColumn("row_id", F.monotonically_increasing_id()), "measured")
    references = {"clear": F.col("sentence_share") >= options.prose_from, "junk": F.col("sentence_share") <= options.junk_to}
    own = [r["language"] for r in measured.filter(references["clear"]).groupBy("language").count().filter(F.col("count") >= options.least).collect()]  # the languages known
    melted = measured.filter("word_count IS NOT NULL").select("row_id", "language", *[c.alias(name) for name, c in references.items()], F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).alias("value")) for s in STATISTICS])).alias("x")).select("row_id", "language", *references, "x.*")
    in_own = F.col("language").isin(own)
    everyone = melted.withColumn("language", F.lit("*"))
    ranked = melted.filter(in_own).unionByName(everyone) if measured.filter(F.col("word_count").isNotNull() & ~in_own).limit(1).count() else melted
    tails = settle(tail_probabilities(ranked), "tails")
    skew = ranked.groupBy("stat", "language").agg((F.skewness("value") < 0).alias("left_longer"))
    asked = melted.drop(*references).withColumn("language", F.when(in_own, F.col("language")).otherwise("*"))
    placed = join_unique(asked, tails, ["stat", "language", "value"], "inner", sizes="n").join(F.broadcast(skew), ["stat", "language"])  # a row per statistic and language
    left, right = -F.log("p_left"), -F.log("p_right")
    side = F.create_map(*[x for s, d in STATISTICS.items() for x in (F.lit(s), F.lit(d))])[F.col("stat")]

    def distance(size: str, low: str, high: str) -> Column:
        return -F.log(F.when(side == 0, F.least(F.lit(1.0), 2 * F.least(low, high))).when(side < 0, F.col(low)).otherwise(F.col(high))) / F.nullif(F.log(F.col(size) + 1), F.lit(0.0))

    shared = F.col("stat") == "sentence_share"
    evidence = distance("r", "r_left", "r_right") - distance("j", "j_right", "j_left")
    scored = placed.groupBy("row_id").agg(
        F.round(F.greatest(F.sum(left), F.sum(right), F.sum(F.when(F.col("left_longer"), left).otherwise(right))), 6).alias("outlier_score"),
        F.round(F.max(F.when(shared, evidence)) + options.others * F.avg(F.when(~shared, evidence)), 6).alias("junk_score"),
        F.min(F.struct(F.least("p_left", "p_right"), "stat")).getField("stat").alias("most_unusual"),
    )
    out = measured.join(scored, "row_id", "left")
    prose = (
        F.when(F.col("word_count").isNull(), None)
        .when(F.col("word_count") == 0, False)
        .when(F.col("junk_score").isNotNull(), F.col("junk_score") <= 0)
        .otherwise(F.col("sentence_share") >= options.least_share)
    )
    return out.withColumn("is_prose", prose).drop("row_id")
