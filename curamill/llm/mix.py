"""Drawing sources to target weights with hash thresholds instead of a sort."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from curamill.llm.tokens import token_count
from curamill.session import settle

#: Hashes have 60 bits; each refinement reads 12 more of them, so a histogram has at most 4096 buckets a source.
BITS, STEP = 60, 12


@dataclass
class Mixture:
    """``drawn``: a row per text drawn (source, its lowest id, tokens, copies). ``report``: a row per target."""

    drawn: DataFrame
    report: DataFrame


def _hash(text_key: Column, seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text_key, F.lit(seed)), 64 - BITS)


@dataclass(frozen=True)
class Threshold:
    """How far a source is drawn: ``passes`` times whole and once more below the hash ``end``. ``whole`` tells that every
    pass allowed was used up before the budget was crossed."""

    own: int
    passes: int
    end: int
    whole: bool


def _first_level(units: DataFrame, wanted: dict[str, tuple[int, int]]) -> DataFrame:
    """By source the size of one pass, the whole passes that fit the budget, what is left of it, and the bucket of the
    first histogram that crosses the rest (null where no pass is left to cross it in)."""
    at = units.sparkSession.createDataFrame([(s, b, n) for s, (b, n) in wanted.items()], "source string, budget long, repeats long")
    hist = units.join(F.broadcast(at), "source").groupBy("source", F.shiftright("h", BITS - STEP).alias("bucket")).agg(F.sum("tokens").alias("size"), F.count(F.lit(1)).alias("n"), F.max("budget").alias("budget"), F.max("repeats").alias("repeats"))
    source = W.partitionBy("source")  # at most 4096 rows
    hist = hist.withColumn("own", F.sum("size").over(source)).withColumn("upto", F.sum("size").over(source.orderBy("bucket")))
    hist = hist.withColumn("passes", F.least(F.floor(F.col("budget") / F.col("own")), "repeats")).withColumn("rest", F.col("budget") - F.col("passes") * F.col("own"))
    crosses = (F.col("passes") < F.col("repeats")) & (F.col("upto") > F.col("rest"))
    return hist.groupBy("source").agg(F.max("own").alias("own"), F.max("passes").alias("passes"), F.max("rest").alias("rest"), F.min(F.when(crosses, F.struct("bucket", (F.col("upto") - F.col("size")).alias("below"), "n"))).alias("x"))


def _thresholds(units: DataFrame, wanted: dict[str, tuple[int, int]]) -> dict[str, Threshold]:
    """For each source with its budget and most passes, how far it can be drawn within the budget. Level by level: a
    histogram over the next bits of the hash, kept to the one bucket of the level before that crosses the budget."""
    spark = units.sparkSession
    passes: dict[str, tuple[int, int]] = {}
    ends: dict[str, int] = {}
    state = []  # source, bucket so far, tokens below it, budget
    for r in _first_level(units, wanted).collect():  # a row per target
        s, x = r["source"], r["x"]
        passes[s] = (r["own"], r["passes"])
        if x is not None and x["n"] == 1:
            ends[s] = x["bucket"] << (BITS - STEP)
        elif x is not None:
            state.append((s, x["bucket"], x["below"], r["rest"]))
    for shift in range(BITS - 2 * STEP, -1, -STEP):
        if not state:
            break
        at = spark.createDataFrame(state, "source string, prefix long, below long, budget long")
        inside = units.join(F.broadcast(at), "source").filter(F.shiftright("h", shift + STEP) == F.col("prefix"))
        hist = inside.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("tokens").alias("size"), F.count(F.lit(1)).alias("n"), F.max("below").alias("below"), F.max("budget").alias("budget")
        )
        upto = F.col("below") + F.sum("size").over(W.partitionBy("source").orderBy("bucket"))  # at most 4096 rows a source
        crossing = (
            hist.withColumn("upto", upto)
            .filter("upto > budget")
            .groupBy("source")
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("size")).alias("below"), "n")).alias("x"))
        )
        found = {r["source"]: r["x"] for r in crossing.collect()}  # a row per target
        ahead = []
        for source, _, _, budget in state:
            x = found[source]
            if x["n"] == 1 or shift == 0:
                ends[source] = x["bucket"] << shift
            else:
                ahead.append((source, x["bucket"], x["below"], budget))
        state = ahead
    return {s: Threshold(own, n, ends.get(s, 0), s not in ends) for s, (own, n) in passes.items()}


def mix(documents: DataFrame, targets: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", source: str = "source", total: int | None = None, seed: int = 0) -> Mixture:
    """Draw from each source of ``targets`` (source, target_share, max_repeats) its share of ``total`` tokens of the
    vocabulary file ``tokenizer``, which is by default the size of all documents, whether or not their source has a target.

    A source gives every document ``q`` times, ``q`` the whole passes its budget allows, and once more the documents whose
    hash lies under a threshold found by histograms. Thresholds are nested: with a larger budget and the same seed
    everything drawn before is drawn again. What is drawn never exceeds the budget and misses it by less than one
    document. No document is drawn more than ``max_repeats`` times; a text under several ids counts once for each id, in the
    supply as in the draw. A source is ``short`` if its threshold stays at the end of the last pass and what lies below falls
    short of the target.

    Null and empty texts have no tokens; they are drawn with no one. Rows with a null source belong to no target but
    count in the total; repeated rows of one id and text count once. Targets without documents are reported with zeros as
    short; of repeated targets for a source the largest share holds; a null share counts as 0 and a null ``max_repeats`` as 1.
    Only the named columns are read, so extra columns may have any names. Hot sources only ever meet map-side aggregation.
    """
    spark = documents.sparkSession
    sizes = documents.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), F.md5(F.col(text)).alias("k"), F.coalesce(token_count(text, tokenizer), F.lit(0)).alias("tokens"))
    units = settle(sizes.groupBy("source", "id", "k").agg(F.max("tokens").alias("tokens")), "units")
    units = units.withColumn("h", _hash(F.concat_ws(" ", "k", F.col("id").cast("string")), seed))
    if total is None:
        total = units.agg(F.sum("tokens")).first()[0] or 0

    wanted: dict[str, tuple[float, int]] = {}
    for r in targets.select("source", "target_share", "max_repeats").filter("source IS NOT NULL").collect():  # the targets
        share = (r["target_share"] or 0.0, 1 if r["max_repeats"] is None else r["max_repeats"])
        wanted[r["source"]] = max(wanted.get(r["source"], share), share)
    found = _thresholds(units.filter("tokens > 0"), {s: (int(share * total), repeats) for s, (share, repeats) in wanted.items()}) if wanted else {}
    rows = []
    for s, (share, repeats) in wanted.items():
        at = found.get(s, Threshold(0, repeats, 0, True))
        rows.append((s, share, repeats, at.passes, at.end, at.own, float(share * total), at.whole and at.passes * at.own < share * total))
    plan = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, passes long, threshold long, supply_tokens long, target_tokens double, short boolean")

    copies = F.col("passes") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)
    drawn = units.filter("tokens > 0").join(F.broadcast(plan), "source").withColumn("copies", copies.cast("int")).filter("copies > 0")
    drawn = drawn.select("source", F.col("id").alias(doc_id), "tokens", "copies")

    held = units.groupBy("source").agg(F.count(F.lit(1)).alias("documents"))
    got = drawn.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("drawn_tokens"), F.count(F.lit(1)).alias("drawn_texts"), F.max("copies").alias("most_copies"))
    report = F.broadcast(plan.drop("passes", "threshold")).join(held, "source", "left").join(got, "source", "left").na.fill(0, ["documents", "drawn_tokens", "drawn_texts", "most_copies"])
    all_drawn = got.agg(F.sum("drawn_tokens").alias("all_drawn"))
    report = report.crossJoin(F.broadcast(all_drawn))  # one row
    columns = ["source", "target_share", "max_repeats", "documents", "supply_tokens", "target_tokens", "short", "drawn_tokens", "drawn_texts", "most_copies"]
    report = report.select(*columns, (F.col("drawn_tokens") / F.col("all_drawn")).alias("actual_share"), (F.col("drawn_tokens") / F.lit(float(total or 1))).alias("share_of_total"))
    return Mixture(drawn, report)
