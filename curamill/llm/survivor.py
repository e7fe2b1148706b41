"""One surviving record per group of duplicates, by iterative truth discovery over sources and field values."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from curamill.functions.skew import join_unique
from curamill.session import settle


#: The criteria that vote for the representative, next to the sources that vote for field values.
RULES = ("score", "recency", "filled")


@dataclass(frozen=True)
class Fusion:
    """``tolerance``: the loop ends when no weight moves by more. Weights of up to ``inline`` sources are written into the
    plan, those of more are a table that is joined; it decides the cost and not the result."""

    max_rounds: int = 25
    tolerance: float = 1e-3
    inline: int = 256
    floor: float = 0.02


@dataclass
class Fused:
    """``golden``: a row per group with the best-supported value of each field, its confidence, the group's size and
    ``representative_id``. ``reliability``: (source, weight) found for each source that stands in a group of several
    records, and for each of ``RULES`` as ``rule:<name>``, sources being ``by:<name>``. ``rounds``: passes made;
    ``converged``: whether the weights stood still at their end."""

    golden: DataFrame
    reliability: DataFrame
    rounds: int
    converged: bool
    trace: list[float] = field(default_factory=list)

    @property
    def weights(self) -> dict[str, float]:
        """The sources' weights on the driver."""
        return {r["source"][3:]: r["weight"] for r in self.reliability.filter("source LIKE 'by:%'").collect()}


def filled(df: DataFrame, columns: list[str]) -> Column:
    """How many of the columns hold something: neither null nor NaN nor an empty string."""
    total = F.lit(0)
    kinds = dict(df.dtypes)
    for name in columns:
        c = F.col(f"`{name}`")
        has = c.isNotNull()
        if kinds[name] == "string":
            has = has & (c != "")
        elif kinds[name] in ("double", "float"):
            has = has & ~F.isnan(c)
        total = total + F.when(has, 1).otherwise(0)
    return total


class _Votes:
    """Weighted votes over the settled ``facts``: (__key, field, value, stated, last), ``stated`` mapping sources to
    how often they state the value."""

    def __init__(self, facts: DataFrame, options: Fusion):
        self.facts, self.options, self.spark = facts, options, facts.sparkSession
        self.held = settle(self.masses(facts), "held")
        self.few = 0 < self.held.count() <= options.inline
        self.mass = {r["source"]: r["mass"] for r in self.held.collect()} if self.few else {}  # at most ``inline`` rows
        self.weights = dict.fromkeys(self.mass, 1.0)
        self.many = None if self.few else settle(self.held.select("source", F.lit(1.0).alias("weight")), "weights")

    @property
    def table(self) -> DataFrame:
        """(source, weight)."""
        return self.spark.createDataFrame(sorted(self.weights.items()), "source string, weight double") if self.few else self.many

    @staticmethod
    def masses(stated: DataFrame) -> DataFrame:
        return stated.select(F.explode("stated").alias("source", "mass")).groupBy("source").agg(F.sum("mass").alias("mass"))

    def weighed(self) -> DataFrame:
        """The facts with their ``vote``."""
        if self.few:
            own = F.create_map(*[x for s, w in sorted(self.weights.items()) for x in (F.lit(s), F.lit(w))])
            vote = F.aggregate(F.map_entries("stated"), F.lit(0.0), lambda total, e: total + e["value"] * own[e["key"]])
            return self.facts.withColumn("vote", F.round(vote, 9))
        place = ["__key", "field", "value"]
        single = self.facts.select(*place, F.explode("stated").alias("source", "mass"))
        votes = single.join(self.many, "source").groupBy(*place).agg(F.round(F.sum(F.col("mass") * F.col("weight")), 9).alias("vote"))
        return self.facts.join(votes, place)

    def winners(self) -> DataFrame:
        return self.weighed().groupBy("__key", "field").agg(F.max_by(F.struct("value", "stated", "vote"), F.struct("vote", "last", "value")).alias("w"), F.sum("vote").alias("all_votes"))

    def round(self) -> float | None:
        """New weights from what the present ones take as true; by how much the weights moved at most, None without sources."""
        won = self.masses(self.winners().select(F.col("w.stated").alias("stated"))).withColumnRenamed("mass", "won")
        floor = self.options.floor
        if self.few:
            right = {r["source"]: r["won"] for r in won.collect()}  # at most ``inline`` rows
            odds = {s: math.log1p((p := min(max(right.get(s, 0.0) / m, floor), 1 - floor)) / (1 - p)) for s, m in self.mass.items()}
            mean = sum(odds.values()) / len(odds)
            before, self.weights = self.weights, {s: o / mean for s, o in odds.items()}
            return max(abs(self.weights[s] - before[s]) for s in before)
        right = F.least(F.greatest(F.coalesce("won", F.lit(0.0)) / F.col("mass"), F.lit(floor)), F.lit(1 - floor))
        new = settle(self.held.join(won, "source", "left").select("source", F.log1p(right / (1 - right)).alias("odds")).join(self.many, "source"), "weights")
        mean = new.agg(F.avg("odds")).first()[0]
        moved = new.agg(F.max(F.abs(F.col("odds") / mean - F.col("weight")))).first()[0] if mean else None
        self.many = new.select("source", (F.col("odds") / mean).alias("weight")) if mean else self.many
        return moved


def fuse(df: DataFrame, key: str, record_id: str, fields: list[str], source: str, score: str, recency: str, counted: list[str] | None = None, options: Fusion = Fusion()) -> Fused:
    """Group ``df`` by ``key`` and find, field by field, the value the reliable sources support most, and the record
    the reliable criteria support most.

    Sources start equally reliable. Each round adds up, for every value of a field in a group, the weight of the
    sources that state it; the heaviest value is taken as true; a source's weight becomes the log of its odds of
    stating what was taken as true. Rounds stop when the weights stand still. Of equal support the later value
    wins, then the greater. The representative is one more field, whose values are the group's records: each of three
    criteria, highest score, latest date and most filled ``counted`` columns, states the records it puts first, with a
    reliability of its own that is found in the same rounds. ``representative_id`` is the record with the most support,
    of equals the one agreeing best with the golden values, then by score, recency, fill and lowest id. A record that leads in
    all three (``undisputed``) has all votes there are.

    Reliability is learned in groups of several records; the others have nothing to compare. Rows with a null key or id
    belong to no group and are left out. A record id delivered again counts once, in its latest delivery. Null, NaN and
    empty values vote for nothing; a field nobody filled stays null with null confidence. A null source is the source
    ``''``. Input columns with clashing names don't matter: only the named ones are read. An empty table gives an empty
    ``golden`` and no weights.

    A group may hold any share of the rows: every step aggregates map-side first, and the one join back to the
    records salts hot groups. What is collected for one value is a list of its sources, not of its records.
    """
    counted = counted or fields
    kinds = {f.name: f.dataType for f in df.schema.fields}
    present = df.filter(F.col(key).isNotNull() & F.col(record_id).isNotNull())
    latest = present.groupBy(F.col(key).alias("__key"), F.col(record_id).alias("__id")).agg(
        F.max_by(
            F.struct(*[F.col(f"`{f}`").alias(f"f{i}") for i, f in enumerate(fields)], F.coalesce(F.col(source), F.lit("")).alias("source"), F.when(F.isnan(F.col(score).cast("double")), None).otherwise(F.col(score).cast("double")).alias("score"), F.col(recency).alias("recency"), filled(df, counted).alias("filled")),
            F.struct(F.col(recency), filled(df, counted), F.col(source)),
        ).alias("r")
    )
    records = settle(latest.select("__key", "__id", "r.*"), "records")
    names = [f"f{i}" for i in range(len(fields))]
    tops = settle(records.groupBy("__key").agg(F.count(F.lit(1)).alias("n_records"), *[F.max(r).alias(f"top_{r}") for r in RULES]), "tops")
    several = settle(join_unique(records, tops.filter("n_records > 1"), ["__key"], "inner", sizes="n_records"), "several")

    stated = [F.struct(F.lit(n).alias("field"), F.col(n).cast("string").alias("value"), F.concat(F.lit("by:"), "source").alias("source")) for n in names]
    stated += [F.struct(F.lit("record").alias("field"), F.when(_leads(r), F.col("__id").cast("string")).alias("value"), F.lit(f"rule:{r}").alias("source")) for r in RULES]
    melted = several.select("__key", "recency", F.explode(F.array(*stated)).alias("x")).select("__key", "recency", "x.*")
    melted = melted.filter(F.col("value").isNotNull() & (F.col("value") != "") & (F.col("value") != "NaN"))
    facts = (
        melted.groupBy("__key", "field", "value", "source")
        .agg(F.count(F.lit(1)).cast("double").alias("mass"), F.max("recency").alias("last"))
        .groupBy("__key", "field", "value")
        .agg(F.map_from_entries(F.collect_list(F.struct("source", "mass"))).alias("stated"), F.max("last").alias("last"))
    )
    votes = _Votes(settle(facts, "facts"), options)
    rounds, trace = 0, []
    while rounds < options.max_rounds and (not trace or trace[-1] > options.tolerance):
        rounds += 1
        moved = votes.round()
        if moved is None:  # no group of several records
            break
        trace.append(moved)
    converged = not trace or trace[-1] <= options.tolerance

    won = votes.winners().filter("field <> 'record'").select("__key", "field", F.struct(F.col("w.value").alias("value"), F.round(F.col("w.vote") / F.nullif("all_votes", F.lit(0.0)), 9).alias("confidence")).alias("v"))
    best = settle(tops.filter("n_records > 1").join(won.groupBy("__key").agg(*[F.max(F.when(F.col("field") == n, F.col("v"))).alias(n) for n in names]), "__key", "left"), "best")
    compared = join_unique(several.drop(*[f"top_{r}" for r in RULES], "n_records"), best.select("__key", "n_records", *[f"top_{r}" for r in RULES], *[F.col(n).alias(f"g_{n}") for n in names]), ["__key"], "inner", sizes="n_records")
    weight = {r["source"]: r["weight"] for r in votes.table.filter("source LIKE 'rule:%'").collect()}  # three rows at most
    support = sum((F.when(_leads(r), F.lit(weight.get(f"rule:{r}", 1.0))).otherwise(0.0) for r in RULES), F.lit(0.0))
    agreement = sum((F.when(F.col(n).cast("string") == F.col(f"g_{n}.value"), F.col(f"g_{n}.confidence")).otherwise(0.0) for n in names), F.lit(0.0))
    behind = [-F.round(support, 9), -F.round(agreement, 9), F.coalesce(-F.col("score"), F.lit(float("inf"))), -F.coalesce(F.unix_micros(F.col("recency").cast("timestamp")), F.lit(-(2**62))), -F.col("filled"), F.col("__id")]
    leads_all = _leads("score") & _leads("recency") & _leads("filled")
    chosen = compared.groupBy("__key").agg(F.min_by(F.struct(F.col("__id").alias("id"), leads_all.alias("leads")), F.struct(*behind)).alias("c"))
    fused = best.join(chosen, "__key").select("__key", F.col("c.id").alias("id"), F.col("c.leads").alias("undisputed"), "n_records", *names)

    alone = records.join(tops.filter("n_records = 1").select("__key", "n_records"), "__key")
    own = [F.when(F.col(n).isNotNull() & ~F.col(n).cast("string").isin("", "NaN"), F.struct(F.col(n).cast("string").alias("value"), F.lit(1.0).alias("confidence"))).alias(n) for n in names]
    golden = fused.unionByName(alone.select("__key", F.col("__id").alias("id"), F.lit(True).alias("undisputed"), "n_records", *own)).select(
        F.col("__key").alias(key),
        F.col("id").alias("representative_id"),
        "undisputed",
        "n_records",
        *[F.col(f"{n}.value").cast(kinds[f]).alias(f) for n, f in zip(names, fields)],
        F.create_map(*[x for n, f in zip(names, fields) for x in (F.lit(f), F.col(f"{n}.confidence"))]).alias("field_confidence"),
    )
    return Fused(golden, votes.table, rounds, converged, trace)


def _leads(rule: str) -> Column:
    """Whether no record of the group is ahead by the rule; where the group has no value for it, all are level."""
    return F.coalesce(F.col(rule) >= F.col(f"top_{rule}"), F.col(f"top_{rule}").isNull())
