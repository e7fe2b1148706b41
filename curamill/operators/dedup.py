"""Deduplication: exact, by shared character or word runs, and by embeddings; groups, representatives, survivors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curamill.functions import text as X
from curamill.functions.columns import fenced
from curamill.functions.encoders import embedded
from curamill.functions.skew import join_unique
from curamill.operators.components import connected_components
from curamill.session import settle


def exact_groups(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(hash, first, n) of each comparable text that more than one row has; rows with null text are in no group."""
    return df.filter(F.col(text).isNotNull()).groupBy(X.content_hash(text).alias("hash")).agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")


def exact_edges(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(a, b, method, score): every further member of an exact group tied to its first one. A hot group is one row here."""
    hashed = settle(df.filter(F.col(text).isNotNull()).select(F.col(key).alias("b"), X.content_hash(text).alias("hash")), "hashes")
    groups = hashed.groupBy("hash").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return join_unique(hashed, groups, ["hash"], "inner", sizes="n").filter("a <> b").select("a", "b", F.lit("exact").alias("method"), F.lit(1.0).alias("score")).distinct()


@dataclass(frozen=True)
class Fuzzy:
    """``unit`` is ``word`` (runs of ``shingle`` words) or ``char``. ``bands`` x ``rows`` MinHash samples; with
    ``verify`` the similarity of every candidate is computed, without it candidates are taken as they are."""

    unit: str = "word"
    shingle: int = 5
    threshold: float = 0.8
    bands: int = 32
    rows: int = 5
    verify: bool = True
    bucket: int = 1000
    seed: int = 1


#: The original's definition: runs of three characters, 128 samples in 8 bands of 16, threshold .85, not verified.
COMPAT = Fuzzy(unit="char", shingle=3, threshold=0.85, bands=8, rows=16, verify=False)


def shingles(x: Column, options: Fuzzy) -> Column:
    return X.char_shingles(x, options.shingle) if options.unit == "char" else X.word_shingles(x, options.shingle)


def _bands(options: Fuzzy):
    k = options.bands * options.rows
    rng = np.random.default_rng(options.seed)
    a = rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, k, dtype=np.uint64)

    @F.arrow_udf("array<bigint>")
    def bands(hashes: pa.Array) -> pa.Array:
        out = []
        for row in hashes:
            x = row.values.to_numpy(zero_copy_only=False).view(np.uint64) if row.is_valid else np.empty(0, np.uint64)
            if not len(x):
                out.append(None)
                continue
            least = np.full(k, np.iinfo(np.uint64).max, np.uint64)
            with np.errstate(over="ignore"):
                for i in range(0, len(x), 512):
                    np.minimum(least, (a[:, None] * x[None, i : i + 512] + b[:, None]).min(axis=1), out=least)
                key = np.arange(options.bands, dtype=np.uint64)
                for j in range(options.rows):
                    key = (key ^ least[j :: options.rows]) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(31)
            out.append(key.view(np.int64))
        return pa.array(out, pa.list_(pa.int64()))

    return bands


def fuzzy_edges(df: DataFrame, key: str, text: str = "text", options: Fuzzy = Fuzzy()) -> DataFrame:
    """(a, b, method, score), a < b, of comparable texts that are alike by ``options``; one text with one shingle
    set stands for all its copies, which are tied to it with score 1.

    Buckets of more than ``bucket`` texts are joined block by block, so that no task holds a whole bucket."""
    docs = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("t"))
    docs = fenced(docs, t=X.comparable("t"))
    docs = fenced(docs, set=F.array_sort(F.array_distinct(F.transform(shingles(F.col("t"), options), lambda v: F.xxhash64(v)))))
    hashed = settle(docs.select("id", "set").filter(F.size("set") > 0).withColumn("cls", F.md5(F.array_join("set", ","))), "shingles")
    classes = hashed.groupBy("cls").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.any_value("set").alias("set"))
    classes = settle(classes.withColumn("bands", _bands(options)("set")), "classes")
    copies = join_unique(hashed.select("cls", F.col("id").alias("b")), classes.filter("n > 1").select("cls", F.col("id").alias("a"), "n"), ["cls"], "inner", sizes="n").filter("a <> b").select("a", "b")

    rows = classes.select("id", F.posexplode("bands").alias("band", "key"))
    counts = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = settle(join_unique(rows, counts, ["band", "key"], "inner", sizes="n"), "bands")
    blocks = F.ceil(F.col("n") / options.bucket).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    left = rows.select("band", "key", F.col("id").alias("a"), own.alias("i"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j"))
    right = rows.select("band", "key", F.col("id").alias("b"), own.alias("j"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"))
    pairs = left.join(right, ["band", "key", "i", "j"]).filter("a < b").select("a", "b").distinct()
    pairs = settle(pairs, "pairs")
    if options.verify:
        side = classes.select("id", "set")
        for end in ("a", "b"):  # a text with very many partners is split by adaptive execution
            pairs = pairs.join(side.select(F.col("id").alias(end), F.col("set").alias(f"set_{end}")), end)
        pairs = pairs.select("a", "b", X.jaccard(F.col("set_a"), F.col("set_b")).alias("score")).filter(F.col("score") >= options.threshold)
    else:
        pairs = pairs.withColumn("score", F.lit(None).cast("double"))
    return pairs.unionByName(copies.withColumn("score", F.lit(1.0))).select("a", "b", F.lit("fuzzy").alias("method"), "score")


def _projections(n: int, threshold: float, miss: float, bucket: int = 1000) -> tuple[int, int]:
    """(bits, tables): as many signs that a bucket of ``n`` unrelated vectors holds about ``bucket``, and so many tables
    that a pair at the threshold shares none with probability ``miss`` at most."""
    bits = max(4, math.ceil(math.log2(max(n, 1) / bucket)))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-same)))


def semantic_edges(df: DataFrame, key: str, vector: str = "embedding", threshold: float = 0.95, miss: float = 1e-4, block: int = 2000, seed: int = 3) -> DataFrame:
    """(a, b, method, score), a < b, of vectors whose cosine reaches ``threshold``.

    Candidates share all signs of a set of random projections in one of several tables; the sets get longer, and the
    tables more, with the number of vectors, so that buckets stay small while a pair at the threshold is missed with
    probability ``miss`` at most. Each bucket is compared exactly, block against block of about ``block`` vectors, as matrix
    products. Null and zero vectors match nothing."""
    bits, tables = _projections(df.filter(F.col(vector).isNotNull()).count(), threshold, miss)
    planes: dict[int, np.ndarray] = {}

    @F.arrow_udf("struct<unit:array<float>,keys:array<bigint>>")
    def signed(vectors: pa.Array) -> pa.Array:
        rows = []
        for value in vectors.to_pylist():
            v = None if value is None else np.array(value, np.float64)
            norm = 0.0 if v is None or not len(v) else float(np.linalg.norm(v))
            if not norm or not np.isfinite(norm):
                rows.append(None)
                continue
            if len(v) not in planes:
                planes[len(v)] = np.random.default_rng([seed, len(v)]).standard_normal((tables * bits, len(v)))
            sign = (planes[len(v)] @ v > 0).reshape(tables, bits)
            keys = (sign @ (1 << np.arange(bits))) * tables + np.arange(tables)
            rows.append({"unit": (v / norm).astype(np.float32).tolist(), "keys": keys.tolist()})
        return pa.array(rows, pa.struct([("unit", pa.list_(pa.float32())), ("keys", pa.list_(pa.int64()))]))

    placed = settle(fenced(df.select(F.col(key).alias("id"), F.col(vector).alias("v")), s=signed("v")).filter("s IS NOT NULL").select("id", "s.*"), "signs")
    rows = placed.select("id", F.explode("keys").alias("key"), F.size("unit").alias("size"))
    counts = settle(rows.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "counts")
    rows = settle(join_unique(placed.select("id", "unit", F.explode("keys").alias("key"), F.size("unit").alias("size")), counts, ["key", "size"], "inner", sizes="n"), "buckets")
    blocks = F.ceil(F.col("n") / block).cast("int")
    spread = rows.select("*", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    spread = spread.select("key", "size", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "unit")
    kind = df.schema[key].dataType.simpleString()

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        i, j = group["i"].iloc[0], group["j"].iloc[0]
        left, right = (group[group["own"] == k].reset_index(drop=True) for k in (i, j))
        if not len(left) or not len(right):
            return pd.DataFrame({"a": left["id"][:0], "b": left["id"][:0], "score": np.empty(0)})
        x, y = (np.stack(g["unit"].to_list()).astype(np.float64) for g in (left, right))
        cosines = x @ y.T
        p, q = np.nonzero(cosines >= threshold)
        a, b, score = left["id"].to_numpy()[p], right["id"].to_numpy()[q], cosines[p, q]
        swap = a > b
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        keep = (a != b) & (~swap if i == j else True)
        return pd.DataFrame({"a": a[keep], "b": b[keep], "score": np.round(score[keep], 6)})

    near = spread.groupBy("key", "size", "i", "j").applyInPandas(compare, f"a {kind}, b {kind}, score double")
    return near.groupBy("a", "b").agg(F.max("score").alias("score")).select("a", "b", F.lit("semantic").alias("method"), "score")


def passes(df: DataFrame, key: str, text: str = "text", fuzzy: Fuzzy = Fuzzy(), semantic_threshold: float | None = None, vectors: DataFrame | None = None, vector: str = "embedding") -> DataFrame:
    """Edges of all passes, cheapest first: exact, then alike, then near in meaning. Each pass sees one row of each group
    the passes before it found, so copies are never compared again. The last one takes place with a threshold; it uses
    ``vectors`` (key, vector), or encodes the texts by hashed runs of characters."""
    found = settle(exact_edges(df, key, text), "exact")
    left = df.select(key, text).join(found.select(F.col("b").alias(key)).distinct(), key, "left_anti")
    alike = settle(fuzzy_edges(left, key, text, fuzzy), "fuzzy")
    edges = found.unionByName(alike)
    if semantic_threshold is None:
        return edges
    left = settle(left.join(alike.select(F.col("b").alias(key)).distinct(), key, "left_anti"), "left")
    meant = left.select(key, embedded(text).alias(vector)) if vectors is None else vectors.join(left.select(key), key, "left_semi")
    return edges.unionByName(semantic_edges(meant, key, vector, semantic_threshold))


def nearest(df: DataFrame, queries: DataFrame, key: str, vector: str = "embedding", threshold: float = 0.4, block: int = 2000) -> DataFrame:
    """(query, key, score) for every row whose cosine with a query reaches ``threshold``. Exact: the stated queries go
    past all rows in blocks of ``block`` vectors, each a matrix product in the tasks that read the rows."""
    spark = df.sparkSession
    found, last = None, None
    wanted = settle(queries.select(F.col(key).alias("id"), F.col(vector).alias("v")).filter("v IS NOT NULL AND id IS NOT NULL"), "queries")
    while True:
        part = wanted if last is None else wanted.filter(F.col("id") > last)
        rows = part.orderBy("id").limit(block).collect()  # one block
        if not rows:
            break
        last = rows[-1]["id"]
        q = np.array([r["v"] for r in rows], np.float64)
        q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
        shared = spark.sparkContext.broadcast(([r["id"] for r in rows], q))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, matrix = shared.value
            for batch in batches:
                keys, vectors = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                out = ([], [], [])
                for k, v in zip(keys, vectors):
                    if v is None or len(v) != matrix.shape[1]:
                        continue
                    x = np.array(v, np.float64)
                    norm = np.linalg.norm(x)
                    if not norm:
                        continue
                    scores = matrix @ (x / norm)
                    for i in np.flatnonzero(scores >= threshold):
                        out[0].append(ids[i])
                        out[1].append(k)
                        out[2].append(float(scores[i]))
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", key, "score"])

        here = df.select(F.col(key).cast("bigint").alias(key), vector).mapInArrow(scan, f"query_id bigint, {key} bigint, score double")
        found = here if found is None else found.unionByName(here)
    return found if found is not None else spark.createDataFrame([], f"query_id bigint, {key} bigint, score double")


def resolve(df: DataFrame, key: str, edges: DataFrame, scores: DataFrame | None = None, score: str = "score") -> DataFrame:
    """(key, component, kept, is_kept): each row's group and the one that stays: the highest score, then the least key.
    A missing score counts as 0. Rows without an edge are groups of one."""
    found = connected_components(settle(edges.select("a", "b"), "edges"))
    ids = df.select(F.col(key).alias("node")).distinct()
    placed = ids.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    if scores is not None:
        best = scores.groupBy(F.col(key).alias("node")).agg(F.max(score).alias("score"))
        placed = placed.join(best, "node", "left")
    else:
        placed = placed.withColumn("score", F.lit(None).cast("double"))
    placed = placed.withColumn("score", F.coalesce("score", F.lit(0.0)))
    placed = settle(placed, "placed")
    kept = placed.groupBy("component").agg(F.min_by("node", F.struct(-F.col("score"), F.col("node"))).alias("kept"), F.count(F.lit(1)).alias("n"))
    out = join_unique(placed, kept, ["component"], "inner", sizes="n")
    return out.select(F.col("node").alias(key), "component", "kept", (F.col("node") == F.col("kept")).alias("is_kept"))


def survivors(df: DataFrame, key: str, resolved: DataFrame) -> DataFrame:
    """The rows of ``df`` that stay."""
    return df.join(resolved.filter("NOT is_kept").select(key), key, "left_anti")


def report(resolved: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """(removed, kept, reason) for each row that goes; the reason is the surest method among its edges."""
    order = F.when(F.col("method") == "exact", 0).when(F.col("method") == "fuzzy", 1).otherwise(2)
    ends = edges.select(F.col("a").alias(key), order.alias("o")).union(edges.select("b", order))
    reasons = ends.groupBy(key).agg(F.min("o").alias("o"))
    names = F.element_at(F.array(F.lit("exact"), F.lit("fuzzy"), F.lit("semantic")), F.col("o") + 1)
    return resolved.filter("NOT is_kept").join(reasons, key, "left").select(F.col(key).alias("removed"), "kept", names.alias("reason"))


def stats(df: DataFrame, key: str, resolved: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: files, unique files, rows removed by reason, and the rate in percent."""
    removed = report(resolved, key, edges)
    counts = removed.agg(F.count_if(F.col("reason") == "exact").alias("exact_duplicates"), F.count_if(F.col("reason") == "fuzzy").alias("fuzzy_duplicates"), F.count_if(F.col("reason") == "semantic").alias("semantic_duplicates"), F.count(F.lit(1)).alias("total_duplicates_removed"))
    total = df.agg(F.countDistinct(key).alias("total_files"))
    both = total.crossJoin(counts)  # one row each
    return both.select("total_files", (F.col("total_files") - F.col("total_duplicates_removed")).alias("unique_files"), *counts.columns, F.round(100 * F.col("total_duplicates_removed") / F.greatest("total_files", F.lit(1)), 2).alias("rate_percent"))
