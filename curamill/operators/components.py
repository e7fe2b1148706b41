"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curamill.session import settle


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; ``component`` is the least node reachable.

    Labels spread along the edges and then jump to their label's label, so the rounds grow with the logarithm of a
    component's diameter rather than with the diameter. Each round is written to shared storage; only a count of
    changed labels reaches the driver. Null ends and loops are ignored, repeated edges are harmless, an empty table gives
    an empty result. A node may have any number of edges: labels are combined map-side and the labels of hubs are
    broadcast; where many nodes share a label, adaptive execution splits the join that follows it.
    """
    links = edges.select(F.col(a).alias("x"), F.col(b).alias("node")).filter("x IS NOT NULL AND node IS NOT NULL AND x <> node")
    both = settle(links.union(links.select(F.col("node").alias("x"), F.col("x").alias("node"))).distinct(), "edges")
    nodes = settle(both.groupBy("node").agg(F.count(F.lit(1)).alias("degree"), F.least(F.col("node"), F.min("x")).alias("label")), "nodes")
    total = nodes.agg(F.sum("degree")).first()[0] or 0
    # Nodes with a thousandth of all edges or more, so at most a thousand: their labels are broadcast in every round.
    hot_degree = max(1000, total // 1000)
    hubs = F.broadcast(nodes.filter(F.col("degree") >= hot_degree).select("node", F.lit(True).alias("hub")))
    both = settle(both.join(hubs, "node", "left").withColumn("hub", F.coalesce("hub", F.lit(False))), "edges")
    labels = nodes
    for _ in range(max_rounds):
        now = labels.select("node", "degree", "label")
        near = both.filter("NOT hub").join(now.select("node", "label"), "node")
        far = both.filter("hub").join(F.broadcast(now.filter(F.col("degree") >= hot_degree).select("node", "label")), "node")
        reach = near.unionByName(far).groupBy(F.col("x").alias("node")).agg(F.min("label").alias("best"))
        met = now.join(reach, "node").select("node", "degree", F.col("label").alias("old"), F.least("label", "best").alias("label"))
        # Only labels that have since got a lower one themselves lead on; a component's final label leads nowhere.
        jump = now.filter("label <> node").select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        step = met.join(jump, "label", "left").select("node", "degree", F.coalesce("beyond", "label").alias("label"), (F.coalesce("beyond", "label") != F.col("old")).alias("moved"))
        labels = settle(step, "labels")
        if labels.filter("moved").limit(1).count() == 0:
            break
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    return labels.select("node", F.col("label").alias("component"))
