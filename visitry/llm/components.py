"""Connected components by contraction: edges shrink from round to round, nothing is gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitry.llm.text import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node that has an edge.

    edges: a, b (long); repeats, both directions and loops are allowed. Each round points every node at the first of
    itself and its neighbours, in an order drawn anew by a hash, and replaces the edges by those between the nodes
    pointed at. Of the nodes with an edge, only those that come before all their neighbours remain, half of them or
    fewer on average whatever the ids and their order, so the rounds grow with the logarithm of the nodes. Firsts are
    aggregated before the shuffle, so a node with very many edges is no single task's work. An empty input gives an
    empty result.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels, turn = None, 0
    while not edges.isEmpty():
        drawn = F.struct(F.xxhash64("b", F.lit(turn)).alias("drawn"), F.col("b").alias("node"))
        own = F.struct(F.xxhash64("node", F.lit(turn)).alias("drawn"), F.col("node"))
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both.groupBy(F.col("a").alias("node")).agg(F.min(drawn).alias("first"))
        least = stored(around.select("node", F.least("first", own)["node"].alias("to")), "least")
        if labels is None:
            labels = least.withColumnRenamed("to", "root")
        else:
            moved = labels.join(least.withColumnRenamed("node", "at"), labels["root"] == F.col("at"), "left")
            labels = stored(moved.select(labels["node"], F.coalesce("to", "root").alias("root")), "labels")
        to_a, to_b = (least.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        edges = stored(
            edges.join(to_a, "a").join(to_b, "b")
            .where("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct(),
            "edges",
        )
        turn += 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    smallest = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(smallest, "root").select("node", "component")
