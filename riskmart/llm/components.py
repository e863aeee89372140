"""Connected components by contraction: every node points to its smallest neighbour, pointers are followed, and edges
between what is left go on. Rounds grow with the logarithm of the longest chain; each ends in a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm import store


def labels(links: DataFrame) -> DataFrame:
    """`links` (a, b) -> (node, label): the smallest node reachable, for every node that has a link to another."""
    edges = store.stage(links.where("a <> b").select("a", "b").distinct(), "links")
    result = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        up = store.stage(both.groupBy("node").agg(F.min("other").alias("least")).select(
            "node", F.least("node", "least").alias("up")), "up")
        ups = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        up = store.stage(up.join(ups, "up").select("node", F.col("top").alias("up")), "up")
        if result is None:
            result = up.select("node", F.col("up").alias("label"))
        else:
            moved = up.select(F.col("node").alias("label"), "up")
            result = result.join(moved, "label", "left").select("node", F.coalesce("up", "label").alias("label"))
        result = store.stage(result, "labels")
        left, right = (up.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in ("a", "b"))
        edges = store.stage(edges.join(left, "a").join(right, "b").where("a_up <> b_up").select(
            F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")) if result is None else result
