"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.sources import io as IO


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of the edges (a, b).

    Each round hooks every node to the least of its neighbours, first the
    larger neighbours of a node, then the smaller ones; it ends when no node
    that is hooked to has a smaller one. The table of least neighbours is
    written before it is joined, so that a node with very many edges is split
    over tasks by the join. Nothing but a flag reaches the driver.
    """
    spark = edges.sparkSession
    run = f"components-{uuid.uuid4().hex}"
    now, turn = edges.filter("a <> b").select("a", "b"), 0
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = IO.materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")),
                               spark, f"{run}/{turn}-large")
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
                 .filter("a <> b").distinct())
        large = IO.materialize(large, spark, f"{run}/{turn}-hooked")  # every a is larger than its b
        least = IO.materialize(large.groupBy("a").agg(F.min("b").alias("least")), spark, f"{run}/{turn}-small")
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
                 .unionByName(least.select("a", F.col("least").alias("b"))).distinct())
        now = IO.materialize(small, spark, f"{run}/{turn}")
        turn += 1
        if now.join(now.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
