"""Connected components of an edge table, by alternating star steps on DataFrames.

Each step replaces a node's edges by edges to its smallest neighbour; the edges
become one star per component. Nothing is collected but one count per step;
minima are combined before the shuffle, and a hub's edges are split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import materialize


def stars(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """(node, root): every node that has an edge in ``edges`` (a, b), roots included, with its component's smallest node."""
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star-edges")
    for _ in range(max_steps):
        # large star: larger neighbours move to the smallest node around
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = (both.join(around, both.a == around.n).where("b > n").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = (large.join(least, large.a == least.n).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                                            F.col("m").alias("b")).unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
                 .where("a <> b").distinct())
        new = materialize(small, "star-edges")
        # stars: no node is both a child and a root, and each child has one root
        edges = new
        sides = new.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            new.select(F.col("b").alias("a"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        unsettled = sides.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)")
        if not unsettled.take(1):
            break
    else:
        raise RuntimeError("components didn't settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
