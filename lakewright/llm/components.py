"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.session import materialise


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns a and b); root is the smallest reachable node.

    Each round points every neighbour of a node at the node's smallest one, first the
    larger neighbours, then the smaller. The edges of a round replace those of the one
    before, so there are never more of them, and a hot node is only ever the key of a
    minimum and of a join that Spark can split. Rounds grow with the logarithm of the
    longest path, and stop as soon as the edges are stars. Each half of a round is written to the
    shared folder: the driver keeps every plan that ran, and one of a whole round holds its first half twice.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        if stars(now):
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Every larger neighbour now points to the minimum; so does the node itself, unless it is that.
        large = materialise(large.unionByName(least.where("m < a").select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = materialise(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
    else:
        if not stars(now):
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (a > b) either has one smaller neighbour, which has none, or has none itself."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")), F.struct(F.col("b").alias("node"), F.col("b").alias("to")))
    # A centre points at itself here, so that any other pointer of it is a second one.
    of = edges.select(F.explode(ends).alias("e")).groupBy("e.node").agg(F.min("e.to").alias("low"), F.max("e.to").alias("high"))
    return of.where("low < high").isEmpty()
