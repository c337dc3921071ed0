"""Connected components of a large edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, stored


def connected_components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Each round links all neighbours of a node to the smallest one, first the larger neighbours, then
    the smaller ones, until every edge leads to the smallest node of its component (a number of rounds
    logarithmic in the longest path).  Minima are combined map-side, so a hub isn't gathered anywhere.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, now = now, stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        discard(before)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
