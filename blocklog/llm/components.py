"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklog.session import Staging


def connected_components(edges: DataFrame, stage: Staging) -> DataFrame:
    """(node, component) for every end of a link; `edges` has the columns a and b, the component is its least node.

    Each round is two aggregations by node that combine on the map side and two joins that skew handling can
    split; the rounds, of which there are about as many as the logarithm of the longest chain, are staged, so a
    lost executor repeats one at most. Only a row count and a checksum come to the driver.
    """
    now = stage.table(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if seen.n == 0 or (seen.n, seen.s) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component"))
            ).distinct()
        mark = (seen.n, seen.s)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Staged, so that the join deals both sides by a shuffle of its own and a hot node's rows can be split.
        least = stage.table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least-of-all")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage.table(large.where("u <> v").distinct(), "large-star")
        least = stage.table(large.groupBy("u").agg(F.min("v").alias("m")), "least-of-large")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = stage.table(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "small-star")
