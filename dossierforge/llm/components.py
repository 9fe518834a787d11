"""Connected components by alternating large and small stars; edges and labels stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _least(both: DataFrame) -> DataFrame:
    """u, v with m: the least node among u and its neighbours. The minimum is combined before the shuffle, and hot nodes are split by the join."""
    m = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("mu"), F.least("u", "m").alias("m"))
    return both.join(m, F.col("u") == F.col("mu")).drop("mu")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges(u, v), component being the least node that it reaches. Loops and repeated edges are harmless."""
    now = common.store(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(m.select(F.col("u").alias("mu"), "m"), F.col("u") == F.col("mu"))
        small = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(m.select("u", F.col("m").alias("v"))).distinct()
        after = common.store(small, "edges")
        # at the end every node has one edge, to a node that has none
        loose = after.join(after.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").limit(1).count() + after.groupBy("u").count().where("count > 1").limit(1).count()
        common.drop(now)
        now = after
        if not loose:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
