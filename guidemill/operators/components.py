"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guidemill.sources.tables import remove, written


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node that the edges reach, for every node on an edge. Nodes may be of any type that has an order; edges with a null don't count.

    Large-star and small-star steps in turn. Each is a min by node, which Spark adds up before the shuffle, and an inner join that adaptive
    execution can split, so a node with a third of all edges is no one task's work. The edges of each round are written, not kept by lineage."""
    named = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null")
    now = written(named.distinct(), "edges")
    loops = written(now.where("u = v").select(F.col("u").alias("node")), "loops")
    first, now = now, written(now.where("u <> v"), "edges")
    remove(first)
    mark = None
    while True:
        both = now.union(now.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select("v", "m").where("v <> m").distinct().toDF("u", "v")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = down.groupBy("u").agg(F.min("v").alias("m"))
        after = down.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m").toDF("u", "v")).where("u <> v").distinct()
        after = written(after, "edges")
        remove(now)
        now = after
        got = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(got) == mark:
            break
        mark = tuple(got)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    alone = loops.join(nodes.select("node").union(now.select("v")), "node", "left_anti").select("node", F.col("node").alias("component"))
    return nodes.union(now.select("v", "v")).union(alone).toDF("node", "component").distinct()
