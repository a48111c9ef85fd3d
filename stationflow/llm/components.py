"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.support import staged


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free sum over the edges: equal before and after only if nothing moved."""
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("u", "v"), 16))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two columns of comparable ids); root is the smallest node reachable.

    Links may repeat, run either way or join a node to itself; null ends are
    ignored. Each round writes its edges and its minima below the shared folder,
    so that joins start from plain scans, which adaptive execution splits where
    one node has very many links.
    """
    first, second = links.columns
    both = links.select(F.col(first).alias("a"), F.col(second).alias("b")).where("a is not null and b is not null")
    edges = staged(both.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    loops = both.where("a = b").select(F.col("a").alias("u"), F.col("a").alias("v"))
    state = _state(edges)
    while state[0]:
        around = edges.union(edges.select("v", "u"))
        least = staged(around.groupBy("u").agg(F.min("v").alias("m")), "minima")
        large = staged(
            around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.union(edges.select("v", "v")).union(loops).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
