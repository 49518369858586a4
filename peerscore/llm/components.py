"""Connected components of an edge table, with DataFrames only.

Alternating large-star and small-star steps: every step replaces a node's edges by edges to its
smallest neighbour, until each component is one star around its smallest node. A star's hub may have
any number of neighbours: both sides of each join are stored tables, so adaptive execution can split
a hub's partition, and all minima are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.common import saved


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``u, v`` edges to rows ``u, v``: every node but a component's smallest, and that smallest node.

    Nodes may be of any ordered type. NULL ends and loops are dropped; repeated edges count once.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e = saved(e.distinct())
    mark = _mark(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = saved(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = saved(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, mark = mark, _mark(e)
        if mark == before:
            return e
