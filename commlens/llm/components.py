"""Connected components of an edge table by alternating large and small stars.

Edges, never nodes of a component, are what a task holds; minima are taken with partial aggregation and written before
their joins, so that both sides of a join are plain exchanges and adaptive execution can split a hub's edges.  Each
round is written to the shared folder, and what the round before wrote is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commlens.llm.common import dropped, written


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """Of (u, v) longs: a row (node, root) for each node of an edge; root is the smallest node reachable.

    Null ends and self loops are left out; repeated edges count once; an empty table gives no row.
    """
    e = edges.select("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, before = written(e, name), None
    while True:
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 31))).first())
        if now == before or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v")).distinct()
        before = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = written(large.distinct(), name)
        dropped(low)
        dropped(e)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        e = written(small.distinct(), name)
        dropped(least)
        dropped(large)
