"""Connected components of a link table that no single task can hold.

Alternates the two star operations of Kiveris et al. ("Connected components in
MapReduce and beyond", 2014): every node hands its larger neighbours, then its
smaller ones, to the smallest node it knows, until the links form stars.  Each
round is two aggregates and two joins, written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import drop, stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (u, v: equal types, nodes of a
    link differ) but the roots themselves; ``root`` is the smallest node that
    can be reached.  Nodes without links are not in the result."""
    spark = links.sparkSession
    edges, path = stored(links.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = None
    while True:
        # Large star: neighbours above a node go to the least one it knows.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(least, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        # Small star: so do a node and its neighbours below.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after, new = stored(small, "links")
        state = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first()
        drop(spark, path)
        edges, path = after, new
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
