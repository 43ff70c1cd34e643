"""Connected components of a graph held in a table, by alternating stars.

Each round connects every node's larger neighbours to its smallest one, then its
smaller neighbours. Rounds are aggregations and joins against one row a node, so
a node with very many links is split like any other skewed key; no neighbour list
is gathered. The number of rounds grows with the logarithm of the nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.runtime import Scratch


def components(edges: DataFrame, job: Scratch) -> DataFrame:
    """``node, component`` (the smallest node reached) for all nodes of ``a, b`` links.

    Links to itself and null ends are ignored; a node without links has no row.
    """
    clean = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now, mark = job.write(clean.distinct(), "links"), None
    while True:
        # Larger neighbours go to the smallest node around, the node itself included.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = job.write(large.distinct(), "large")
        # Smaller neighbours and the node go to the smallest neighbour.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u"), F.col("m").alias("v")),
            )).alias("e"))
            .select("e.u", "e.v")
            .filter("u != v")
        )
        after = job.write(small.distinct(), "small")
        seen = after.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        job.drop(now, large)
        now = after
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        mark = tuple(seen)
