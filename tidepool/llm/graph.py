"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.shared import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node of the edges a, b that is not the
    smallest of its component.  Each round hangs every node under the smallest neighbour of its
    smaller neighbours; the rounds grow with the logarithm of the component's size.  Only minima
    are aggregated (combined map-side), so the centre of a large star is never gathered."""
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    e = materialise(edges.select(u, v).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        lowest = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(F.min("v").alias("m"))
        lowest = lowest.select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = e.join(lowest, "v").select("u", F.col("m").alias("w")).distinct()
        least = large.groupBy("u").agg(F.min("w").alias("m"))
        small = large.join(least, "u").where("w <> m").select(F.col("w").alias("u"), F.col("m").alias("v"))
        e = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now
