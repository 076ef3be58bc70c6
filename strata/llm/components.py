"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node in
    ``links``. Each round is written to the shared folder; rounds go on until
    no link changes, about the logarithm of the longest chain. A node's
    neighbours are never gathered: stars are minima joined back to the links."""
    a, b = F.col(u), F.col(v)
    edges = stored(links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        star = large.join(small, F.col("u") == F.col("k"))
        edges = stored(star.select("u", "m").union(star.select("v", "m")).toDF("u", "v").filter("u <> v").distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
