"""Connected components of a link table, in Spark: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import checkpoint


def _nearest(links: DataFrame) -> DataFrame:
    """Each (u, v) with m, the least of u's neighbours; a node with many links is an ordinary skewed join key."""
    return links.join(links.groupBy("u").agg(F.min("v").alias("m")), "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that ``links`` (a, b: long) joins to another; the component is its least node.

    Null ends and links of a node to itself are left out; repeated links count once. No links give no rows.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, seen = checkpoint(links), None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _nearest(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = _nearest(large)
        small = small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        links = checkpoint(small.distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            roots = links.select("v").distinct()
            return links.union(roots.select(F.col("v").alias("u"), "v")).select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
