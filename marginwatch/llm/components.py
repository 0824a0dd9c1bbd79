"""Connected components of links between ids, by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def connected_components(links: DataFrame) -> DataFrame:
    """Of links (a, b): one row (id, component) per id that has a link, component the smallest id it
    reaches. Each step hooks neighbours to the smallest neighbour, in two aggregations that combine map-side;
    the number of steps grows with the logarithm of the longest path. Nothing but a count reaches the driver."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = staged(edges, "edges"), None
    while True:
        # Large star: larger neighbours of u go to the smallest of u and its neighbours.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: u and its smaller neighbours go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct()
        edges = staged(small, "edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
