"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.scratch import write_shared


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """Label every node of edges (u, v) with the smallest node that it reaches: columns node, component.

    Both steps keep reachability and point nodes at ever smaller neighbours until each component is a star. A node's
    neighbours are only ever aggregated (min) and joined, never gathered. Nulls and loops are ignored; no edges give
    no rows.
    """
    big, small = F.greatest("u", "v"), F.least("u", "v")
    edges = write_shared(edges.where("u <> v").select(big.alias("u"), small.alias("v")).distinct(), "edges")
    seen = None
    while (now := _state(edges)) != seen:
        seen = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = write_shared(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = write_shared(star.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "small")
    rooted = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return rooted.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
