"""Connected components of a graph kept as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import land, release


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(``id``, ``component``) of every id in ``links`` (``a``, ``b``); the component is its smallest id.

    Large-star and small-star steps (Kiveris et al., 2014) alternate until the
    links no longer change, which leaves stars around the smallest ids. Minima
    are taken before each shuffle; a hub meets its links in an equi-join that
    adaptive execution can split.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, state = land(spark, edges, "links"), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = land(spark, large, "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        before, edges = edges, land(spark, small, "links")
        release(spark, before, large)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    ends = edges.select("v").distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(ends.select("v", "v"))
