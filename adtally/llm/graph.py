"""Connected components by contracting stars, one staged table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.session import stage

#: Links that one task writes, if all cores have some.
STAGED_LINKS = 500_000


def _towards(edges: DataFrame, smaller: bool) -> DataFrame:
    """Link the neighbours of every node with the least of them.

    ``smaller``: only neighbours below the node take part, and the node itself
    does; otherwise those above it take part. The least neighbour comes from a
    grouped minimum that is joined back, so a node with very many neighbours
    is combined before the shuffle and its join can be split.
    """
    both = edges if smaller else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    joined = both.join(least, "a")
    if smaller:
        links = joined.select(F.col("b").alias("x"), "low").union(least.select(F.col("a").alias("x"), "low"))
    else:
        links = joined.where("b > a").select(F.col("b").alias("x"), "low")
    return links.where("x > low").select(F.col("x").alias("a"), F.col("low").alias("b")).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node.

    Each round replaces the links by ones towards smaller nodes (the large-star
    and small-star steps of Kiveris et al., 2014) and ends when nothing
    changes. Nulls take no part.
    """
    spark = links.sparkSession
    cores = spark.sparkContext.defaultParallelism
    edges = links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
    edges = stage(spark, edges.where("a > b").distinct(), "links")
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = now
        # As many files as the links of the last round are worth, not one for each shuffle partition.
        files = max(cores, now[0] // STAGED_LINKS)
        edges = stage(spark, _towards(_towards(edges, smaller=False), smaller=True).coalesce(files), "links")
