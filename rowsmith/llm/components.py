"""Connected components of a table of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.session import scratch_dir


def components(links: DataFrame) -> DataFrame:
    """``v`` and ``label`` (the smallest vertex of its component) of each vertex of links (a, b).

    Alternating large-star and small-star steps: each vertex's neighbours are linked to its smallest
    neighbour, which halves distances. No neighbourhood is gathered: the smallest neighbour is an
    aggregate, and joining it back can be split where a vertex has many links. Every step is written
    to the shared scratch folder, which cuts the lineage.
    """
    spark = links.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = scratch_dir(spark, "links")
        df.write.parquet(path)
        return spark.read.parquet(path)

    edges = links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = written(edges.distinct())
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        above = both.filter(F.col("b") > F.col("a")).join(least, "a")
        large = above.select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = large.filter(F.col("a") != F.col("b")).distinct()
        low = stars.groupBy("a").agg(F.min("b").alias("m"))
        below = stars.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = below.union(low.select("a", F.col("m").alias("b")))
        edges = written(small.filter(F.col("a") != F.col("b")).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    ends = edges.select("b").distinct()
    return edges.select(F.col("a").alias("v"), F.col("b").alias("label")).union(ends.select("b", F.col("b")))
