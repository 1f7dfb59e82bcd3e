"""Connected components of an edge table by joins, written after every round."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.session import scratch_path


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the cluster's shared folder: lineage ends there, and a
    lost executor costs a reread."""
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def shuffled_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join that never sends a side through the driver; of a key, only rows of ``right`` are held.

    Spark takes a table for as small as its compressed file and as no larger after an explode,
    so rows that are sent to many places would be broadcast far above the threshold."""
    return left.hint("merge").join(right, on)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (columns a, b: long, not null);
    component is the smallest id that can be reached.

    Alternates large-star and small-star rounds: every id hangs its larger, then its
    smaller neighbours onto the smallest id it knows.  The number of edges does not
    grow, hubs are only aggregated over, and chains of n take about log n rounds.
    Repeated edges and loops change nothing; no edges give an empty table.
    """
    e = written(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("u <> v").distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = written(spark, large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))
                 .where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        new = written(spark, small, "small_star")
        same = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        was = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        e = new
        if same == was:
            break
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    out = e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
    return out
