"""Ranking and trend windows.

``rank_within`` replaces ``RANK() OVER (PARTITION BY g ORDER BY x DESC)``
for groups that can be huge and few (five tiers), with many distinct values
each: no task sorts, or runs a window over, a whole group.

The daily windows (dense rank of cities per day, day-over-day change per
city) run on already aggregated rows: a partition holds one row per city
or per calendar day, bounded by the calendar, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.operators.aggregates import daily_city_prices_from, market_facts
from tierlake.session import scratch_path


CHUNK_RANGES = 512             # ranges whose counts are summed together


def _sum_before(counts: str, at: Column) -> Column:
    """The sum of ``n`` over the entries (at, n) of an array that lie before ``at``."""
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, o: a + F.when(o["at"] < at, o["n"]).otherwise(0))


def rank_within(df: DataFrame, group: str, value: str, rank_col: str = "rank",
                total_col: str | None = None, ranges: int | None = None) -> DataFrame:
    """Add SQL ``RANK()`` of ``value`` (descending) within ``group``.

    With ``total_col`` also add ``SUM(value) OVER (PARTITION BY group)``.

    The histogram of (group, value) is sorted by range partitioning, so a group with many values
    spreads over many ranges; it is written with its range numbers (a recomputed range could
    have other bounds).  A value's rank is one more than the rows in the group's ranges before
    its own (prefix sums over one row per group and range, in two levels, so that their cost does
    not grow with the square of the ranges) and before it in its range (a window over a group's
    part of one range).  The ranks are joined back to the rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "rank")
    hist = (df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
            .withColumnRenamed(group, "_g").withColumnRenamed(value, "_x"))
    keys = [F.col("_g"), F.desc("_x")]
    sorted_ = hist.repartitionByRange(ranges, *keys) if ranges else hist.repartitionByRange(*keys)
    sorted_.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    hist = spark.read.parquet(path)

    per_range = hist.groupBy("_g", "_range").agg(F.sum("_n").alias("n"), F.sum(F.col("_n") * F.col("_x")).alias("t"))
    # prefix sums in two levels: over chunks of ranges, then over the ranges of a chunk
    chunks = per_range.groupBy("_g", F.expr(f"_range div {CHUNK_RANGES}").alias("at")).agg(
        F.sum("n").alias("n"), F.sum("t").alias("t"), F.collect_list(F.struct(F.col("_range").alias("at"), "n")).alias("r"))
    lists = chunks.groupBy("_g").agg(F.collect_list(F.struct("at", "n", "r")).alias("c"), F.sum("t").alias("_total"))
    chunks = lists.select("_g", "_total", F.explode(F.transform("c", lambda e: F.struct(
        e["r"].alias("r"), _sum_before("c", e["at"]).alias("n")))).alias("c"))
    ranges_ = chunks.select("_g", "_total", F.explode(F.transform("c.r", lambda e: F.struct(
        e["at"].alias("at"), (F.col("c.n") + _sum_before("c.r", e["at"])).alias("n")))).alias("b"))
    offsets = ranges_.select(F.col("_g").alias("_og"), "_total", F.col("b.at").alias("_or"), F.col("b.n").alias("_before"))
    above = Window.partitionBy("_range", "_g").orderBy(F.desc("_x")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = hist.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0)))
    ranked = ranked.join(offsets, (F.col("_range") == F.col("_or")) & F.col("_g").eqNullSafe(F.col("_og")))
    cols = [F.col("_g"), F.col("_x"), (F.col("_before") + F.col("_above") + 1).cast("long").alias(rank_col)]
    if total_col:
        cols.append(F.col("_total").alias(total_col))
    # null-safe on both keys: NULL groups/values rank among themselves as SQL does
    cond = F.col(group).eqNullSafe(F.col("_g")) & F.col(value).eqNullSafe(F.col("_x"))
    return df.join(ranked.select(*cols), cond, "inner").drop("_g", "_x")


def daily_city_prices(silver: DataFrame) -> DataFrame:
    return daily_city_prices_from(market_facts(silver))


def dense_rank_cities_by_day(silver: DataFrame) -> DataFrame:
    """Per day, cities ranked by average asking price (DENSE_RANK)."""
    daily = daily_city_prices(silver)
    w = Window.partitionBy("event_date").orderBy(F.desc("avg_price"))
    return daily.withColumn("price_rank", F.dense_rank().over(w).cast("long"))


def price_trend_lag(silver: DataFrame) -> DataFrame:
    """Per city and day, average price and its change against the city's
    previous day with data (LAG)."""
    daily = daily_city_prices(silver)
    w = Window.partitionBy("city").orderBy("event_date")
    prev = F.lag("avg_price").over(w)
    return (daily.withColumn("prev_avg_price", prev)
            .withColumn("price_change", F.round(F.col("avg_price") - F.col("prev_avg_price"), 2)))
