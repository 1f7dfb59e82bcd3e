"""A third of all rows on one key: results stay whole and exact."""

from pyspark.sql import functions as F

from tierlake.operators import dimensions as dims
from tierlake.operators import star
from tierlake.operators.clean import clean_events
from tierlake.operators.dedup import keep_by_order
from tierlake.schemas import AGENT, BRONZE_EVENT

N = 30_000


def skewed_raw(spark):
    i = F.col("id")
    hot = i % 3 == 0                                   # a third of the rows: agent 'hot'
    copies = (i % 3 == 0) & (i < N // 2)               # ~5k exact copies of one event
    return spark.range(N).select(
        F.when(copies, F.lit("L0")).otherwise(i.cast("string")).alias("listing_id"),
        F.when(copies, F.lit("NEW_LISTING"))
        .otherwise(F.element_at(F.array(F.lit("NEW_LISTING"), F.lit("PRICE_CHANGE"),
                                         F.lit("REMOVED")), (i % 3 + 1).cast("int")))
        .alias("event_type"),
        F.lit("ASIA").alias("city"), F.lit("N1").alias("locality"),
        F.when(copies, F.lit(100)).otherwise((i % 1000 + 1)).cast("long").alias("price"),
        F.lit(2).alias("bedrooms"), F.lit(600).alias("area_sqft"),
        F.when(hot, F.lit("hot")).otherwise((i % 50).cast("string")).alias("agent_id"),
        F.when(copies, F.lit("2024-01-02T00:00:00+00:00"))
        .otherwise(F.concat(F.lit("2024-01-0"), (i % 9 + 1).cast("string"),
                            F.lit("T00:00:00+00:00"))).alias("timestamp"),
        F.lit("stream").alias("source")).select(*BRONZE_EVENT.fieldNames())


def test_dedup_and_rollups_under_skew(spark):
    raw = skewed_raw(spark)
    silver = clean_events(raw, "2024-01-31 00:00:00")
    expected = raw.select("listing_id", "event_type", "timestamp").distinct().count()
    assert silver.count() == expected
    assert silver.filter(F.col("listing_id") == "L0").count() == 1

    latest = keep_by_order(silver, ["agent_id"], ["event_timestamp", "listing_id"])
    assert latest.count() == silver.select("agent_id").distinct().count()

    dim = dims.scd2_init(spark.createDataFrame(
        [("hot", "Hot", "C", "T", 1.0, 1), ("7", "Seven", "C", "T", 1.0, 1)], AGENT),
        "2024-01-01 00:00:00")
    perf = {r.agent_id: r for r in star.agent_performance(silver, dim).collect()}
    hot_rows = silver.filter(F.col("agent_id") == "hot")
    assert perf["hot"].total_listings == hot_rows.count()
    pos = hot_rows.filter(F.col("price") > 0)
    assert perf["hot"].avg_listing_price == pos.agg(F.round(F.avg("price"), 2)).first()[0]
