"""The summary-based gold tables equal direct aggregation over the events,
including NULL listing ids, types, cities, prices and times."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierlake.operators import aggregates as agg
from tierlake.operators import dimensions as dims
from tierlake.operators import star
from tierlake.schemas import AGENT, SILVER_EVENT

rows = st.lists(st.tuples(
    st.one_of(st.none(), st.sampled_from(["1", "2", "3", "4"])),               # listing_id
    st.one_of(st.none(), st.sampled_from(["NEW_LISTING", "PRICE_CHANGE", "REMOVED"])),
    st.one_of(st.none(), st.sampled_from(["A", "B"])),                         # city
    st.sampled_from(["x", "y"]),                                               # locality
    st.one_of(st.none(), st.integers(-5, 50)),                                 # price
    st.sampled_from(["a1", "a2", "a3"]),                                       # agent
    st.one_of(st.none(), st.sampled_from([1, 2, 3])),                          # day
), min_size=1, max_size=25)


def canon(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def to_silver(spark, data):
    out = [(lid, et, city, loc, price, 2, 500, agent,
            datetime(2024, 1, day, 6) if day else None, datetime(2024, 1, 31))
           for lid, et, city, loc, price, agent, day in data]
    return spark.createDataFrame(out, SILVER_EVENT)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_market_rollups_equal_direct(spark, data):
    s = to_silver(spark, data)
    pr = s.filter((F.col("event_type") != "REMOVED") & (F.col("price") > 0))
    direct1 = pr.groupBy("city").agg(
        F.round(F.avg("price"), 2).alias("avg_price"), F.max("price").alias("max_price"),
        F.min("price").alias("min_price"), F.count("listing_id").alias("total_listings"))
    assert canon(agg.avg_price_by_city(s, ordered=False)) == canon(direct1)
    direct2 = s.groupBy("event_type").agg(F.count("listing_id").alias("total_count"))
    assert canon(agg.listing_count_by_event(s, ordered=False)) == canon(direct2)
    day = F.date_trunc("day", "event_timestamp").alias("event_date")
    direct3 = pr.groupBy("city", "locality", day).agg(
        F.round(F.avg("price"), 2).alias("avg_price"),
        F.count("listing_id").alias("listing_count"))
    assert canon(agg.price_trend_by_locality(s, ordered=False)) == canon(direct3)
    direct4 = s.groupBy("city").agg(
        F.count("listing_id").alias("total_events"),
        F.count_if(F.col("event_type") == "NEW_LISTING").alias("new_listings"),
        F.count_if(F.col("event_type") == "PRICE_CHANGE").alias("price_changes"),
        F.count_if(F.col("event_type") == "REMOVED").alias("removals"))
    assert canon(agg.top_active_cities(s, ordered=False)) == canon(direct4)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_agent_rollups_equal_direct(spark, data):
    s = to_silver(spark, data)
    dim = dims.scd2_init(spark.createDataFrame(
        [("a1", "A one", "C", "T1", 1.0, 1), ("a2", "A two", "C", "T1", 2.0, 2)], AGENT),
        "2024-01-01 00:00:00")
    pos = F.when(F.col("price") > 0, F.col("price"))
    j = s.join(dim, "agent_id")
    direct5 = j.groupBy("agent_id", "agent_name", "base_city", "tier", "rating",
                        "total_deals").agg(
        F.count("listing_id").alias("total_listings"),
        F.count_if(F.col("event_type") == "NEW_LISTING").alias("new_listings"),
        F.count_if(F.col("event_type") == "PRICE_CHANGE").alias("price_changes"),
        F.count_if(F.col("event_type") == "REMOVED").alias("removals"),
        F.round(F.avg(pos), 2).alias("avg_listing_price"),
        F.max("price").alias("max_listing_price"), F.min(pos).alias("min_listing_price"))
    assert canon(star.agent_performance(s, dim, ordered=False)) == canon(direct5)
    direct8 = s.groupBy("agent_id", F.col("city").alias("listing_city")).agg(
        F.count("listing_id").alias("listings_in_city"),
        F.round(F.avg(pos), 2).alias("avg_price_in_city"))
    got8 = star.agent_city_movement(s, dim, ordered=False).select(
        "agent_id", "listing_city", "listings_in_city", "avg_price_in_city")
    assert canon(got8) == canon(direct8.join(dim.select("agent_id"), "agent_id"))
