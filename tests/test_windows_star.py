"""Ranking windows and the star-join tables on hand-written rows."""

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from tierlake.operators import aggregates as agg
from tierlake.operators import dimensions as dims
from tierlake.operators import star, windows
from tierlake.schemas import AGENT, SILVER_EVENT

LOAD = datetime(2024, 1, 31)


def ev(lid, agent, city="ASIA", et="NEW_LISTING", price=100, day=2, loc="N1"):
    return (lid, et, city, loc, price, 2, 600, agent, datetime(2024, 1, day, 12), LOAD)


def test_rank_within_matches_sql_rank_with_ties(spark):
    rows = [("T1", "a", 10), ("T1", "b", 10), ("T1", "c", 7), ("T1", "d", 3),
            ("T2", "e", 5), (None, "f", 1), (None, "g", 1)]
    df = spark.createDataFrame(rows, "tier string, agent string, n long")
    got = {r.agent: (r.rank, r.total) for r in
           windows.rank_within(df, "tier", "n", "rank", "total").collect()}
    w = Window.partitionBy("tier").orderBy(F.desc("n"))
    ref = {r.agent: (r.rank, r.total) for r in df.select(
        "agent", F.rank().over(w).alias("rank"),
        F.sum("n").over(Window.partitionBy("tier")).alias("total")).collect()}
    assert got == ref
    assert got["a"][0] == got["b"][0] == 1 and got["c"][0] == 3


def test_dense_rank_and_lag(spark):
    rows = [ev("1", "a", city="A", price=100, day=1), ev("2", "a", city="B", price=300, day=1),
            ev("3", "a", city="C", price=300, day=1), ev("4", "a", city="A", price=150, day=2)]
    s = spark.createDataFrame(rows, SILVER_EVENT)
    dr = {(r.city, r.event_date.day): r.price_rank
          for r in windows.dense_rank_cities_by_day(s).collect()}
    assert dr == {("B", 1): 1, ("C", 1): 1, ("A", 1): 2, ("A", 2): 1}
    lag = {(r.city, r.event_date.day): (r.prev_avg_price, r.price_change)
           for r in windows.price_trend_lag(s).collect()}
    assert lag[("A", 1)] == (None, None) and lag[("A", 2)] == (100.0, 50.0)


def test_gold_tables_on_small_rows(spark):
    rows = [ev("1", "a", price=100), ev("2", "a", et="REMOVED", price=0),
            ev("3", "b", city="EUROPE", price=300), ev("4", "b", city="EUROPE", et="PRICE_CHANGE", price=500),
            ev("5", "x", price=50)]                      # agent x is not in the dimension
    s = spark.createDataFrame(rows, SILVER_EVENT)
    dim = dims.scd2_init(spark.createDataFrame(
        [("a", "A", "C1", "Gold", 4.0, 1), ("b", "B", "C2", "Gold", 3.0, 2)], AGENT),
        "2024-01-01 00:00:00")
    perf = {r.agent_id: r for r in star.agent_performance(s, dim).collect()}
    assert set(perf) == {"a", "b"}
    assert (perf["a"].total_listings, perf["a"].removals, perf["a"].min_listing_price) == (2, 1, 100)
    assert perf["b"].avg_listing_price == 400.0 and perf["b"].max_listing_price == 500
    bench = {(r.agent_id, r.city): r for r in star.agent_vs_city_benchmark(s, dim).collect()}
    # ASIA average covers agent x too: (100 + 50) / 2 = 75
    assert bench[("a", "ASIA")].city_avg_price == 75.0
    assert bench[("a", "ASIA")].performance_flag == "ABOVE AVERAGE"
    assert bench[("a", "ASIA")].pct_above_city_avg == 33.33
    top = {r.agent_id: (r.rank_within_tier, r.pct_of_tier_listings)
           for r in star.top_agents_by_tier(s, dim).collect()}
    assert top == {"a": (1, 50.0), "b": (1, 50.0)}
    cities = {r.city: r for r in agg.top_active_cities(s).collect()}
    assert (cities["ASIA"].total_events, cities["ASIA"].removals) == (3, 1)
    assert {r.city: r.total_listings for r in agg.avg_price_by_city(s).collect()} == \
        {"ASIA": 2, "EUROPE": 2}


def test_movement_and_pre_post(spark):
    rows = [ev("1", "a", price=100, day=3), ev("2", "a", price=300, day=20),
            ev("3", "b", price=10, day=3)]
    s = spark.createDataFrame(rows, SILVER_EVENT)
    init = dims.scd2_init(spark.createDataFrame(
        [("a", "A", "C1", "Gold", 4.0, 1), ("b", "B", "C2", "Gold", 3.0, 2)], AGENT),
        "2024-01-01 00:00:00")
    hist = dims.scd2_apply(init, spark.createDataFrame([("a", "A", "C9", "Gold", 4.0, 1)], AGENT),
                           as_of="2024-01-15 00:00:00")
    mv = sorted((r.agent_id, r.scd_version, r.agent_status, r.listings_in_city)
                for r in star.agent_city_movement(s, hist).collect())
    assert mv == [("a", 1, "MOVED CITY", 2), ("a", 2, "MOVED CITY", 2), ("b", 1, "STABLE", 1)]
    pp = sorted((r.agent_id, r.scd_version, r.base_city, r.listings, r.avg_price)
                for r in star.pre_post_move(s, hist).collect())
    assert pp == [("a", 1, "C1", 1, 100.0), ("a", 2, "C9", 1, 300.0), ("b", 1, "C2", 1, 10.0)]


def test_report_orders(spark):
    from tierlake.queries import QUERIES
    from conftest import SF_SMALL

    def sequence(key, *cols):
        return [tuple(r[c] for c in cols) for r in QUERIES[key](spark, SF_SMALL).collect()]

    for key, col in (("gold_avg_price_by_city", "avg_price"), ("gold_agent_performance", "total_listings"),
                     ("gold_agent_vs_city_benchmark", "pct_above_city_avg")):
        found = sequence(key, col)
        assert found == sorted(found, reverse=True), key
    for key, cols in (("gold_top_agents_by_tier", ("tier", "rank_within_tier")),
                      ("gold_agent_city_movement", ("agent_id", "scd_version"))):
        found = sequence(key, *cols)
        assert found == sorted(found), key
