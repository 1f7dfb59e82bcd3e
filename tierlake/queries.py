"""Named queries over the given tables: one per operator of the inventory.

Each entry is ``f(spark, sf_dir) -> DataFrame``.  The listing-model tables
(bronze, silver, agent dimension) are derived from the given tables by the
fixtures mapping, so every query's work grows with the input.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.operators import aggregates as agg
from tierlake.operators import dimensions as dims
from tierlake.operators import quality, star, windows
from tierlake.operators.clean import clean_events
from tierlake.operators.dedup import EVENT_KEYS, duplicate_keys, keep_by_order
from tierlake.plans import catalog
from tierlake.plans.tables import Table, cluster_layout
from tierlake.schemas import AGENT
from tierlake.session import scratch_path
from tierlake.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the reference's own test queries, in our data's terms.
POINT_CITY = "ASIA"
POINT_GOLD_CITY = "EUROPE"
POINT_LOCALITY = "NATION_7"
POINT_EVENT_TYPE = "NEW_LISTING"
HISTORY_AGENT = "10"
ISIN_AGENTS = ["3", "13", "103", "1003"]
TIMELINESS_AS_OF = "2024-01-31 00:00:00"
TIMELINESS_MAX_AGE_DAYS = 7


# ---------------------------------------------------------------- shared tiers


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.listing_events(spark, sf_dir, dirty=True)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(bronze(spark, sf_dir), as_of=fx.SILVER_LOAD)


def agents_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.scd1_upsert(fx.agent_master(spark, sf_dir), fx.scd1_feed(spark, sf_dir))


def agents_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial = dims.scd2_init(agents_scd1(spark, sf_dir), fx.INITIAL_LOAD)
    return dims.scd2_apply(initial, fx.scd2_feed(spark, sf_dir), key="agent_id",
                           tracked=["base_city"], as_of=fx.CITY_MOVE)


def published(spark: SparkSession, df: DataFrame, name: str, *layout: str) -> DataFrame:
    """``df`` as readers meet it: written, clustered on ``layout`` if given."""
    path = scratch_path(spark, "published", name)
    (cluster_layout(df, layout) if layout else df).write.parquet(path)
    return spark.read.parquet(path)


def published_once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], *layout: str) -> DataFrame:
    """The application's catalog table ``name`` of the given tables; built by the first query that
    asks for it, only looked up by the others."""
    application = "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId)
    of = f"{crc32(sf_dir.rstrip('/').encode()):08x}"
    t = Table(spark, f"tierlake_{application}_{of}.{name}", scratch_path(spark, "published_once", name))
    if not t.exists():
        t.overwrite(cluster_layout(build(), layout))
    return t.read()


def agents_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.scd2_current(agents_history(spark, sf_dir))


# ---------------------------------------------------------------- queries

def q_silver_clean(spark, sf_dir):
    return silver(spark, sf_dir)


def q_dedup_latest(spark, sf_dir):
    s = silver(spark, sf_dir)
    return keep_by_order(s, ["agent_id"], ["event_timestamp", "listing_id"], latest=True)


def q_dq_report(spark, sf_dir):
    """The gates on the raw events, which do hold padded types and repeats."""
    raw = bronze(spark, sf_dir).withColumn("event_timestamp", F.col("timestamp").cast("timestamp"))
    return quality.report(raw, quality.listing_gates(), ["listing_id", "event_type", "timestamp"])


def q_dq_uniqueness(spark, sf_dir):
    return duplicate_keys(bronze(spark, sf_dir), ["listing_id", "event_type", "timestamp"])


def q_dq_timeliness(spark, sf_dir):
    gates = [quality.timeliness_gate(TIMELINESS_AS_OF, TIMELINESS_MAX_AGE_DAYS)]
    return quality.report(silver(spark, sf_dir), gates)


def q_filter_isin(spark, sf_dir):
    return fx.agent_master(spark, sf_dir).filter(F.col("agent_id").isin(ISIN_AGENTS))


def q_gold_avg_price_by_city(spark, sf_dir):
    return agg.avg_price_by_city(silver(spark, sf_dir))


def q_gold_listing_count_by_event(spark, sf_dir):
    return agg.listing_count_by_event(silver(spark, sf_dir))


def q_gold_price_trend_by_locality(spark, sf_dir):
    return agg.price_trend_by_locality(silver(spark, sf_dir))


def q_gold_top_active_cities(spark, sf_dir):
    return agg.top_active_cities(silver(spark, sf_dir))


def q_point_filter_count(spark, sf_dir):
    s = published_once(spark, sf_dir, "silver", lambda: silver(spark, sf_dir), "city", "event_type")
    return s.filter((F.col("city") == POINT_CITY) & (F.col("event_type") == POINT_EVENT_TYPE)) \
        .agg(F.count(F.lit(1)).alias("count"))


def q_point_filter_city(spark, sf_dir):
    prices = published_once(spark, sf_dir, "avg_price_by_city",
                            lambda: agg.avg_price_by_city(silver(spark, sf_dir), ordered=False), "city")
    return prices.filter(F.col("city") == POINT_GOLD_CITY)


def q_point_filter_locality(spark, sf_dir):
    trend = published_once(spark, sf_dir, "price_trend",
                           lambda: agg.price_trend_by_locality(silver(spark, sf_dir), ordered=False), "locality", "event_date")
    return trend.filter(F.col("locality") == POINT_LOCALITY)


def q_scd1_upsert(spark, sf_dir):
    return agents_scd1(spark, sf_dir)


def q_change_feed(spark, sf_dir):
    return dims.change_feed(fx.agent_master(spark, sf_dir), agents_scd1(spark, sf_dir), "agent_id")


def q_scd2_init(spark, sf_dir):
    return dims.scd2_init(agents_scd1(spark, sf_dir), fx.INITIAL_LOAD)


def q_scd2_apply(spark, sf_dir):
    return agents_history(spark, sf_dir)


def q_scd2_current(spark, sf_dir):
    return agents_current(spark, sf_dir).select(
        "agent_id", "agent_name", "base_city", "tier", "scd_version").orderBy("agent_id")


def q_scd2_history(spark, sf_dir):
    return dims.scd2_history_of(agents_history(spark, sf_dir), HISTORY_AGENT).select(
        "agent_id", "agent_name", "base_city", "is_current", "effective_start_date",
        "effective_end_date", "scd_version")


def q_scd2_changed_keys(spark, sf_dir):
    return dims.scd2_changed_keys(agents_history(spark, sf_dir))


def q_scd2_counts(spark, sf_dir):
    return dims.scd2_counts(agents_history(spark, sf_dir))


def q_scd2_dedup(spark, sf_dir):
    # the reference's hand-written insert re-runs and leaves repeated
    # version rows behind; the dedup restores one row per version
    hist = agents_history(spark, sf_dir)
    repeated = hist.unionByName(hist.filter(F.col("scd_version") > 1))
    return dims.scd2_dedup(repeated)


def q_gold_agent_performance(spark, sf_dir):
    return star.agent_performance(silver(spark, sf_dir), agents_current(spark, sf_dir))


def q_gold_agent_vs_city_benchmark(spark, sf_dir):
    return star.agent_vs_city_benchmark(silver(spark, sf_dir), agents_current(spark, sf_dir))


def q_gold_top_agents_by_tier(spark, sf_dir):
    # the rank joins Gold 5's rows with their own histogram: written once, read twice
    perf = star.agent_performance(silver(spark, sf_dir), agents_current(spark, sf_dir), ordered=False)
    return star.top_agents_from_performance(published(spark, perf, "agent_performance"))


def q_gold_agent_city_movement(spark, sf_dir):
    return star.agent_city_movement(silver(spark, sf_dir), agents_history(spark, sf_dir))


def q_agent_pre_post_move(spark, sf_dir):
    return star.pre_post_move(silver(spark, sf_dir), agents_history(spark, sf_dir))


def q_window_dense_rank(spark, sf_dir):
    return windows.dense_rank_cities_by_day(silver(spark, sf_dir))


def q_window_lag_trend(spark, sf_dir):
    return windows.price_trend_lag(silver(spark, sf_dir))


def silver_yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table as an earlier load left it: some events had not come yet, some had another
    price, and some were there that have gone since (fixed rules on the listing number)."""
    s = silver(spark, sf_dir)
    number = F.col("listing_id").cast("long")
    price = F.when((number % 13 == 0) & (F.col("price") > 0), F.col("price") + 5_000_000).otherwise(F.col("price"))
    held = s.filter(~F.coalesce(number % 11 == 0, F.lit(False))).withColumn("price", price)
    gone = s.filter(number % 17 == 0).withColumn("listing_id", F.concat(F.lit("gone-"), "listing_id"))
    return held.unionByName(gone)


def q_gold_change_feed(spark, sf_dir):
    """Changes of a business table with a key of three columns, from two bucketed snapshots."""
    root, database = scratch_path(spark, "gold_change_feed"), f"tierlake_{uuid4().hex[:12]}"
    catalog.create_database(spark, database, f"{root}/_db")
    key = ["city", "locality", "event_date"]
    for name, events in (("before", silver_yesterday(spark, sf_dir)), ("after", silver(spark, sf_dir))):
        trend = agg.price_trend_by_locality(events, ordered=False)
        dims.write_snapshot(trend, key, f"{database}.{name}", f"{root}/{name}")
    return dims.snapshot_changes(spark.table(f"{database}.before"), spark.table(f"{database}.after"))


def q_gold_trend_maintained(spark, sf_dir):
    """Gold 3 from the summary that a change feed of the clean table kept up, not from the events."""
    before = published(spark, silver_yesterday(spark, sf_dir), "silver_before")
    after = published(spark, silver(spark, sf_dir), "silver_after")
    feed = dims.change_feed(before, after, list(EVENT_KEYS))
    facts = published(spark, agg.market_facts(before), "facts_before")
    kept_up = agg.maintain_market_facts(facts, published(spark, feed, "silver_feed"), after)
    return agg.price_trend_by_locality_from(kept_up)


def q_sql_temp_views(spark, sf_dir):
    """SQL text over temp views of the tiers."""
    suffix = uuid4().hex[:8]
    names = catalog.register_views({f"silver_{suffix}": silver(spark, sf_dir), f"agents_{suffix}": agents_current(spark, sf_dir)})
    agents, events = names
    return spark.sql(f"""SELECT a.tier, COUNT(*) AS events, COUNT(DISTINCT s.agent_id) AS agents, MAX(s.price) AS top_price
                         FROM {events} s JOIN {agents} a ON s.agent_id = a.agent_id GROUP BY a.tier""")


def q_ingestion_mark(spark, sf_dir):
    """A load without a stated time stamps its own: one for all rows, between its start and now."""
    started = spark.sql("SELECT unix_micros(current_timestamp()) AS t").first()["t"]
    loaded = published(spark, clean_events(bronze(spark, sf_dir)), "ingestion_mark")
    mark = F.unix_micros("ingestion_timestamp")
    in_run = mark.between(F.lit(started), F.unix_micros(F.current_timestamp()))
    return loaded.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("ingestion_timestamp").alias("marks"),
        F.count_if(in_run).alias("stamped_in_run"))


def q_literal_feed(spark, sf_dir):
    """Literal rows, typed by the dimension's schema, merged into the whole dimension."""
    feed = spark.createDataFrame(fx.LITERAL_AGENTS, AGENT)
    return dims.scd1_upsert(fx.agent_master(spark, sf_dir), feed, set_columns=AGENT.fieldNames()[1:])


def q_scan_count(spark, sf_dir):
    """Row counts of the raw and clean event tables, tagged and stacked."""
    b = bronze(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))
    s = silver(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))
    return (b.select(F.lit("bronze").alias("layer"), "row_count")
            .unionByName(s.select(F.lit("silver").alias("layer"), "row_count")))


QUERIES: dict[str, Query] = {
    "silver_clean": q_silver_clean,
    "dedup_latest": q_dedup_latest,
    "dq_report": q_dq_report,
    "dq_uniqueness": q_dq_uniqueness,
    "dq_timeliness": q_dq_timeliness,
    "filter_isin": q_filter_isin,
    "scan_count": q_scan_count,
    "gold_avg_price_by_city": q_gold_avg_price_by_city,
    "gold_listing_count_by_event": q_gold_listing_count_by_event,
    "gold_price_trend_by_locality": q_gold_price_trend_by_locality,
    "gold_top_active_cities": q_gold_top_active_cities,
    "point_filter_count": q_point_filter_count,
    "point_filter_city": q_point_filter_city,
    "point_filter_locality": q_point_filter_locality,
    "scd1_upsert": q_scd1_upsert,
    "change_feed": q_change_feed,
    "scd2_init": q_scd2_init,
    "scd2_apply": q_scd2_apply,
    "scd2_current": q_scd2_current,
    "scd2_history": q_scd2_history,
    "scd2_changed_keys": q_scd2_changed_keys,
    "scd2_counts": q_scd2_counts,
    "scd2_dedup": q_scd2_dedup,
    "gold_agent_performance": q_gold_agent_performance,
    "gold_agent_vs_city_benchmark": q_gold_agent_vs_city_benchmark,
    "gold_top_agents_by_tier": q_gold_top_agents_by_tier,
    "gold_agent_city_movement": q_gold_agent_city_movement,
    "gold_change_feed": q_gold_change_feed,
    "gold_trend_maintained": q_gold_trend_maintained,
    "sql_temp_views": q_sql_temp_views,
    "ingestion_mark": q_ingestion_mark,
    "literal_feed": q_literal_feed,
    "agent_pre_post_move": q_agent_pre_post_move,
    "window_dense_rank": q_window_dense_rank,
    "window_lag_trend": q_window_lag_trend,
}
