"""Gold tables 5-8: the clean fact table joined with the agent dimension.

Facts are aggregated *before* the join, into one summary per (agent, city)
- ``agent_city_facts`` - from which Gold 5, 6 and 8 are exact roll-ups (Gold
7 ranks Gold 5's per-agent rows).  The reference groups by the agent key
plus dimension attributes after an inner join; because the current
dimension has exactly one row per key, aggregating on the key first and
attaching the attributes afterwards gives the same rows.  The events are
scanned and shuffled once (partial aggregation first, so a hot agent is
combined in every map task); the joins see one row per agent or agent-city.
Sums are doubles, as ``avg`` accumulates them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.functions.columns import count_where, positive_or_null
from tierlake.operators.aggregates import priced_condition, ratio
from tierlake.operators.dimensions import valid_at
from tierlake.operators.windows import rank_within
from tierlake.schemas import NEW_LISTING, PRICE_CHANGE, REMOVED


def agent_city_facts(silver: DataFrame) -> DataFrame:
    """Summary by (agent_id, city).

    n_listings, n_new, n_change, n_removed   listing ids; rows per event type
    pos_sum, pos_cnt, pos_min, max_price     positive prices; max of all prices
    pr_sum, pr_cnt, pr_listings              priced rows (not REMOVED, price > 0)
    """
    pos = positive_or_null("price")
    pr = F.when(priced_condition(), F.col("price"))
    return silver.groupBy("agent_id", "city").agg(
        F.count("listing_id").alias("n_listings"),
        count_where(F.col("event_type") == NEW_LISTING).alias("n_new"),
        count_where(F.col("event_type") == PRICE_CHANGE).alias("n_change"),
        count_where(F.col("event_type") == REMOVED).alias("n_removed"),
        F.sum(pos.cast("double")).alias("pos_sum"),
        F.count(pos).alias("pos_cnt"),
        F.min(pos).alias("pos_min"),
        F.max("price").alias("max_price"),
        F.sum(pr.cast("double")).alias("pr_sum"),
        F.count(pr).alias("pr_cnt"),
        F.count(F.when(priced_condition(), F.col("listing_id"))).alias("pr_listings"))


def agent_performance_from(facts: DataFrame, agents: DataFrame, ordered: bool = True
                           ) -> DataFrame:
    """Gold 5.  Counts per event type, average/min over positive prices and
    max over all prices, for agents present in the current dimension.

    REMOVED is the domain value for removals (the reference spelt it
    'REMOVAL', which never matches); removals are counted here.
    """
    per_agent = facts.groupBy("agent_id").agg(
        F.sum("n_listings").alias("total_listings"),
        F.sum("n_new").alias("new_listings"),
        F.sum("n_change").alias("price_changes"),
        F.sum("n_removed").alias("removals"),
        F.round(ratio(F.sum("pos_sum"), F.sum("pos_cnt")), 2).alias("avg_listing_price"),
        F.max("max_price").alias("max_listing_price"),
        F.min("pos_min").alias("min_listing_price"))
    dim = agents.select("agent_id", "agent_name", "base_city", "tier", "rating", "total_deals")
    out = per_agent.join(dim, "agent_id", "inner").select(
        "agent_id", "agent_name", "base_city", "tier", "rating", "total_deals",
        "total_listings", "new_listings", "price_changes", "removals",
        "avg_listing_price", "max_listing_price", "min_listing_price")
    return out.orderBy(F.desc("total_listings")) if ordered else out


def agent_vs_city_benchmark_from(facts: DataFrame, agents: DataFrame, ordered: bool = True
                                 ) -> DataFrame:
    """Gold 6.  Agent-in-city average price against the city average.

    The city averages roll up the same (agent, city) sums, so they cover
    every agent; the agent rows only dimension agents.  Both averages are
    rounded before the difference and percentage, as the report defines.
    """
    pac = facts.filter(F.col("pr_cnt") > 0)
    city_avg = pac.groupBy("city").agg(
        F.round(ratio(F.sum("pr_sum"), F.sum("pr_cnt")), 2).alias("city_avg_price"))
    dim = agents.select("agent_id", "agent_name", "tier")
    aa = pac.join(dim, "agent_id", "inner").select(
        "agent_id", "agent_name", "tier", "city",
        F.round(ratio(F.col("pr_sum"), F.col("pr_cnt")), 2).alias("agent_avg_price"),
        F.col("pr_listings").alias("total_listings"))
    a, c = F.col("agent_avg_price"), F.col("city_avg_price")
    out = aa.join(city_avg, "city", "inner").select(
        "agent_id", "agent_name", "tier", "city", "agent_avg_price", "city_avg_price",
        "total_listings",
        F.round(a - c, 2).alias("price_diff"),
        F.round(F.try_divide(a - c, c) * 100, 2).alias("pct_above_city_avg"),
        F.when(a > c, "ABOVE AVERAGE").when(a < c, "BELOW AVERAGE")
        .otherwise("AT AVERAGE").alias("performance_flag"))
    return out.orderBy(F.desc("pct_above_city_avg")) if ordered else out


def top_agents_from_performance(perf: DataFrame, ordered: bool = True) -> DataFrame:
    """Gold 7 from Gold 5's per-agent rows (same listing count and
    positive-price average): rank within tier and share of the tier.

    Tiers are few and large, so ``rank_within`` ranks the histogram of
    listing counts instead of sorting all agents of a tier in one task.
    The share is computed in double (the SQL form yields a decimal).
    """
    metrics = perf.select("agent_id", "agent_name", "tier", "rating", "base_city",
                          "total_listings", F.col("avg_listing_price").alias("avg_price"))
    ranked = rank_within(metrics, "tier", "total_listings", "rank_within_tier", "_tier_total")
    out = ranked.select(
        "tier", "agent_id", "agent_name", "base_city", "rating", "total_listings", "avg_price",
        "rank_within_tier",
        F.round(F.try_divide(F.col("total_listings") * 100.0, F.col("_tier_total")), 2)
        .alias("pct_of_tier_listings"))
    return out.orderBy("tier", "rank_within_tier") if ordered else out


def agent_city_movement_from(facts: DataFrame, history: DataFrame, ordered: bool = True
                             ) -> DataFrame:
    """Gold 8.  Per agent and listing city, repeated for every version of the
    agent, flagged MOVED CITY when the agent has more than one version.
    (The repetition is the report's definition; ``pre_post_move`` gives the
    time-valid split.)"""
    acp = facts.select(
        "agent_id", F.col("city").alias("listing_city"),
        F.col("n_listings").alias("listings_in_city"),
        F.round(ratio(F.col("pos_sum"), F.col("pos_cnt")), 2).alias("avg_price_in_city"))
    of_agent = Window.partitionBy("agent_id")   # the join's own partitioning
    versions = history.select("agent_id", "agent_name", "scd_version", "effective_start_date",
                              "effective_end_date",
                              (F.count(F.lit(1)).over(of_agent) > 1).alias("_moved"))
    j = acp.join(versions, "agent_id", "inner")
    out = j.select(
        "agent_id", "agent_name", "listing_city", "listings_in_city", "avg_price_in_city",
        F.when(F.col("_moved"), "MOVED CITY").otherwise("STABLE").alias("agent_status"),
        "scd_version", "effective_start_date", "effective_end_date")
    return out.orderBy("agent_id", "scd_version") if ordered else out


# ------------------------------------------------ one-table convenience forms

def agent_performance(silver: DataFrame, agents: DataFrame, ordered: bool = True) -> DataFrame:
    return agent_performance_from(agent_city_facts(silver), agents, ordered)


def agent_vs_city_benchmark(silver: DataFrame, agents: DataFrame, ordered: bool = True
                            ) -> DataFrame:
    return agent_vs_city_benchmark_from(agent_city_facts(silver), agents, ordered)


def top_agents_by_tier(silver: DataFrame, agents: DataFrame, ordered: bool = True) -> DataFrame:
    return top_agents_from_performance(agent_performance(silver, agents, ordered=False), ordered)


def agent_city_movement(silver: DataFrame, history: DataFrame, ordered: bool = True
                        ) -> DataFrame:
    return agent_city_movement_from(agent_city_facts(silver), history, ordered)


def pre_post_move(silver: DataFrame, history: DataFrame) -> DataFrame:
    """Performance per agent version, each event attributed to the version
    valid at its event time (before vs after a city move).

    The version is grouped as one struct.  Its partial sums then meet in a
    shuffle of their own, so the grouping does not rely on the join's
    partitioning and AQE is free to split a hot agent's join partition.
    """
    facts = silver.select("agent_id", "listing_id", "price", "event_timestamp")
    version = ["scd_version", "base_city", "effective_start_date", "effective_end_date"]
    hist = history.select("agent_id", *version)
    j = valid_at(facts, hist, "agent_id", "event_timestamp")
    return j.groupBy(F.struct("agent_id", *version).alias("v")).agg(
        F.count("listing_id").alias("listings"),
        F.round(F.avg(positive_or_null("price")), 2).alias("avg_price")).select(
        "v.*", "listings", "avg_price")
