"""Gold aggregate tables 1-4 over clean listing events.

All four (and the daily city windows) are exact roll-ups of one summary,
``market_facts``: events grouped by (city, locality, event_type, day) with
counts, sums, minima and maxima.  Building the summary is the only pass
over the events (partial aggregation in the map tasks, one shuffle); every
report then reads a table with one row per city, locality, type and day.
Sums are kept in double - what ``avg`` itself accumulates - so averages
rolled up as sum/count equal ``AVG`` and cannot overflow a long.

``ordered`` adds the report ordering; the sort runs on the aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.schemas import NEW_LISTING, PRICE_CHANGE, REMOVED


def priced_condition() -> Column:
    """Events that carry a real asking price."""
    return (F.col("event_type") != REMOVED) & (F.col("price") > 0)


def priced(silver: DataFrame) -> DataFrame:
    return silver.filter(priced_condition())


def event_day(column: str = "event_timestamp") -> Column:
    """``DATE_TRUNC('DAY', ts)``: a midnight timestamp, not a date."""
    return F.date_trunc("day", F.col(column))


def ratio(total: Column, count: Column) -> Column:
    """Average from a rolled-up sum and count; NULL when the count is 0."""
    return F.try_divide(total, count)


def market_facts(silver: DataFrame) -> DataFrame:
    """Summary by (city, locality, event_type, event_date).

    n_rows / n_listings       rows / non-null listing ids
    p_sum, p_cnt, p_listings  price sum, price count, listing count of priced rows
    p_max, p_min              extreme prices of priced rows
    """
    pp = F.when(priced_condition(), F.col("price"))
    return silver.groupBy("city", "locality", "event_type",
                          event_day().alias("event_date")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("listing_id").alias("n_listings"),
        F.sum(pp.cast("double")).alias("p_sum"),
        F.count(pp).alias("p_cnt"),
        F.count(F.when(priced_condition(), F.col("listing_id"))).alias("p_listings"),
        F.max(pp).alias("p_max"),
        F.min(pp).alias("p_min"))


# ------------------------------------------------ the summary kept up from a change feed

FACT_KEYS = ("city", "locality", "event_type", "event_date")
_SUMS = ("n_rows", "n_listings", "p_sum", "p_cnt", "p_listings")


def signed_facts(changes: DataFrame) -> DataFrame:
    """What a change feed of clean events (``_change_type``) adds to each group of
    ``market_facts``: sums in which images that go count negative, and the extreme prices
    of those that come (``in_``) and go (``out_``)."""
    comes = F.col("_change_type").isin("insert", "update_postimage")
    sign = F.when(comes, 1).otherwise(-1)
    pp = F.when(priced_condition(), F.col("price"))
    listed = F.col("listing_id").isNotNull()
    return changes.groupBy("city", "locality", "event_type", event_day().alias("event_date")).agg(
        F.sum(sign).alias("n_rows"),
        F.sum(F.when(listed, sign).otherwise(0)).alias("n_listings"),
        F.coalesce(F.sum(sign * pp.cast("double")), F.lit(0.0)).alias("p_sum"),
        F.sum(F.when(pp.isNotNull(), sign).otherwise(0)).alias("p_cnt"),
        F.sum(F.when(priced_condition() & listed, sign).otherwise(0)).alias("p_listings"),
        F.max(F.when(comes, pp)).alias("in_max"), F.min(F.when(comes, pp)).alias("in_min"),
        F.max(F.when(~comes, pp)).alias("out_max"), F.min(F.when(~comes, pp)).alias("out_min"))


def maintain_market_facts(facts: DataFrame, changes: DataFrame, events: DataFrame) -> DataFrame:
    """``market_facts`` of ``events`` (the state after the changes) from the facts before them.

    Counts and sums take the feed's signed sums (prices are whole numbers, so sums in double stay
    exact up to 2^53).  A maximum or minimum follows the feed unless a price that equals it leaves its
    group and none as extreme comes; only such groups are computed anew, from the events of those
    groups.  Groups that the feed does not touch are carried over; groups left without rows go.
    """
    delta = signed_facts(changes).select(*[F.col(c).alias(f"_d_{c}") for c in (
        *FACT_KEYS, *_SUMS, "in_max", "in_min", "out_max", "out_min")])
    both = facts.join(delta, [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in FACT_KEYS], "full_outer")
    zero = F.lit(0)
    # a group that only one side has: its rows are counted there, and rows are never null
    key = {k: F.when(F.col("n_rows").isNull(), F.col(f"_d_{k}")).otherwise(F.col(k)).alias(k) for k in FACT_KEYS}
    sums = {c: (F.coalesce(F.col(c), zero) + F.coalesce(F.col(f"_d_{c}"), zero)) for c in _SUMS}
    left = sums["p_cnt"] > 0
    gone_max = F.coalesce((F.col("_d_out_max") >= F.col("p_max")) & ~F.coalesce(F.col("_d_in_max") >= F.col("p_max"), F.lit(False)), F.lit(False))
    gone_min = F.coalesce((F.col("_d_out_min") <= F.col("p_min")) & ~F.coalesce(F.col("_d_in_min") <= F.col("p_min"), F.lit(False)), F.lit(False))
    merged = both.select(
        *key.values(), sums["n_rows"].alias("n_rows"), sums["n_listings"].alias("n_listings"),
        F.when(left, sums["p_sum"]).alias("p_sum"), *[sums[c].alias(c) for c in ("p_cnt", "p_listings")],
        F.when(left, F.greatest("p_max", "_d_in_max")).alias("p_max"),
        F.when(left, F.least("p_min", "_d_in_min")).alias("p_min"),
        (left & (gone_max | gone_min)).alias("_anew")).where(F.col("n_rows") > 0)
    anew = merged.where("_anew").select(*[F.col(k).alias(f"_k_{k}") for k in FACT_KEYS])
    again = market_facts(events.join(anew, [
        (event_day() if k == "event_date" else F.col(k)).eqNullSafe(F.col(f"_k_{k}")) for k in FACT_KEYS], "left_semi"))
    columns = [*FACT_KEYS, *_SUMS, "p_max", "p_min"]
    return merged.where(~F.col("_anew")).select(*columns).unionByName(again.select(*columns))


def _priced_rollup(facts: DataFrame, *keys) -> DataFrame:
    return facts.filter(F.col("p_cnt") > 0).groupBy(*keys).agg(
        F.round(ratio(F.sum("p_sum"), F.sum("p_cnt")), 2).alias("avg_price"),
        F.max("p_max").alias("max_price"),
        F.min("p_min").alias("min_price"),
        F.sum("p_listings").alias("n"))


def avg_price_by_city_from(facts: DataFrame, ordered: bool = True) -> DataFrame:
    out = _priced_rollup(facts, "city").select(
        "city", "avg_price", "max_price", "min_price", F.col("n").alias("total_listings"))
    return out.orderBy(F.desc("avg_price")) if ordered else out


def listing_count_by_event_from(facts: DataFrame, ordered: bool = True) -> DataFrame:
    out = facts.groupBy("event_type").agg(F.sum("n_listings").alias("total_count"))
    return out.orderBy(F.desc("total_count")) if ordered else out


def price_trend_by_locality_from(facts: DataFrame, ordered: bool = True) -> DataFrame:
    out = _priced_rollup(facts, "city", "locality", "event_date").select(
        "city", "locality", "event_date", "avg_price", F.col("n").alias("listing_count"))
    return out.orderBy("event_date", F.desc("avg_price")) if ordered else out


def top_active_cities_from(facts: DataFrame, ordered: bool = True) -> DataFrame:
    def rows_of(kind: str) -> Column:
        return F.sum(F.when(F.col("event_type") == kind, F.col("n_rows")).otherwise(0))

    out = facts.groupBy("city").agg(
        F.sum("n_listings").alias("total_events"),
        rows_of(NEW_LISTING).alias("new_listings"),
        rows_of(PRICE_CHANGE).alias("price_changes"),
        rows_of(REMOVED).alias("removals"))
    return out.orderBy(F.desc("total_events")) if ordered else out


def daily_city_prices_from(facts: DataFrame) -> DataFrame:
    return _priced_rollup(facts, "city", "event_date").select(
        "city", "event_date", "avg_price", F.col("n").alias("listing_count"))


# ------------------------------------------------ one-table convenience forms

def avg_price_by_city(silver: DataFrame, ordered: bool = True) -> DataFrame:
    return avg_price_by_city_from(market_facts(silver), ordered)


def listing_count_by_event(silver: DataFrame, ordered: bool = True) -> DataFrame:
    return listing_count_by_event_from(market_facts(silver), ordered)


def price_trend_by_locality(silver: DataFrame, ordered: bool = True) -> DataFrame:
    return price_trend_by_locality_from(market_facts(silver), ordered)


def top_active_cities(silver: DataFrame, ordered: bool = True) -> DataFrame:
    return top_active_cities_from(market_facts(silver), ordered)
