"""The given tables re-expressed in the listing model.

``events`` becomes the raw listing stream, ``customer`` the agent master,
``nation``/``region`` the locality/city geography.  The mapping is plain
column arithmetic and two lookups against the 25-row nation table, so it
runs as one scan of ``events`` with a broadcast hash join.

Fixed values of the mapping (they must equal the oracle SQL):
  event_type  click, signup -> NEW_LISTING; view, purchase -> PRICE_CHANGE;
              error -> REMOVED
  k           props.k; city/locality = region/nation name of nation k % 25
  price       round(value * 100) as bigint; NULL for REMOVED (0 in CSV drops)
  bedrooms    k % 5 + 1;  area_sqft 500 + 25 * k
  dirt        event_id % 3 = 0: event_type lower-cased and padded
              event_id % 7 = 0: city padded
  replays     event_id % 10 = 0: delivered twice (second copy source 'replay')
  agents      id c_custkey, name c_name, base_city nation name, tier
              c_mktsegment, rating c_acctbal, total_deals c_custkey % 300
  SCD1 feed   c_custkey % 10 = 3 -> tier 'BUILDING';
              c_custkey % 300 = 7 -> new agent 'N' || c_custkey, 0 deals
  SCD2 feed   c_custkey % 10 = 0 -> base_city of nation (c_nationkey + 7) % 25
  times       initial load 2024-01-01, city moves 2024-01-15,
              silver load 2024-01-31
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.schemas import AGENT_COLUMNS, NEW_LISTING, PRICE_CHANGE, REMOVED
from tierlake.sources.tables import read_table

INITIAL_LOAD = "2024-01-01 00:00:00"
CITY_MOVE = "2024-01-15 00:00:00"
# two agents of the given table with other values, one that it lacks
LITERAL_AGENTS = [("1", "Agent One", "FRANCE", "BUILDING", 4.5, 12),
                  ("2", "Agent Two", None, "MACHINERY", None, 0),
                  ("L-1", "Agent O'Hara", "JAPAN", "FURNITURE", 3.25, 7)]
SILVER_LOAD = "2024-01-31 00:00:00"
SCD1_NEW_TIER = "BUILDING"
INSERTED_KEY_PREFIX = "N"      # no number can equal it, however many customers there are
N_NATIONS = 25


def ts_lit(value: str) -> Column:
    return F.lit(value).cast("timestamp")


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation key -> (city, locality): 25 rows at every scale.  The planner
    broadcasts it by its size; nothing is hinted."""
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    geo = (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
           .select("n_nationkey", F.col("r_name").alias("city"),
                   F.col("n_name").alias("locality")))
    return geo


def _event_type(raw: Column) -> Column:
    return (F.when(raw.isin("click", "signup"), F.lit(NEW_LISTING))
            .when(raw.isin("view", "purchase"), F.lit(PRICE_CHANGE))
            .when(raw == "error", F.lit(REMOVED)))


def iso_text(ts: Column) -> Column:
    """Timestamp -> ISO-8601 text with an explicit offset (``+00:00`` in UTC).

    The offset is the session zone's, so parsing the text back gives the
    same wall-clock time in any session time zone.
    """
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
                            "Z$", "+00:00")


def listing_events(spark: SparkSession, sf_dir: str, dirty: bool = True,
                   removed_price: Column | None = None, source: str = "stream") -> DataFrame:
    """Raw (bronze) listing events in the stream schema.

    ``dirty`` adds the padding/case dirt and the replayed duplicates the
    clean layer has to undo.  The replay copy is produced by ``explode`` of
    a one- or two-element sequence, so the fact table is scanned once.
    ``removed_price`` is the price REMOVED events carry (NULL on the stream,
    0 in CSV drops); ``source`` labels the feed.
    """
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type",
                    "value", "props")
    ev = ev.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    geo = geography(spark, sf_dir)
    joined = ev.join(geo, (ev.k % N_NATIONS) == geo.n_nationkey, "left")

    etype = _event_type(F.col("event_type"))
    city = F.col("city")
    if removed_price is None:
        removed_price = F.lit(None).cast("long")
    price = F.when(etype == REMOVED, removed_price).otherwise(
        F.round(F.col("value") * 100).cast("long"))
    label = F.lit(source)
    if dirty:
        etype = F.when(F.col("event_id") % 3 == 0,
                       F.concat(F.lit("  "), F.lower(etype), F.lit(" "))).otherwise(etype)
        city = F.when(F.col("event_id") % 7 == 0,
                      F.concat(F.lit(" "), city, F.lit("  "))).otherwise(city)
        copy = F.explode(F.sequence(F.lit(0), F.when(F.col("event_id") % 10 == 0, 1)
                                    .otherwise(0)))
        joined = joined.withColumn("_copy", copy)
        label = F.when(F.col("_copy") == 1, F.lit("replay")).otherwise(label)

    return joined.select(
        F.col("event_id").cast("string").alias("listing_id"),
        etype.alias("event_type"),
        city.alias("city"),
        F.col("locality"),
        price.alias("price"),
        (F.col("k") % 5 + 1).cast("int").alias("bedrooms"),
        (F.col("k") * 25 + 500).cast("int").alias("area_sqft"),
        F.col("user_id").cast("string").alias("agent_id"),
        iso_text(F.col("ts")).alias("timestamp"),
        label.alias("source"),
    )


def _agent_select(cust: DataFrame, geo: DataFrame, nation_key: Column) -> DataFrame:
    joined = cust.join(geo, nation_key == geo.n_nationkey, "left")
    return joined.select(
        F.col("c_custkey").cast("string").alias("agent_id"),
        F.col("c_name").alias("agent_name"),
        F.col("locality").alias("base_city"),
        F.col("c_mktsegment").alias("tier"),
        F.col("c_acctbal").cast("double").alias("rating"),
        (F.col("c_custkey") % 300).cast("long").alias("total_deals"),
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey",
                      "c_acctbal", "c_mktsegment")


def agent_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent dimension (6 columns), one row per customer."""
    cust = _customers(spark, sf_dir)
    geo = geography(spark, sf_dir)
    return _agent_select(cust, geo, cust.c_nationkey)


def scd1_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tier corrections for existing agents plus brand-new agents."""
    cust = _customers(spark, sf_dir).filter(
        (F.col("c_custkey") % 10 == 3) | (F.col("c_custkey") % 300 == 7))
    geo = geography(spark, sf_dir)
    base = _agent_select(cust, geo, cust.c_nationkey).withColumn("_key", F.col("agent_id").cast("bigint"))
    is_new = F.col("_key") % 300 == 7
    return base.select(
        F.when(is_new, F.concat(F.lit(INSERTED_KEY_PREFIX), F.col("agent_id")))
        .otherwise(F.col("agent_id")).alias("agent_id"),
        "agent_name", "base_city",
        F.when(is_new, F.col("tier")).otherwise(F.lit(SCD1_NEW_TIER)).alias("tier"),
        "rating",
        F.when(is_new, F.lit(0).cast("long")).otherwise(F.col("total_deals")).alias("total_deals"),
    )


def scd2_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City moves: every tenth agent moves to nation (c_nationkey + 7) % 25."""
    cust = _customers(spark, sf_dir).filter(F.col("c_custkey") % 10 == 0)
    geo = geography(spark, sf_dir)
    return _agent_select(cust, geo, (cust.c_nationkey + 7) % N_NATIONS).select(*AGENT_COLUMNS)


# ---------------------------------------------------------------- landed files

def land_envelopes(df: DataFrame, path: str, mode: str = "append") -> None:
    """Rows as UTF-8 JSON message bodies, one ``body`` per row, in files that a
    stream can read."""
    body = F.to_json(F.struct(*[F.col(c) for c in df.columns])).cast("binary")
    df.select(body.alias("body")).write.mode(mode).parquet(path)


def land_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a CSV drop with a header; values are written verbatim."""
    (df.write.mode(mode).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
