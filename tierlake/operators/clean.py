"""Raw -> clean (bronze -> silver) for listing events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.functions.columns import normalized_label, parse_event_time, price_or_zero, trimmed
from tierlake.operators.dedup import EVENT_KEYS, keep_by_order
from tierlake.schemas import BRONZE_EVENT


def ingestion_mark(as_of: str | None) -> Column:
    """The load time stamped on every row; fixed when ``as_of`` is given."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def standardize(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    """Parse, normalise and cast raw events; drop the raw-only columns.

    Unparsable event time becomes NULL (``try_to_timestamp``) so it can be
    counted by a gate instead of failing the job.
    """
    return bronze.select(
        F.col("listing_id").cast("string").alias("listing_id"),
        normalized_label("event_type").alias("event_type"),
        normalized_label("city").alias("city"),
        trimmed("locality").alias("locality"),
        price_or_zero("price").alias("price"),
        F.col("bedrooms").cast("int").alias("bedrooms"),
        F.col("area_sqft").cast("int").alias("area_sqft"),
        F.col("agent_id").cast("string").alias("agent_id"),
        parse_event_time("timestamp").alias("event_timestamp"),
        ingestion_mark(as_of).alias("ingestion_timestamp"),
    )


def clean_events(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    """Silver events: ``standardize`` then one row per (listing, type, time)."""
    return one_per_event(standardize(bronze, as_of))


def one_per_event(events: DataFrame) -> DataFrame:
    """Of the rows of one (listing, type, time) the first ingested one stays; of several ingested
    together, the least in the other columns' order.  A retried task picks the same row again."""
    return keep_by_order(events, EVENT_KEYS, ["ingestion_timestamp"], latest=False)


def add_events(held: DataFrame, new: DataFrame) -> DataFrame:
    """Clean events with a newly cleaned batch: rows that are there stay, whatever their replays say."""
    return one_per_event(held.unionByName(new))


def union_bronze(*raw: DataFrame) -> DataFrame:
    """All raw feeds (message stream, CSV drops, ...) as one raw table in the
    stream schema.  Columns a feed lacks are NULL; extra columns (ingestion
    time, source file) are dropped.  Clean then deduplicates across feeds."""
    cols = BRONZE_EVENT.fieldNames()
    out = None
    for df in raw:
        part = df.select(*[df[c].cast(BRONZE_EVENT[c].dataType).alias(c) if c in df.columns
                           else F.lit(None).cast(BRONZE_EVENT[c].dataType).alias(c)
                           for c in cols])
        out = part if out is None else out.unionByName(part)
    return out
