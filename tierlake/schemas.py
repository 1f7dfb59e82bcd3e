"""Schemas of the listing model (raw, clean and dimension tables)."""

from pyspark.sql.types import (BinaryType, BooleanType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampType)

# Names, types and order of the columns below are those of the listing model.

# Raw event as it arrives on the stream or in a CSV drop.  The event time is
# still a string (ISO-8601 with an offset).
BRONZE_EVENT = StructType([
    StructField("listing_id", StringType(), True),
    StructField("event_type", StringType(), True),
    StructField("city", StringType(), True),
    StructField("locality", StringType(), True),
    StructField("price", LongType(), True),
    StructField("bedrooms", IntegerType(), True),
    StructField("area_sqft", IntegerType(), True),
    StructField("agent_id", StringType(), True),
    StructField("timestamp", StringType(), True),
    StructField("source", StringType(), True),
])

# Stream envelope: one binary body per message, UTF-8 JSON of BRONZE_EVENT.
ENVELOPE = StructType([StructField("body", BinaryType(), True)])

SILVER_EVENT = StructType([
    StructField("listing_id", StringType(), True),
    StructField("event_type", StringType(), True),
    StructField("city", StringType(), True),
    StructField("locality", StringType(), True),
    StructField("price", LongType(), True),
    StructField("bedrooms", IntegerType(), True),
    StructField("area_sqft", IntegerType(), True),
    StructField("agent_id", StringType(), True),
    StructField("event_timestamp", TimestampType(), True),
    StructField("ingestion_timestamp", TimestampType(), True),
])

AGENT = StructType([
    StructField("agent_id", StringType(), True),
    StructField("agent_name", StringType(), True),
    StructField("base_city", StringType(), True),
    StructField("tier", StringType(), True),
    StructField("rating", DoubleType(), True),
    StructField("total_deals", LongType(), True),
])

AGENT_COLUMNS = [f.name for f in AGENT.fields]

AGENT_SCD2 = StructType(AGENT.fields + [
    StructField("effective_start_date", TimestampType(), True),
    StructField("effective_end_date", TimestampType(), True),
    StructField("is_current", BooleanType(), True),
    StructField("scd_version", IntegerType(), True),
])

# Fixed domain values of the listing model.
EVENT_TYPES = ["NEW_LISTING", "PRICE_CHANGE", "REMOVED"]
NEW_LISTING, PRICE_CHANGE, REMOVED = EVENT_TYPES
