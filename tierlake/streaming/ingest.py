"""Raw-tier ingestion with Structured Streaming.

Two sources, both stateless appends (no watermark, no state):

* an envelope stream of binary JSON bodies (any message source that yields
  a ``body`` column; here a file source over landed envelopes), decoded with
  ``from_json`` against a fixed schema - malformed JSON becomes a row of
  NULLs for the clean layer's gates to count (``decode_json``), or keeps its
  text, its fault and its unknown fields (``decode_json_rescued``);
* incremental CSV drops with a header, read recursively from sub-folders,
  stamped with ingestion time and source file.

The sink is a Parquet file sink with a checkpoint, which gives exactly-once
appends across restarts: a re-run reads only files not yet committed.
Deduplication is left to the clean layer (a watermark-based streaming
dedup would drop late rows).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from tierlake.schemas import BRONZE_EVENT, ENVELOPE
from tierlake.sources.tables import Files, path_bytes


# ---------------------------------------------------------------- sources

def envelope_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ENVELOPE).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def decode_json(messages: DataFrame, schema: StructType = BRONZE_EVENT) -> DataFrame:
    """``from_json(body)`` then flatten the struct."""
    return (messages.select(F.from_json(F.col("body").cast("string"), schema).alias("data"))
            .select("data.*"))


def csv_stream(spark: SparkSession, path: str, schema: StructType = BRONZE_EVENT,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental CSV drops (header, explicit schema, sub-folders included)."""
    reader = (spark.readStream.schema(schema).option("header", True)
              .option("recursiveFileLookup", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


# ---------------------------------------------------------------- rescued rows

CORRUPT, RESCUED, FAULT = "_corrupt_record", "_rescued", "_fault"


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, *StructType().add(CORRUPT, StringType()).fields])


def decode_json_rescued(messages: DataFrame, schema: StructType = BRONZE_EVENT) -> DataFrame:
    """As ``decode_json``, losing nothing: adds ``_corrupt_record`` (the text of a body that is no
    JSON object of the schema's types), ``_rescued`` (a map of the fields that the schema lacks)
    and ``_fault`` (null, or why the row belongs into quarantine)."""
    text = F.col("body").cast("string")
    data = F.from_json(text, _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    fields = F.from_json(text, "map<string,string>")
    known = F.array(*[F.lit(n) for n in schema.fieldNames()])
    extra = F.map_filter(fields, lambda k, v: ~F.array_contains(known, k))
    out = messages.select(text.alias("text"), data.alias("data"), extra.alias("extra"))
    # a body such as null or [] is well-formed, but no object
    lost = F.col("data").isNull() | ~F.coalesce(F.ltrim("text").startswith("{"), F.lit(False))
    fault = (F.when(F.col("text").isNull(), "no body").when(F.col(f"data.{CORRUPT}").isNotNull() | lost, "malformed"))
    return out.select(*[F.col(f"data.{n}") for n in schema.fieldNames()],
                      F.when(fault.isNotNull(), F.col("text")).alias(CORRUPT),
                      F.when(fault.isNull() & (F.size("extra") > 0), F.col("extra")).alias(RESCUED), fault.alias(FAULT))


def csv_stream_rescued(spark: SparkSession, path: str, schema: StructType = BRONZE_EVENT,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """As ``csv_stream``; a line with too few or too many values, or with one that does not fit its
    column's type, keeps its text in ``_corrupt_record`` and has a ``_fault``."""
    reader = (spark.readStream.schema(_with_corrupt(schema)).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", True).option("recursiveFileLookup", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.csv(path)
    return lines.select(*schema.fieldNames(), CORRUPT, F.lit(None).cast("map<string,string>").alias(RESCUED),
                        F.when(F.col(CORRUPT).isNotNull(), "malformed").alias(FAULT))


def kept_rows(raw: DataFrame) -> DataFrame:
    """Rows without a fault, with their rescued fields."""
    return raw.where(F.col(FAULT).isNull()).drop(CORRUPT, FAULT)


def quarantined_rows(raw: DataFrame) -> DataFrame:
    """The others: text and fault (and provenance, where the raw rows have it).  Kept and quarantined
    rows together are all rows."""
    held = [c for c in ("ingestion_timestamp", "source_file_name") if c in raw.columns]
    return raw.where(F.col(FAULT).isNotNull()).select(F.col(CORRUPT).alias("record"), F.col(FAULT).alias("fault"), *held)


def fault_counts(raw: DataFrame) -> DataFrame:
    """Rows by fault (``kept`` for none), and how many of them have rescued fields."""
    return raw.groupBy(F.coalesce(F.col(FAULT), F.lit("kept")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count(RESCUED).alias("rescued_rows"))


def with_provenance(df: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Add ``ingestion_timestamp`` and ``source_file_name``."""
    if as_of is None:
        stamp = F.current_timestamp()
    else:
        stamp = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    return (df.withColumn("ingestion_timestamp", stamp)
            .withColumn("source_file_name", F.col("_metadata.file_path")))


def landing_name(file_col: str = "source_file_name") -> Column:
    """Name of the folder a file was dropped into (``.../batch_001/x.csv``)."""
    return F.regexp_extract(F.col(file_col), r"([^/]+)/[^/]+$", 1)


# ---------------------------------------------------------------- sinks

def start_append(df: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                 processing_time: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    writer = (df.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(out_path)


def drain(df: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Process everything available now, then stop (``availableNow``)."""
    q = start_append(df, out_path, checkpoint, available_now=True)
    q.awaitTermination()
    return q


def run_for(df: DataFrame, out_path: str, checkpoint: str, seconds: float,
            processing_time: str = "1 second") -> StreamingQuery:
    """Run a continuous ingest for a bounded time, then stop it.  A batch that is cut off is not
    committed; the next run on the same checkpoint takes it up again."""
    q = start_append(df, out_path, checkpoint, available_now=False,
                     processing_time=processing_time)
    try:
        q.awaitTermination(seconds)
    finally:
        q.stop()
    return q


# ---------------------------------------------------------------- compaction inside the run

GROUP = "ingest_group"


def compacting_sink(out_path: str, batches_per_group: int = 8, target_file_bytes: int = 128 * 1024 * 1024
                    ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends micro-batches and merges their small files as it goes.

    A batch is the folder ``ingest_group=<g>/batch-<id>``, written with overwrite: a batch that is
    replayed after a crash replaces itself.  The first batch of a group merges the group before it
    (all its batches are committed by then) into files of about the target size: the merged files are
    written aside, then the two folders change places by renames.  Whatever step a crash cuts off,
    the replayed batch goes on from there; no row is lost or there twice afterwards.  Between the two
    renames readers miss the group.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        group = batch_id // batches_per_group
        # AQE writes few files per batch, of the session's advisory size
        batch.hint("rebalance").write.mode("overwrite").parquet(f"{out_path}/{GROUP}={group}/batch-{batch_id}")
        if group and batch_id % batches_per_group == 0:
            merge_group(spark, out_path, group - 1, target_file_bytes)
    return write


def merge_group(spark: SparkSession, out_path: str, group: int, target_file_bytes: int) -> None:
    """Merge the files of one group; may be repeated after any of its steps."""
    files = Files(spark, out_path)
    live, merged, aside = f"{out_path}/{GROUP}={group}", f"{out_path}/_merged-{group}", f"{out_path}/_aside-{group}"
    if not files.exists(f"{merged}/_SUCCESS") and not files.exists(aside):
        if not any(n.startswith("batch-") for n in files.names(live)):
            return                                       # merged before, or never written
        n = max(1, math.ceil(path_bytes(spark, live) / target_file_bytes))
        rows = spark.read.option("recursiveFileLookup", True).parquet(live)
        rows.coalesce(n).write.mode("overwrite").parquet(merged)
    if files.exists(merged):
        if not files.exists(aside):
            files.move(live, aside)
        files.move(merged, live)
    files.delete(aside)


def drain_compacting(df: DataFrame, out_path: str, checkpoint: str, batches_per_group: int = 8,
                     target_file_bytes: int = 128 * 1024 * 1024) -> StreamingQuery:
    """``drain`` into a ``compacting_sink``."""
    q = (df.writeStream.foreachBatch(compacting_sink(out_path, batches_per_group, target_file_bytes))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_compacting(spark: SparkSession, out_path: str, schema: StructType) -> DataFrame:
    """The rows of a ``compacting_sink``."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(out_path)
