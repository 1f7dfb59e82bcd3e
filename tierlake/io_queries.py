"""Named queries that exercise sources, sinks and table jobs.

Each writes under a fresh folder of the shared root (``spark.checkpoint.dir``)
and returns a DataFrame that reads the result back, so the check sees what a
downstream reader would see.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.operators import aggregates as agg
from tierlake.operators.dedup import distinct_values
from tierlake.plans import catalog, layers
from tierlake.plans.tables import Slices, Table, by_key
from tierlake.queries import agents_history, bronze, silver
from tierlake.schemas import BRONZE_EVENT, SILVER_EVENT
from tierlake.session import scratch_path
from tierlake.sources import fixtures as fx
from tierlake.sources.tables import read_table
from tierlake.streaming import ingest

SPLIT_TIME = "2024-01-15"  # CSV drops and staged loads split at this event time
CSV_SOURCE = "external-provider"
GOLD_DATABASE = "tierlake_gold"
BOUNDED_SECONDS = 2
LABEL = "tierlake."
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _table(spark: SparkSession, name: str, slices: Slices | None = None) -> Table:
    """A table in a database of this call's own."""
    return Table(spark, f"tierlake_{uuid4().hex[:12]}.{name}", scratch_path(spark, name), slices)


def _true(condition):
    """Never null, so a split by it and its negation keeps every row."""
    return F.coalesce(condition, F.lit(False))


def _before_split():
    """Raw rows whose ISO event-time text sorts before the split day."""
    return _true(F.col("timestamp") < F.lit(SPLIT_TIME))


# ---------------------------------------------------------------- streams

def q_bronze_json_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as JSON message bodies -> stream -> decode -> raw table."""
    root = scratch_path(spark, "bronze_json_stream")
    fx.land_envelopes(bronze(spark, sf_dir), f"{root}/landing")
    decoded = ingest.decode_json(ingest.envelope_stream(spark, f"{root}/landing"))
    ingest.drain(decoded, f"{root}/bronze", f"{root}/_checkpoint")
    return spark.read.schema(BRONZE_EVENT).parquet(f"{root}/bronze")


def q_stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, one checkpoint, two runs: every event exactly once."""
    root = scratch_path(spark, "stream_resume")
    events = fx.listing_events(spark, sf_dir, dirty=False)
    even = _true(F.col("listing_id").cast("long") % 2 == 0)
    fx.land_envelopes(events.filter(even), f"{root}/landing")
    stream = ingest.decode_json(ingest.envelope_stream(spark, f"{root}/landing"))
    ingest.drain(stream, f"{root}/bronze", f"{root}/_checkpoint")
    fx.land_envelopes(events.filter(~even), f"{root}/landing")
    ingest.drain(stream, f"{root}/bronze", f"{root}/_checkpoint")
    return spark.read.schema(BRONZE_EVENT).parquet(f"{root}/bronze")


def q_bounded_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run bounded in time, ended wherever it stands, and a later run that takes what it left."""
    root = scratch_path(spark, "bounded_stream")
    fx.land_envelopes(bronze(spark, sf_dir), f"{root}/landing")
    stream = ingest.decode_json(ingest.envelope_stream(spark, f"{root}/landing"))
    ingest.run_for(stream, f"{root}/bronze", f"{root}/_checkpoint", seconds=BOUNDED_SECONDS)
    ingest.drain(stream, f"{root}/bronze", f"{root}/_checkpoint")
    return spark.read.schema(BRONZE_EVENT).parquet(f"{root}/bronze")


def _csv_drops(spark: SparkSession, sf_dir: str, root: str) -> None:
    drops = fx.listing_events(spark, sf_dir, dirty=False, removed_price=F.lit(0).cast("long"),
                              source=CSV_SOURCE)
    fx.land_csv(drops.filter(_before_split()), f"{root}/incoming/batch_001")
    fx.land_csv(drops.filter(~_before_split()), f"{root}/incoming/batch_002")


def _csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "bronze_csv")
    _csv_drops(spark, sf_dir, root)
    stream = ingest.with_provenance(ingest.csv_stream(spark, f"{root}/incoming"),
                                    as_of=fx.SILVER_LOAD)
    ingest.drain(stream, f"{root}/bronze", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/bronze")


def q_bronze_csv_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _csv_ingest(spark, sf_dir).select(*BRONZE_EVENT.fieldNames())


def q_bronze_csv_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _csv_ingest(spark, sf_dir)
    return raw.groupBy(ingest.landing_name().alias("landing")).agg(
        F.count(F.lit(1)).alias("row_count"))


def q_distinct_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = distinct_values(_csv_ingest(spark, sf_dir), "source_file_name")
    return distinct_values(files.select(ingest.landing_name().alias("landing")), "landing")


# ---------------------------------------------------------------- files and tables

def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv_roundtrip")
    (silver(spark, sf_dir).write.option("header", True)
     .option("timestampFormat", TIMESTAMP_TEXT).csv(path))
    return (spark.read.schema(SILVER_EVENT).option("header", True)
            .option("timestampFormat", TIMESTAMP_TEXT).csv(path))


def q_sql_path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sql_path_scan")
    silver(spark, sf_dir).write.parquet(path)
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


def q_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite a table from a read of itself, replacing its schema."""
    t = _table(spark, "overwrite_roundtrip")
    t.overwrite(silver(spark, sf_dir))
    reshaped = (t.read().filter(F.col("event_type") != "REMOVED")
                .drop("ingestion_timestamp")
                .withColumn("event_date", agg.event_day()))
    t.overwrite(reshaped, overwriteSchema=True)
    return t.read()


def q_schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older drop without ``source`` plus a newer one with it; merged on read."""
    path = scratch_path(spark, "schema_evolve")
    raw = fx.listing_events(spark, sf_dir, dirty=False)
    raw.filter(_before_split()).drop("source").write.parquet(path)
    raw.filter(~_before_split()).write.mode("append").parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def _silver_table(spark: SparkSession, sf_dir: str, name: str) -> Table:
    """The clean table as two loads, so that table jobs meet appended folders."""
    t = _table(spark, name)
    s = _published_silver(spark, sf_dir, f"{name}_src")
    early = _true(F.col("event_timestamp") < F.lit(SPLIT_TIME).cast("timestamp"))
    t.overwrite(s.filter(early))
    t.append(s.filter(~early))
    return t


def q_compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _silver_table(spark, sf_dir, "compact_table")
    t.compact()
    return t.read()


def q_cluster_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _silver_table(spark, sf_dir, "cluster_layout")
    t.cluster_by(["city", "event_type"])
    return t.read()


def q_curve_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laid out on two columns at once, so that a filter on either skips files."""
    t = _silver_table(spark, sf_dir, "curve_layout")
    t.cluster_by(["locality", "event_timestamp"], curve=True)
    return t.read()


def q_append_new_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that gains a column by an append, then gets rows without it and without another one."""
    t = _table(spark, "append_new_columns")
    s = _published_silver(spark, sf_dir, "append_new_columns_src")
    early = _true(F.col("event_timestamp") < F.lit(SPLIT_TIME).cast("timestamp"))
    removed = _true(F.col("event_type") == "REMOVED")
    t.overwrite(s.filter(early & ~removed))
    t.append(s.filter(~early & ~removed).withColumn("event_date", agg.event_day()))
    t.append(s.filter(removed).drop("price", "bedrooms"))
    t.compact()
    return t.read()


def q_silver_add_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table from a first load and a later raw batch, which overlaps it and rewrites only
    the days that it touches; the batch is run twice."""
    run = layers.LayerRun(scratch_path(spark, "silver_add_batch"))
    raw = bronze(spark, sf_dir)
    replayed = _true(F.col("listing_id").cast("long") % 50 == 0)
    layers.run_silver(spark, run, raw.filter(_before_split()), fx.SILVER_LOAD)
    for _ in range(2):
        t = layers.add_to_silver(spark, run, raw.filter(~_before_split() | replayed), fx.SILVER_LOAD)
    return t.read()


def q_increment_price_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold 3 after a first run and a day's increment: clean table, summary and report are brought up
    to date from the new batch."""
    run = layers.LayerRun(scratch_path(spark, "increment_price_trend"))
    raw = bronze(spark, sf_dir)
    first = layers.run_silver(spark, run, raw.filter(_before_split()), fx.SILVER_LOAD)
    layers.run_gold(spark, run, first.read())
    tables = layers.run_increment(spark, run, raw.filter(~_before_split()), "increment", fx.SILVER_LOAD)
    return tables["price_trend_by_locality"].read()


def q_scd2_merge_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension job's history: merges into key buckets, the day's changes run twice."""
    run = layers.LayerRun(scratch_path(spark, "scd2_merge_slices"))
    feed = fx.scd2_feed(spark, sf_dir)
    t = layers.run_dimension(spark, run, fx.agent_master(spark, sf_dir), fx.scd1_feed(spark, sf_dir), feed,
                             fx.INITIAL_LOAD, fx.CITY_MOVE)
    layers.add_scd2_changes(spark, run, t, feed, fx.CITY_MOVE)
    return t.read()


def q_delete_by_key_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``delete_by_key`` on a table sliced by the key: untouched slices keep their files."""
    t = _table(spark, "delete_by_key_slices", by_key("agent_id", 32))
    t.overwrite(_published_silver(spark, sf_dir, "delete_by_key_slices_src"))
    t.delete_keys(_deleted_agents(spark, sf_dir), "agent_id")
    return t.read()


def q_stream_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events through a sink that merges its small files while the stream runs."""
    root = scratch_path(spark, "stream_compaction")
    fx.land_envelopes(bronze(spark, sf_dir).repartition(6), f"{root}/landing")
    decoded = ingest.decode_json(ingest.envelope_stream(spark, f"{root}/landing", max_files_per_trigger=1))
    ingest.drain_compacting(decoded, f"{root}/bronze", f"{root}/_checkpoint", batches_per_group=2)
    return ingest.read_compacting(spark, f"{root}/bronze", BRONZE_EVENT)


def q_bronze_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds with broken input (fixed rules on the listing number): cut JSON, a price that is no
    number, bodies that are no object or missing, unknown fields; short, long and mistyped CSV lines.
    Streamed into raw tables that lose nothing, then split into kept and quarantined rows."""
    root = scratch_path(spark, "bronze_rescue")
    raw = fx.listing_events(spark, sf_dir, dirty=False)
    number = F.coalesce(F.col("listing_id").cast("long"), F.lit(0))
    fields = [F.col(c) for c in BRONZE_EVENT.fieldNames()]
    good = F.to_json(F.struct(*fields))
    body = (F.when(number % 20 == 1, F.substring(good, 1, 40))
            .when(number % 20 == 2, F.to_json(F.struct(*[F.lit("much").alias("price") if c == "price" else F.col(c)
                                                         for c in BRONZE_EVENT.fieldNames()])))
            .when(number % 20 == 3, F.lit("null")).when(number % 20 == 4, F.lit("[1]"))
            .when(number % 20 == 5, F.lit(None).cast("string"))
            .when(number % 20 == 6, F.to_json(F.struct(*fields, F.lit("pool").alias("extra"), F.lit(3).alias("floors"))))
            .otherwise(good))
    raw.select(body.cast("binary").alias("body")).write.parquet(f"{root}/landing")
    stream = ingest.decode_json_rescued(ingest.envelope_stream(spark, f"{root}/landing"))
    ingest.drain(stream, f"{root}/events", f"{root}/_checkpoint_events")

    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in BRONZE_EVENT.fieldNames()]
    priced = [F.lit("much") if c == "price" else cell for c, cell in zip(BRONZE_EVENT.fieldNames(), cells)]
    line = (F.when(number % 20 == 7, F.concat_ws(",", *cells[:4])).when(number % 20 == 8, F.concat_ws(",", *cells, F.lit("more")))
            .when(number % 20 == 9, F.concat_ws(",", *priced)).otherwise(F.concat_ws(",", *cells)))
    # every file of a drop starts with the header
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = raw.select(F.pmod(F.xxhash64("listing_id"), F.lit(n)).cast("int").alias("file"), F.lit(1).alias("part"), line.alias("value"))
    headers = spark.range(n).select(F.col("id").cast("int").alias("file"), F.lit(0).alias("part"),
                                    F.lit(",".join(BRONZE_EVENT.fieldNames())).alias("value"))
    (lines.unionByName(headers).repartitionById(n, F.col("file")).sortWithinPartitions("file", "part").select("value")
     .write.text(f"{root}/incoming/batch_001"))
    drops = ingest.with_provenance(ingest.csv_stream_rescued(spark, f"{root}/incoming"), fx.SILVER_LOAD)
    ingest.drain(drops, f"{root}/drops", f"{root}/_checkpoint_drops")

    out = None
    for feed in ("events", "drops"):
        held = spark.read.parquet(f"{root}/{feed}")
        kept = ingest.kept_rows(held).agg(F.lit("kept").alias("outcome"), F.count(F.lit(1)).alias("row_count"),
                                          F.count(ingest.RESCUED).alias("rescued_rows"))
        bad = ingest.quarantined_rows(held).groupBy(F.col("fault").alias("outcome")).agg(
            F.count(F.lit(1)).alias("row_count"), F.lit(0).cast("long").alias("rescued_rows"))
        part = kept.unionByName(bad).withColumn("feed", F.lit(feed))
        out = part if out is None else out.unionByName(part)
    return out


def _deleted_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer", "c_custkey")
    return cust.filter(F.col("c_custkey") % 10 == 0).select(
        F.col("c_custkey").cast("string").alias("agent_id"))


def q_delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _silver_table(spark, sf_dir, "delete_by_key")
    t.delete_keys(_deleted_agents(spark, sf_dir), "agent_id")
    return t.read()


def _published_silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Clean events written once; later steps read the files (lineage cut)."""
    path = scratch_path(spark, name, "silver")
    silver(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def _scripted_loads(spark: SparkSession, sf_dir: str) -> Table:
    t = _table(spark, "load_history")
    s = _published_silver(spark, sf_dir, "load_history_src")
    early = _true(F.col("event_timestamp") < F.lit(SPLIT_TIME).cast("timestamp"))
    t.overwrite(s.filter(early))                                   # v0 WRITE
    t.append(s.filter(~early))                                     # v1 WRITE (append)
    t.delete_keys(_deleted_agents(spark, sf_dir), "agent_id")      # v2 DELETE
    t.compact()                                                    # v3 OPTIMIZE
    t.cluster_by(["city", "event_type"])                           # v4 OPTIMIZE
    t.overwrite(s)                                                 # v5 WRITE
    return t


def q_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scripted_loads(spark, sf_dir).history(5).select("version", "operation", "row_count")


def q_table_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _silver_table(spark, sf_dir, "table_detail")
    return t.detail().select("format", "num_rows")


# ---------------------------------------------------------------- layer checks

def _publish_layers(spark: SparkSession, sf_dir: str, with_agents: bool = True,
                    with_raw: bool = True) -> tuple[layers.LayerRun, dict]:
    """Raw -> clean -> business tables, each step reading what the previous
    one published (the layer job on batch-landed raw events).  Without
    ``with_raw`` the raw events are cleaned straight from their source."""
    run = layers.LayerRun(scratch_path(spark, "layers"))
    tables = {}
    raw = bronze(spark, sf_dir)
    if with_raw:
        raw_t = tables["bronze"] = run.table(spark, "bronze")
        raw_t.overwrite(raw)
        raw = raw_t.read()
    silver_t = layers.run_silver(spark, run, raw, as_of=fx.SILVER_LOAD)
    history = None
    if with_agents:
        hist_t = run.table(spark, "agent_scd2")
        hist_t.overwrite(agents_history(spark, sf_dir))
        history = hist_t.read()
    gold = layers.run_gold(spark, run, silver_t.read(), history)
    return run, {**tables, "silver": silver_t, **gold}


def q_layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged row counts of the raw, clean and first four business tables,
    as one SQL UNION ALL over path-addressed scans."""
    _, tables = _publish_layers(spark, sf_dir, with_agents=False)
    names = ["bronze", "silver", *layers.MARKET_TABLES]
    return catalog.path_counts(spark, {n: tables[n].location() for n in names})


CATALOG_NAMES = {"silver": "silver_property_events",
                 **{g: f"gold_{g}" for g in layers.GOLD_TABLES}}


def q_catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register the clean and all eight business tables; count each one."""
    run, tables = _publish_layers(spark, sf_dir, with_raw=False)
    catalog.create_database(spark, GOLD_DATABASE, f"{run.root}/_db")
    for name, table_name in CATALOG_NAMES.items():
        catalog.register_table(spark, GOLD_DATABASE, table_name, tables[name].location())
    registered = set(catalog.list_tables(spark, GOLD_DATABASE))
    return catalog.table_counts(spark, GOLD_DATABASE,
                                sorted(n for n in CATALOG_NAMES.values() if n in registered))


def q_table_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean and four business tables labelled with their tier and their load's row count; the
    labels as the catalog gives them after each table has been pointed at other columns."""
    run, tables = _publish_layers(spark, sf_dir, with_agents=False, with_raw=False)
    database = f"tierlake_{uuid4().hex[:12]}"
    catalog.create_database(spark, database, f"{run.root}/_db")
    for name in ("silver", *layers.MARKET_TABLES):
        held = tables[name].read()
        table = catalog.register_table(spark, database, name, tables[name].location())
        catalog.set_properties(spark, table, {f"{LABEL}tier": "clean" if name == "silver" else "business",
                                              f"{LABEL}rows": str(held.count())})
        catalog.point_table(spark, table, tables[name].location(), held.drop(held.columns[-1]).schema)
    return catalog.labels(spark, database, LABEL)


IO_QUERIES = {
    "bounded_stream": q_bounded_stream,
    "table_properties": q_table_properties,
    "bronze_json_stream": q_bronze_json_stream,
    "stream_resume": q_stream_resume,
    "bronze_csv_stream": q_bronze_csv_stream,
    "bronze_csv_provenance": q_bronze_csv_provenance,
    "distinct_files": q_distinct_files,
    "csv_roundtrip": q_csv_roundtrip,
    "sql_path_scan": q_sql_path_scan,
    "overwrite_roundtrip": q_overwrite_roundtrip,
    "schema_evolve": q_schema_evolve,
    "compact_table": q_compact_table,
    "cluster_layout": q_cluster_layout,
    "curve_layout": q_curve_layout,
    "append_new_columns": q_append_new_columns,
    "silver_add_batch": q_silver_add_batch,
    "increment_price_trend": q_increment_price_trend,
    "scd2_merge_slices": q_scd2_merge_slices,
    "delete_by_key_slices": q_delete_by_key_slices,
    "stream_compaction": q_stream_compaction,
    "bronze_rescue": q_bronze_rescue,
    "delete_by_key": q_delete_by_key,
    "load_history": q_load_history,
    "table_detail": q_table_detail,
    "layer_row_counts": q_layer_row_counts,
    "catalog_counts": q_catalog_counts,
}
