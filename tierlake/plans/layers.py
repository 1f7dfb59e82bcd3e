"""The three-tier job: raw stream -> clean table -> business tables.

    run_bronze  stream landed message bodies into the raw table (availableNow)
    run_bronze_csv  stream CSV drops into their raw table (with provenance)
    run_silver  clean + deduplicate the raw table, stage it, run the gates on
                the staged files, publish only if every gate passes
    add_to_silver  the same for a new raw batch, merged into the days that it touches
    run_dimension  the agent dimension: merges that rewrite only the touched key buckets
    record_changes  a business table's rows as a bucketed snapshot, and their changes
    run_gold    summarise the published clean table twice (market and agent-city
                grain) and roll the eight business tables up from the summaries

Each step reads what the previous one published, so a failed step leaves
the previous tables in place and can be re-run.  Layout: the clean table is
sliced by day; rows of a day are dealt and sorted by ``city, event_type``, so
Parquet min/max statistics skip files and row groups on point filters.  Tables are
catalog tables of the run's database.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.operators import aggregates as agg
from tierlake.operators import quality, star
from tierlake.operators import dimensions as dims
from tierlake.operators.clean import add_events, clean_events
from tierlake.plans.catalog import create_database
from tierlake.plans.tables import Slices, Table, by_day, by_key, cluster_layout, curve_layout, write_observed
from tierlake.schemas import BRONZE_EVENT
from tierlake.sources.tables import Files
from tierlake.streaming import ingest

# Layout keys of the business tables (the reference's CLUSTER BY columns); more than one lie on a
# space-filling curve, so that a filter on any of them skips files.
GOLD_LAYOUT = {
    "avg_price_by_city": ["city"],
    "listing_count_by_event": ["event_type"],
    "price_trend_by_locality": ["locality", "event_date"],
    "top_active_cities": ["city"],
}

GOLD_TABLES = ("avg_price_by_city", "listing_count_by_event", "price_trend_by_locality",
               "top_active_cities", "agent_performance", "agent_vs_city_benchmark",
               "top_agents_by_tier", "agent_city_movement_impact")


# Keys of the business tables; null is a key value there, as in any GROUP BY.
GOLD_KEYS = {
    "avg_price_by_city": ["city"],
    "listing_count_by_event": ["event_type"],
    "price_trend_by_locality": ["city", "locality", "event_date"],
    "top_active_cities": ["city"],
    "agent_performance": ["agent_id"],
    "agent_vs_city_benchmark": ["agent_id", "city"],
    "top_agents_by_tier": ["agent_id"],
    "agent_city_movement_impact": ["agent_id", "listing_city", "scd_version"],
}


SILVER_LAYOUT = ("city", "event_type")


@dataclass
class LayerRun:
    """A run's folder and the catalog database of its tables.  Without a name the run has a
    database of its own; with one, a later run in a persistent catalog finds its tables.
    ``key_buckets`` is the number of slices of the dimension tables (about a file each)."""

    root: str
    database: str = field(default_factory=lambda: f"tierlake_{uuid.uuid4().hex[:12]}")
    key_buckets: int = 16
    timings: dict[str, float] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str, slices: Slices | None = None, layout: tuple[str, ...] = ()) -> Table:
        return Table(spark, f"{self.database}.{name.rsplit('/', 1)[-1]}", f"{self.root}/{name}", slices, layout)

    def market_facts(self, spark: SparkSession) -> Table:
        return self.table(spark, "summary/market_facts", by_day("event_date"))

    def silver(self, spark: SparkSession) -> Table:
        return self.table(spark, "silver", by_day("event_timestamp"), SILVER_LAYOUT)


def _timed(run: LayerRun, name: str, fn):
    t0 = time.perf_counter()
    out = fn()
    run.timings[name] = time.perf_counter() - t0
    return out


def run_bronze(spark: SparkSession, run: LayerRun, landing: str,
               files_per_batch: int | None = None, rescue: bool = False, batches_per_group: int | None = None) -> DataFrame:
    """Drain every landed message into the raw table; returns the raw table.

    ``files_per_batch`` bounds each micro-batch, so a large backlog is
    drained as a sequence of committed batches rather than one huge one
    (a failure then only repeats the uncommitted batch).  With ``batches_per_group`` the run merges
    its small files as it goes.  With ``rescue`` the raw table keeps unknown fields and broken
    messages; the latter also go to the table ``quarantine``, and are not in the returned rows
    (``run.rows`` counts both)."""
    out, ckpt = f"{run.root}/bronze", f"{run.root}/_checkpoints/bronze"
    messages = ingest.envelope_stream(spark, landing, max_files_per_trigger=files_per_batch)
    stream = ingest.decode_json_rescued(messages) if rescue else ingest.decode_json(messages, BRONZE_EVENT)
    if batches_per_group:
        _timed(run, "bronze_ingest", lambda: ingest.drain_compacting(stream, out, ckpt, batches_per_group))
        raw = ingest.read_compacting(spark, out, stream.schema)
    else:
        _timed(run, "bronze_ingest", lambda: ingest.drain(stream, out, ckpt))
        raw = spark.read.schema(stream.schema).parquet(out)
    if rescue:
        bad = run.table(spark, "quarantine")
        run.rows["quarantine"] = bad.overwrite(ingest.quarantined_rows(raw))
        raw = ingest.kept_rows(raw)
    run.rows["bronze"] = raw.count()   # of the written table: progress keeps the last batches only
    return raw


def run_bronze_csv(spark: SparkSession, run: LayerRun, incoming: str,
                   as_of: str | None = None, files_per_batch: int | None = None
                   ) -> DataFrame:
    """Drain CSV drops (any sub-folder) into their raw table, with ingestion
    time and source file; returns the raw table."""
    out, ckpt = f"{run.root}/bronze_csv", f"{run.root}/_checkpoints/bronze_csv"
    stream = ingest.with_provenance(
        ingest.csv_stream(spark, incoming, BRONZE_EVENT, max_files_per_trigger=files_per_batch),
        as_of)
    _timed(run, "bronze_csv_ingest", lambda: ingest.drain(stream, out, ckpt))
    raw = spark.read.parquet(out)
    run.rows["bronze_csv"] = raw.count()
    return raw


SILVER_KEY = ["listing_id", "event_type", "event_timestamp"]


def _gate(spark: SparkSession, path: str, as_of: str | None, max_age_days: int | None) -> None:
    quality.enforce(quality.report(spark.read.parquet(path), quality.listing_gates(as_of, max_age_days), SILVER_KEY))


def run_silver(spark: SparkSession, run: LayerRun, raw: DataFrame, as_of: str | None = None,
               max_age_days: int | None = None) -> Table:
    """Clean, stage (sliced by day, laid out on city and event type), gate, publish.  Raises
    ``QualityGateError`` on a failed gate: completeness, validity, range, volume,
    uniqueness of the event key and, with ``as_of`` and ``max_age_days``, timeliness."""
    t = run.silver(spark)
    clean = clean_events(raw, as_of)
    path, rows = _timed(run, "silver_write", lambda: t.stage(clean))
    _timed(run, "silver_gates", lambda: _gate(spark, path, as_of, max_age_days))
    t.publish(path, rows, "WRITE", clean.schema)
    run.rows["silver"] = rows
    return t


def stage_batch(spark: SparkSession, run: LayerRun, raw: DataFrame, as_of: str | None, max_age_days: int | None) -> str:
    """A raw batch cleaned, written and gated on its own; returns its folder."""
    path = f"{run.root}/silver_batch/{uuid.uuid4().hex}"
    _timed(run, "silver_batch_write", lambda: write_observed(clean_events(raw, as_of), path))
    _timed(run, "silver_batch_gates", lambda: _gate(spark, path, as_of, max_age_days))
    return path


def add_to_silver(spark: SparkSession, run: LayerRun, raw: DataFrame, as_of: str | None = None,
                  max_age_days: int | None = None) -> Table:
    """A new raw batch: cleaned, staged and gated on its own, then merged into the days that it
    touches; files of other days stay.  An event that is there already stays as it is, so a batch
    that is run twice changes nothing."""
    t = run.silver(spark)
    batch = spark.read.parquet(stage_batch(spark, run, raw, as_of, max_age_days))
    _timed(run, "silver_merge", lambda: t.rewrite(batch, lambda old: add_events(old, batch)))
    return t


MARKET_TABLES = GOLD_TABLES[:4]


def run_gold(spark: SparkSession, run: LayerRun, silver: DataFrame,
             agent_history: DataFrame | None = None) -> dict[str, Table]:
    """Two passes over the clean events build the summaries every business
    table rolls up from; the summaries are written (lineage cut) and the
    eight tables are built from the written summaries.  Gold 7 reads Gold 5.
    Without ``agent_history`` only the four market tables are built (one
    pass).
    """
    builders = [("market_facts", agg.market_facts)]
    if agent_history is not None:
        builders.append(("agent_city_facts", star.agent_city_facts))
    summaries = {}
    for name, build in builders:
        t = run.market_facts(spark) if name == "market_facts" else run.table(spark, f"summary/{name}")
        _timed(run, f"summary_{name}", lambda t=t, build=build: t.overwrite(build(silver)))
        summaries[name] = t.read()
    frames = market_tables(summaries["market_facts"])
    if agent_history is not None:
        current, agent_city = agent_history.filter("is_current"), summaries["agent_city_facts"]
        frames.update({
            "agent_performance": star.agent_performance_from(agent_city, current, ordered=False),
            "agent_vs_city_benchmark": star.agent_vs_city_benchmark_from(agent_city, current,
                                                                         ordered=False),
            "agent_city_movement_impact": star.agent_city_movement_from(
                agent_city, agent_history, ordered=False),
        })
    tables = write_gold(spark, run, frames)
    if agent_history is None:
        return tables
    t7 = run.table(spark, "gold/top_agents_by_tier")
    perf = tables["agent_performance"].read()
    _timed(run, "gold_top_agents_by_tier",
           lambda: t7.overwrite(star.top_agents_from_performance(perf, ordered=False)))
    tables["top_agents_by_tier"] = t7
    return tables


def market_tables(facts: DataFrame) -> dict[str, DataFrame]:
    """The four market tables as roll-ups of ``market_facts``."""
    return {
        "avg_price_by_city": agg.avg_price_by_city_from(facts, ordered=False),
        "listing_count_by_event": agg.listing_count_by_event_from(facts, ordered=False),
        "price_trend_by_locality": agg.price_trend_by_locality_from(facts, ordered=False),
        "top_active_cities": agg.top_active_cities_from(facts, ordered=False),
    }


def write_gold(spark: SparkSession, run: LayerRun, frames: dict[str, DataFrame]) -> dict[str, Table]:
    tables = {}
    for name, df in frames.items():
        if name in GOLD_LAYOUT:
            columns = GOLD_LAYOUT[name]
            df = cluster_layout(df, columns) if len(columns) == 1 else laid_out(spark, run, name, df, columns)
        t = run.table(spark, f"gold/{name}")
        _timed(run, f"gold_{name}", lambda df=df, t=t: t.overwrite(df))
        tables[name] = t
    return tables


def run_increment(spark: SparkSession, run: LayerRun, raw: DataFrame, batch_id: str, as_of: str | None = None,
                  max_age_days: int | None = None) -> dict[str, Table]:
    """The day's run on tables that an earlier run published: the new raw batch goes into the days of
    the clean table that it touches, its new events (a change feed, written first) into the same days
    of the market summary, and the four market tables are rolled up again from the summary, their
    changes recorded.  No step reads the whole clean table.

    A run that died may be repeated with the same ``batch_id``.  Its feed is then there already, and
    since the summary may or may not have taken it, the touched days of the summary are computed
    from the clean table instead of from the feed's sums."""
    silver, facts, days = run.silver(spark), run.market_facts(spark), by_day("event_timestamp")
    feed_path = f"{run.root}/silver_feed/{batch_id}"
    repeated = Files(spark, run.root).exists(f"{feed_path}/_SUCCESS")
    batch = spark.read.parquet(stage_batch(spark, run, raw, as_of, max_age_days))
    if not repeated:
        held = spark.table(silver.name).where(days.among(days.touched(batch))).select(
            *[F.col(c).alias(f"_h_{c}") for c in SILVER_KEY])
        new = batch.join(held, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in SILVER_KEY], "left_anti")
        new.withColumn("_change_type", F.lit("insert")).write.mode("overwrite").parquet(feed_path)
    feed = spark.read.parquet(feed_path)
    _timed(run, "silver_merge", lambda: silver.rewrite(batch, lambda old: add_events(old, batch)))

    def merged(old: DataFrame) -> DataFrame:
        now = spark.table(silver.name).where(days.among(days.touched(feed)))
        return agg.market_facts(now) if repeated else agg.maintain_market_facts(old, feed, now)
    _timed(run, "facts_merge", lambda: facts.rewrite(feed.withColumn("event_date", agg.event_day()), merged))
    frames = market_tables(facts.read())
    tables = write_gold(spark, run, frames)
    for name in frames:
        record_changes(spark, run, name, tables[name].read())
    return {"silver": silver, "market_facts": facts, **tables}


def laid_out(spark: SparkSession, run: LayerRun, name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` on a curve of ``columns``.  It is written first: the curve reads it twice, for the
    quantiles of the columns alone and for the rows."""
    path = f"{run.root}/plain/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return curve_layout(spark.read.parquet(path), columns)


def record_changes(spark: SparkSession, run: LayerRun, name: str, rows: DataFrame) -> DataFrame:
    """Keep a business table's new state as a bucketed snapshot, compare it with the one before
    (buckets are merged as they lie) and append the difference to ``<name>_changes``.  Returns the
    changes of this load; the first load inserts every row."""
    create_database(spark, run.database, f"{run.root}/_db")
    prefix = f"{name}_at_"
    before = [int(t.name[len(prefix):]) for t in spark.catalog.listTables(run.database, f"{prefix}*")]
    load = max(before, default=-1) + 1
    new = f"{run.database}.{prefix}{load}"
    dims.write_snapshot(rows, GOLD_KEYS[name], new, f"{run.root}/snapshots/{name}/{load}", run.key_buckets)
    after = spark.table(new)
    if before:
        feed = dims.snapshot_changes(spark.table(f"{run.database}.{prefix}{load - 1}"), after)
    else:
        feed = after.drop(dims.SNAPSHOT_KEY, dims.SNAPSHOT_ROW).withColumn("_change_type", F.lit("insert"))
    t = run.table(spark, f"changes/{name}_changes")
    t.append(feed.withColumn("_load", F.lit(load)))
    return t.read().where(F.col("_load") == load).drop("_load")


def point_queries(silver: DataFrame, gold: dict[str, Table], city: str = "ASIA",
                  event_type: str = "NEW_LISTING", gold_city: str = "EUROPE",
                  locality: str = "NATION_7") -> dict[str, DataFrame]:
    """The reference's three point lookups against published tables; the
    equality filters reach the Parquet scan as pushed filters."""
    return {
        "silver_city_event_count": silver.filter(
            (F.col("city") == city) & (F.col("event_type") == event_type))
        .agg(F.count(F.lit(1)).alias("count")),
        "gold_city": gold["avg_price_by_city"].read().filter(F.col("city") == gold_city),
        "gold_locality": gold["price_trend_by_locality"].read()
        .filter(F.col("locality") == locality),
    }


def run_dimension(spark: SparkSession, run: LayerRun, master: DataFrame,
                  scd1_updates: DataFrame | None, scd2_changes: DataFrame | None,
                  initial_load: str, change_time: str, key: str = "agent_id",
                  tier_columns: tuple[str, ...] = ("tier",),
                  tracked: tuple[str, ...] = ("base_city",)) -> Table:
    """Agent dimension: the master with type-1 corrections, then the type-2 history (first
    load, then the day's changes).  Both tables are sliced by key buckets, and a feed rewrites
    only the buckets that its keys fall into."""
    slices = by_key(key, run.key_buckets)
    master_t = run.table(spark, "agent_master", slices)
    _timed(run, "agent_master", lambda: master_t.overwrite(master))
    if scd1_updates is not None:
        _timed(run, "agent_scd1", lambda: master_t.rewrite(
            scd1_updates, lambda old: dims.scd1_upsert(old, scd1_updates, key, tier_columns)))
    t = run.table(spark, "agent_scd2", slices)
    _timed(run, "agent_scd2_init", lambda: t.overwrite(dims.scd2_init(master_t.read(), initial_load)))
    if scd2_changes is not None:
        add_scd2_changes(spark, run, t, scd2_changes, change_time, key, tracked)
    return t


def add_scd2_changes(spark: SparkSession, run: LayerRun, t: Table, changes: DataFrame, change_time: str,
                     key: str = "agent_id", tracked: tuple[str, ...] = ("base_city",)) -> None:
    """A day's changes into the published history; feed rows that come too late are kept and counted."""
    late = run.table(spark, "agent_scd2_late")
    run.rows["agent_scd2_late"] = late.overwrite(dims.scd2_late(t.read(), changes, key, tracked, as_of=change_time))
    _timed(run, "agent_scd2", lambda: t.rewrite(
        changes, lambda old: dims.scd2_apply(old, changes, key, tracked, as_of=change_time)))


def run_all(spark: SparkSession, run: LayerRun, landing: str, master: DataFrame,
            scd1_updates: DataFrame | None, scd2_changes: DataFrame | None,
            initial_load: str, change_time: str, as_of: str | None = None,
            database: str | None = None, csv_incoming: str | None = None,
            files_per_batch: int | None = None, max_age_days: int | None = None,
            rescue: bool = False, batches_per_group: int | None = None) -> dict[str, Table]:
    """The whole flow: stream the landed messages (and, with ``csv_incoming``,
    the CSV drops) into raw tables, publish the gated clean table built from
    all raw feeds (with ``max_age_days`` no event may be older than that at
    ``as_of``), build the agent dimension and the business tables; with ``database``
    they are tables of that database."""
    from tierlake.operators.clean import union_bronze

    if database:
        run.database = database

    raw = run_bronze(spark, run, landing, files_per_batch, rescue, batches_per_group)
    if csv_incoming:
        raw = union_bronze(raw, run_bronze_csv(spark, run, csv_incoming, as_of,
                                               files_per_batch))
    silver_t = run_silver(spark, run, raw, as_of, max_age_days)
    agents_t = run_dimension(spark, run, master, scd1_updates, scd2_changes,
                             initial_load, change_time)
    tables = {"silver": silver_t, "agent_scd2": agents_t,
              **run_gold(spark, run, silver_t.read(), agents_t.read())}
    return tables
