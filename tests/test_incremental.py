"""Table jobs that rewrite only what changed, and what survives a crash."""

import os
import random
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tierlake.operators import aggregates as agg
from tierlake.operators import dimensions as dims
from tierlake.plans import catalog, layers
from tierlake.plans import tables as tb
from tierlake.plans.tables import Table, by_day, by_key
from tierlake.schemas import AGENT, BRONZE_EVENT, SILVER_EVENT
from tierlake.session import scratch_path
from tierlake.sources import fixtures as fx
from tierlake.sources.tables import Files
from tierlake.streaming import ingest

from conftest import SF_SMALL


def table(spark, name, **kw):
    return Table(spark, f"t_{uuid4().hex[:12]}.{name}", scratch_path(spark, name), **kw)


def files(t):
    return {r.path for r in t.files().collect()}


def canon(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- columns

@pytest.mark.parametrize("step", ["read", "compact", "cluster", "delete", "overwrite", "sql"])
@pytest.mark.parametrize("first,then", [("id a", "id a b"), ("id a b", "id a"), ("id a", "id b"), ("id a b", "b id")])
def test_appends_lose_no_column(spark, first, then, step):
    def rows(names, start):
        return spark.range(start, start + 3).select(*[F.concat(F.lit(c), F.col("id").cast("string")).alias(c) if c != "id"
                                                      else F.col("id") for c in names.split()])
    t = table(spark, "t")
    t.overwrite(rows(first, 0))
    t.append(rows(then, 10))
    if step == "compact":
        t.compact()
    elif step == "cluster":
        t.cluster_by(["id"])
    elif step == "delete":
        t.delete_keys(spark.range(100, 101), "id")
    elif step == "overwrite":
        t.overwrite(t.read())
    found = (spark.sql(f"SELECT * FROM {t.name}") if step == "sql" else t.read())
    got = {r.id: r.asDict() for r in found.collect()}
    for start, names in ((0, first), (10, then)):
        for i in range(start, start + 3):
            for c in {*first.split(), *then.split()} - {"id"}:
                assert got[i][c] == (f"{c}{i}" if c in names.split() else None)


def test_append_of_another_type_writes_nothing(spark):
    t = table(spark, "t")
    t.overwrite(spark.range(3))
    with pytest.raises(ValueError, match="column id"):
        t.append(spark.createDataFrame([("x",)], "id string"))
    assert t.read().count() == 3 and t.history().count() == 1


# ---------------------------------------------------------------- slices

def agents(spark, ids, city="A"):
    return spark.createDataFrame([(str(i), f"n{i}", city, "T", 1.0, 1) for i in ids], AGENT)


def test_scd1_merge_rewrites_only_touched_buckets(spark):
    t = table(spark, "t", slices=by_key("agent_id", 16))
    t.overwrite(agents(spark, range(400)))
    before = files(t)
    feed = agents(spark, [7, 1000], "B").withColumn("tier", F.lit("GOLD"))
    t.rewrite(feed, lambda old: dims.scd1_upsert(old, feed))
    kept = before & files(t)
    touched = len(by_key("agent_id", 16).touched(feed))
    assert len(kept) == len(before) - touched and touched <= 2
    assert canon(t.read()) == canon(dims.scd1_upsert(agents(spark, range(400)), feed))


def test_scd2_merge_rewrites_only_touched_buckets_and_can_be_repeated(spark):
    t = table(spark, "t", slices=by_key("agent_id", 16))
    first = dims.scd2_init(agents(spark, range(400)), "2024-01-01 00:00:00")
    t.overwrite(first)
    before = files(t)
    feed = agents(spark, [3, 5, 2000], "B")
    for _ in range(2):
        t.rewrite(feed, lambda old: dims.scd2_apply(old, feed, as_of="2024-01-15 00:00:00"))
    assert len(before & files(t)) >= len(before) - 3
    assert canon(t.read()) == canon(dims.scd2_apply(first, feed, as_of="2024-01-15 00:00:00"))


def test_delete_rewrites_only_touched_buckets_and_empties_go(spark):
    t = table(spark, "t", slices=by_key("id", 8))
    t.overwrite(spark.range(64).withColumn("v", F.col("id") + 1))
    before = files(t)
    t.delete_keys(spark.range(3, 4), "id")
    assert len(before & files(t)) == len(before) - 1 and t.read().count() == 63
    t.delete_keys(t.read().select("id"), "id")
    assert t.read().count() == 0 and files(t) == set()
    t.rewrite(spark.range(2).withColumn("v", F.lit(0).cast("long")),
              lambda old: old.unionByName(spark.range(2).withColumn("v", F.lit(0).cast("long"))))
    assert t.read().count() == 2


def test_change_outside_its_slices_fails_before_anything_is_replaced(spark):
    t = table(spark, "t", slices=by_key("id", 8))
    t.overwrite(spark.range(64))
    before = files(t)
    with pytest.raises(Exception, match="does not touch"):
        t.rewrite(spark.range(1), lambda old: old.unionByName(spark.range(100, 164)))
    assert files(t) == before and t.read().count() == 64
    assert t.rewrite(spark.range(0), lambda old: old) == 0


def raw_rows(spark, rows):
    return spark.createDataFrame([(str(i), "NEW_LISTING", "C", "L", p, 1, 1, "a", ts, "s") for i, p, ts in rows], BRONZE_EVENT)


def test_new_raw_batch_rewrites_only_its_days(spark):
    run = layers.LayerRun(scratch_path(spark, "t_days"))
    rows = [(i, 100 + i, f"2024-01-{1 + i % 9:02d}T0{i % 8}:00:00+00:00") for i in range(90)]
    t = layers.run_silver(spark, run, raw_rows(spark, rows), "2024-01-31 00:00:00")
    before = files(t)
    batch = [rows[0], (1000, 5, "2024-01-01T00:00:00+00:00"), (1001, 6, "2024-02-03T00:00:00+00:00"),
             (9, 777, rows[9][2])]                       # a replay with another price: the row that is there stays
    for _ in range(2):
        layers.add_to_silver(spark, run, raw_rows(spark, batch), "2024-02-05 00:00:00")
    after = files(t)
    assert len(before - after) == len([f for f in before if "event_day=2024-01-01" in f])
    got = {r.listing_id: r.price for r in t.read().collect()}
    assert len(got) == 92 == t.read().count() and got["9"] == 109 and got["1001"] == 6


def test_age_gate_stops_the_whole_flow(spark):
    from tierlake.operators.quality import QualityGateError
    from tierlake.queries import bronze

    run = layers.LayerRun(scratch_path(spark, "t_age"))
    fx.land_envelopes(bronze(spark, SF_SMALL), f"{run.root}/landing")
    args = (fx.agent_master(spark, SF_SMALL), None, None, fx.INITIAL_LOAD, fx.CITY_MOVE)
    with pytest.raises(QualityGateError, match="timeliness"):
        layers.run_all(spark, run, f"{run.root}/landing", *args, as_of=fx.SILVER_LOAD, max_age_days=7)
    assert not run.silver(spark).exists()


@pytest.mark.parametrize("lost", [None, "facts", "gold"])
def test_increment_equals_the_whole_run(spark, monkeypatch, lost):
    from tierlake.queries import bronze

    raw = bronze(spark, SF_SMALL)
    early = F.coalesce(F.col("timestamp") < "2024-01-15", F.lit(False))
    replayed = F.col("listing_id").cast("long") % 50 == 0
    run, whole = layers.LayerRun(scratch_path(spark, "t_inc")), layers.LayerRun(scratch_path(spark, "t_inc_whole"))
    layers.run_gold(spark, run, layers.run_silver(spark, run, raw.where(early), fx.SILVER_LOAD).read())
    before = files(run.market_facts(spark))
    args = (spark, run, raw.where(~early | replayed), "day-2", fx.SILVER_LOAD)
    if lost:
        with monkeypatch.context() as m:
            if lost == "gold":
                m.setattr(layers, "write_gold", lambda *a: 1 / 0)
            else:
                m.setattr(agg, "maintain_market_facts", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                layers.run_increment(*args)
    tables = layers.run_increment(*args)
    want = layers.run_gold(spark, whole, layers.run_silver(spark, whole, raw, fx.SILVER_LOAD).read())
    assert canon(tables["silver"].read()) == canon(whole.silver(spark).read())
    assert canon(run.market_facts(spark).read()) == canon(whole.market_facts(spark).read().select(run.market_facts(spark).read().columns))
    for name, t in want.items():
        assert canon(tables[name].read()) == canon(t.read())
    assert before & files(run.market_facts(spark)) or lost


def test_quarantine_in_the_whole_flow(spark):
    run = layers.LayerRun(scratch_path(spark, "t_quarantine"))
    good = fx.listing_events(spark, SF_SMALL, dirty=False)
    fx.land_envelopes(good, f"{run.root}/landing")
    spark.createDataFrame([(bytearray(b'{"listing_id": '),), (None,)], "body binary").write.mode("append").parquet(f"{run.root}/landing")
    raw = layers.run_bronze(spark, run, f"{run.root}/landing", 1, rescue=True, batches_per_group=2)
    assert (run.rows["bronze"], run.rows["quarantine"]) == (1000, 2)
    assert canon(layers.run_silver(spark, run, raw, fx.SILVER_LOAD).read().select("listing_id")) == canon(good.select("listing_id"))


def test_null_day_is_a_slice(spark):
    t = table(spark, "t", slices=by_day("ts"))
    t.overwrite(spark.createDataFrame([(1, "2024-01-01"), (2, None)], "id int, d string").select("id", F.col("d").cast("timestamp").alias("ts")))
    more = spark.createDataFrame([(3,)], "id int").withColumn("ts", F.lit(None).cast("timestamp"))
    t.rewrite(more, lambda old: old.unionByName(more))
    assert sorted(r.id for r in t.read().collect()) == [1, 2, 3]
    t.rewrite(more, lambda old: old.where("false"))
    assert sorted(r.id for r in t.read().collect()) == [1]


# ---------------------------------------------------------------- compaction

def test_compaction_leaves_large_files_alone(spark):
    t = table(spark, "t")
    t.overwrite(spark.range(200_000).withColumn("v", F.rand(1)).coalesce(1))
    large = files(t)
    for i in range(5):
        t.append(spark.range(i * 10, i * 10 + 10).withColumn("v", F.lit(0.0)).repartition(2))
    size = min(r.length for r in t.files().collect() if r.path in large)
    small = files(t) - large
    assert t.compact(target_file_bytes=size) == len(small)
    assert large <= files(t) and not small & files(t) and len(files(t)) == 2
    assert t.read().count() == 200_050
    assert t.compact(target_file_bytes=size) == 0        # nothing left to merge


def test_compaction_of_slices_stays_within_them(spark):
    t = table(spark, "t", slices=by_key("id", 3))
    t.overwrite(spark.range(30))
    for i in range(3):
        t.append(spark.range(100 + 30 * i, 130 + 30 * i))
    t.compact()
    assert len(files(t)) == 3 and t.read().count() == 120
    assert t.read().where("id = 105").count() == 1


def test_first_fit_packs_within_folders():
    got = tb.first_fit([("/a/1", 60), ("/a/2", 50), ("/a/3", 40), ("/b/4", 10), ("/a/5", 45)], 100)
    assert sorted(map(sorted, got)) == [["/a/1", "/a/3"], ["/a/2", "/a/5"], ["/b/4"]]


def staged_plans(monkeypatch):
    """The plans of the writes that follow."""
    plans, plain = [], tb.write_observed

    def watched(df, *a, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, *a, **kw)
    monkeypatch.setattr(tb, "write_observed", watched)
    return plans


@pytest.mark.parametrize("sliced", [False, True])
def test_compaction_does_not_shuffle(spark, monkeypatch, sliced):
    t = table(spark, "t", slices=by_key("id", 3) if sliced else None)
    t.overwrite(spark.range(400).withColumn("v", F.col("id") * 2).repartition(12))
    t.append(spark.range(400, 800).withColumn("v", F.col("id") * 2).repartition(12))
    before = t.files().collect()
    plans = staged_plans(monkeypatch)
    assert t.compact() == len(before)
    assert len(plans) == len(files(t)) == (3 if sliced else 1) and not any("Exchange" in p for p in plans)
    assert canon(t.read()) == [(i, 2 * i) for i in sorted(range(800), key=lambda i: repr((i, 2 * i)))]


def test_compaction_of_files_with_other_columns_does_not_shuffle(spark, monkeypatch):
    t = table(spark, "t")
    t.overwrite(spark.range(0, 10).select("id", F.lit(1).alias("price")).repartition(3))
    t.append(spark.range(10, 20).select("id", F.lit(2).alias("price"), F.lit("d").alias("day")).repartition(3))
    t.append(spark.range(20, 30).select("id").repartition(3))
    plans = staged_plans(monkeypatch)
    assert t.compact() == 9 and len(files(t)) == 1
    assert len(plans) == 1 and "Exchange" not in plans[0]
    assert canon(t.read()) == sorted([(i, 1 if i < 10 else 2 if i < 20 else None, "d" if 10 <= i < 20 else None)
                                      for i in range(30)], key=repr)


def test_compaction_of_many_bins_and_of_bins_with_very_many_files(spark, monkeypatch):
    t = table(spark, "t")
    t.overwrite(spark.range(2000).withColumn("v", F.col("id") * 2).repartition(20))
    lengths = [r.length for r in t.files().collect()]
    size = max(lengths) * 5
    bins = [b for b in tb.first_fit([(r.path, r.length) for r in t.files().collect()], size) if len(b) > 1]
    monkeypatch.setattr(tb, "BINS_AT_ONCE", 2)
    monkeypatch.setattr(tb, "FILES_PER_TASK", 3)
    assert len(bins) >= 4 and t.compact(target_file_bytes=size) == sum(map(len, bins))
    assert len(files(t)) == 20 - sum(map(len, bins)) + len(bins)
    assert sorted((r.id, r.v) for r in t.read().collect()) == [(i, 2 * i) for i in range(2000)]
    assert t.history(1).first().row_count == 2000


@pytest.mark.parametrize("step", range(8))
def test_compaction_cut_off_anywhere_is_finished_by_the_next(spark, monkeypatch, step):
    t = table(spark, "t")
    t.overwrite(spark.range(40).repartition(4))
    left = [step]

    def cut(plain):
        def run(*a):
            if left[0] == 0:
                raise RuntimeError("lost")
            left[0] -= 1
            return plain(*a)
        return run
    with monkeypatch.context() as m:
        m.setattr(Files, "move", cut(Files.move))
        m.setattr(Files, "delete", cut(Files.delete))
        try:
            t.compact()
        except RuntimeError:
            pass
    t.finish_compaction()
    assert sorted(r.id for r in t.read().collect()) == list(range(40)) and len(files(t)) == 1


# ---------------------------------------------------------------- layout

def test_curve_layout_lets_either_column_skip_files(spark):
    t = table(spark, "t")
    r = random.Random(4)
    rows = [(f"L{r.randrange(40):02d}", r.randrange(100), i) for i in range(20_000)]
    t.overwrite(spark.createDataFrame(rows, "locality string, day int, n int").repartition(8))
    t.overwrite(tb.curve_layout(t.read(), ["locality", "day"], 16))
    f = t.read().select("locality", "day", F.input_file_name().alias("f")).groupBy("f").agg(
        F.min("locality").alias("lo"), F.max("locality").alias("hi"), F.min("day").alias("a"), F.max("day").alias("b")).collect()
    assert len(f) >= 12
    by_place = [x for x in f if x.lo <= "L07" <= x.hi]
    by_time = [x for x in f if x.a <= 60 <= x.b]
    assert len(by_place) <= len(f) / 2 and len(by_time) <= len(f) / 2
    assert t.read().count() == 20_000
    # a plain range sort serves its first column only
    t.overwrite(tb.cluster_layout(t.read(), ["locality", "day"], 16))
    f = t.read().select("day", F.input_file_name().alias("f")).groupBy("f").agg(F.min("day").alias("a"), F.max("day").alias("b")).collect()
    assert len([x for x in f if x.a <= 60 <= x.b]) == len(f)


def test_curve_layout_of_nulls_ties_and_types(spark):
    rows = [(None, None, None), ("x", None, 1.5)] + [("same", "2024-01-05", 2.0)] * 500 + [("é", "2023-01-01", float("nan"))]
    df = spark.createDataFrame(rows, "s string, d string, v double").withColumn("d", F.col("d").cast("date"))
    got = tb.curve_layout(df, ["s", "d", "v"], 4)
    assert canon(got.select("s", "d")) == canon(df.select("s", "d"))
    assert tb.curve_layout(df.limit(0), ["s", "d"], 4).count() == 0


@pytest.mark.parametrize("curve", [False, True])
def test_a_layout_task_sorts_a_bounded_part_of_a_well_compressed_table(spark, monkeypatch, curve):
    t = table(spark, "t")
    t.overwrite(spark.range(20_000).select("id", F.lit("x" * 500).alias("same"), F.array(F.lit("y" * 500)).alias("many"),
                                           F.lit(None).cast("string").alias("none")).repartition(4))
    held = tb.row_bytes(t.read())
    assert held >= 20_000 * 1_000 and sum(r.length for r in t.files().collect()) < held / 20
    monkeypatch.setattr(tb, "TASK_BYTES", 2_000_000)
    assert t.cluster_by(["id"], curve=curve) == 20_000
    ids = [sorted(r.id for r in spark.read.parquet(f).collect()) for f in files(t)]
    assert len(ids) >= 10 and max(map(len, ids)) <= 4_000
    assert sorted(i for part in ids for i in part) == list(range(20_000))
    t.overwrite(t.read().limit(0))
    assert tb.row_bytes(t.read()) == 0 and t.cluster_by(["id"], curve=curve) == 0


# ---------------------------------------------------------------- stream compaction

def stream_rows(spark, i):
    return spark.range(i * 10, i * 10 + 10).repartition(2)


def test_replayed_batches_are_harmless(spark):
    out = scratch_path(spark, "t_sink")
    sink = ingest.compacting_sink(out, batches_per_group=2)
    for i in (0, 0, 1, 2, 2, 2, 3, 4, 4):
        sink(stream_rows(spark, i), i)
    schema = spark.range(1).schema
    assert sorted(r.id for r in ingest.read_compacting(spark, out, schema).collect()) == list(range(50))
    found = Files(spark, out)
    assert found.names(out) == [f"ingest_group={g}" for g in range(3)]
    assert not any(n.startswith("batch-") for n in found.names(f"{out}/ingest_group=0"))       # merged
    assert found.names(f"{out}/ingest_group=2") == ["batch-4"]                                 # still open


@pytest.mark.parametrize("step", range(4))
def test_merge_cut_off_anywhere_is_finished_by_the_replay(spark, monkeypatch, step):
    out = scratch_path(spark, "t_sink_crash")
    sink = ingest.compacting_sink(out, batches_per_group=2)
    for i in (0, 1):
        sink(stream_rows(spark, i), i)
    left = [step]

    def cut(plain):
        def run(*a):
            if left[0] == 0:
                raise RuntimeError("lost")
            left[0] -= 1
            return plain(*a)
        return run
    with monkeypatch.context() as m:
        m.setattr(Files, "move", cut(Files.move))
        m.setattr(Files, "delete", cut(Files.delete))
        try:
            sink(stream_rows(spark, 2), 2)
        except RuntimeError:
            pass
    sink(stream_rows(spark, 2), 2)
    assert sorted(r.id for r in ingest.read_compacting(spark, out, spark.range(1).schema).collect()) == list(range(30))
    assert Files(spark, out).names(out) == ["ingest_group=0", "ingest_group=1"]


def test_stream_that_dies_after_a_batch_was_written(spark):
    from tierlake.queries import bronze

    root = scratch_path(spark, "t_stream_crash")
    fx.land_envelopes(bronze(spark, SF_SMALL).repartition(5), f"{root}/landing")
    decoded = ingest.decode_json(ingest.envelope_stream(spark, f"{root}/landing", max_files_per_trigger=1))
    sink, died = ingest.compacting_sink(f"{root}/out", 2), []

    def dies_once(batch, i):
        sink(batch, i)
        if i == 2 and not died:
            died.append(i)
            raise RuntimeError("lost after the write")
    for _ in range(2):
        q = decoded.writeStream.foreachBatch(dies_once).option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        except Exception:
            assert died == [2]
    assert canon(ingest.read_compacting(spark, f"{root}/out", BRONZE_EVENT)) == canon(bronze(spark, SF_SMALL))


# ---------------------------------------------------------------- change feeds

def test_gold_changes_replay_to_the_new_state(spark):
    run = layers.LayerRun(scratch_path(spark, "t_gold_feed"))
    ts = "2024-01-0{}"

    def state(rows):
        return spark.createDataFrame(rows, "city string, locality string, d string, avg_price double, listing_count long").select(
            "city", "locality", F.col("d").cast("timestamp").alias("event_date"), "avg_price", "listing_count")
    first = state([("A", "x", ts.format(1), 1.5, 2), ("A", None, ts.format(1), 2.5, 3), (None, None, None, 4.0, 4), ("B", "1:x", ts.format(2), 9.0, 1)])
    second = state([("A", "x", ts.format(1), 1.5, 2), ("A", None, ts.format(1), 2.75, 3), ("C", "y", ts.format(2), 1.0, 1), ("B", "1:x", ts.format(2), 9.0, 2)])
    name, key = "price_trend_by_locality", layers.GOLD_KEYS["price_trend_by_locality"]
    assert {r._change_type for r in layers.record_changes(spark, run, name, first).collect()} == {"insert"}
    feed = layers.record_changes(spark, run, name, second)
    kinds = sorted(r._change_type for r in feed.collect())
    assert kinds == ["delete", "insert", "update_postimage", "update_postimage", "update_preimage", "update_preimage"]
    assert canon(dims.apply_change_feed(first, feed, key)) == canon(second)
    assert layers.record_changes(spark, run, name, second).count() == 0
    assert spark.table(f"{run.database}.{name}_changes").count() == 10


def test_change_feed_of_a_composite_key_and_new_column(spark):
    a = spark.createDataFrame([(1, "x", 5), (1, "y", 6), (2, "x", 7)], "k int, g string, v int")
    b = spark.createDataFrame([(1, "x", 5, None), (1, "y", 8, "n"), (3, "x", 7, "n")], "k int, g string, v int, w string")
    feed = dims.change_feed(a, b, ["k", "g"])
    assert feed.count() == 4 and "w" in feed.columns
    assert canon(dims.apply_change_feed(a, feed, ["k", "g"])) == canon(b)


def test_composite_keys_in_merges(spark):
    dim = spark.createDataFrame([(1, "x", "old"), (1, "y", "old")], "k int, g string, tier string")
    feed = spark.createDataFrame([(1, "y", "new"), (2, "x", "new")], "k int, g string, tier string")
    assert canon(dims.scd1_upsert(dim, feed, ["k", "g"])) == [(1, "x", "old"), (1, "y", "new"), (2, "x", "new")]
    hist = dims.scd2_apply(dims.scd2_init(dim, "2024-01-01"), feed, ["k", "g"], ["tier"], as_of="2024-01-05")
    assert sorted((r.k, r.g, r.tier, r.scd_version, r.is_current) for r in hist.collect()) == [
        (1, "x", "old", 1, True), (1, "y", "new", 2, True), (1, "y", "old", 1, False), (2, "x", "new", 1, True)]
    with pytest.raises(Exception, match="without a key"):
        dims.scd1_upsert(dim, spark.createDataFrame([(1, None, "z")], dim.schema), ["k", "g"]).count()


def events(spark, rows):
    return spark.createDataFrame([(str(i), kind, city, "L", p, 1, 1, "a", day) for i, kind, city, p, day in rows],
                                 "listing_id string, event_type string, city string, locality string, price long, bedrooms int, "
                                 "area_sqft int, agent_id string, d string").select(
        "*", F.col("d").cast("timestamp").alias("event_timestamp"), F.lit(None).cast("timestamp").alias("ingestion_timestamp")
    ).select(*SILVER_EVENT.fieldNames())


@pytest.mark.parametrize("seed", range(3))
def test_maintained_facts_equal_a_rebuild(spark, seed):
    r = random.Random(seed)
    before = {i: (i, r.choice(["NEW_LISTING", "PRICE_CHANGE", "REMOVED", None]), r.choice(["A", "B", None]), r.choice([0, 5, 5, 9, 30, None]),
                  r.choice(["2024-01-01", "2024-01-02", None])) for i in range(60)}
    after = {i: ((v[0], v[1], v[2], r.choice([0, 5, 9, 30, 70]), v[4]) if r.random() < 0.3 else v) for i, v in before.items() if r.random() < 0.8}
    after.update({i: (i, "NEW_LISTING", "Z", 3, "2024-01-01") for i in range(100, 105)})
    b, a = events(spark, before.values()), events(spark, after.values())
    feed = dims.change_feed(b, a, "listing_id")
    got = agg.maintain_market_facts(agg.market_facts(b), feed, a)
    assert canon(got) == canon(agg.market_facts(a))


def test_only_groups_that_lost_an_extreme_are_computed_anew(spark):
    b = events(spark, [(1, "NEW_LISTING", "A", 5, "2024-01-01"), (2, "NEW_LISTING", "A", 9, "2024-01-01"),
                       (3, "NEW_LISTING", "B", 5, "2024-01-01"), (4, "NEW_LISTING", "B", 9, "2024-01-01"), (5, "NEW_LISTING", "B", 7, "2024-01-01")])
    a = events(spark, [(1, "NEW_LISTING", "A", 5, "2024-01-01"), (3, "NEW_LISTING", "B", 5, "2024-01-01"), (4, "NEW_LISTING", "B", 9, "2024-01-01")])
    # the events handed over hold A only: B must not be computed anew
    got = agg.maintain_market_facts(agg.market_facts(b), dims.change_feed(b, a, "listing_id"), a.where("city = 'A'"))
    assert canon(got) == canon(agg.market_facts(a))


# ---------------------------------------------------------------- rank and as-of

def test_rank_over_many_ranges(spark, monkeypatch):
    from tierlake.operators import windows
    from tierlake.operators.windows import rank_within

    r = random.Random(1)
    rows = [(r.choice(["a", "a", "a", "b", None]), r.choice([None, *range(300)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, x long, i int")
    df.createOrReplaceTempView("t_rank")
    want = spark.sql("SELECT g, x, i, CAST(RANK() OVER (PARTITION BY g ORDER BY x DESC) AS BIGINT) AS rank, "
                     "SUM(x) OVER (PARTITION BY g) AS t FROM t_rank")
    assert canon(rank_within(df, "g", "x", total_col="t", ranges=7)) == canon(want)
    # several chunks of ranges
    monkeypatch.setattr(windows, "CHUNK_RANGES", 3)
    assert canon(rank_within(df, "g", "x", total_col="t", ranges=20)) == canon(want)


def test_valid_at_against_the_range_join_under_skew(spark):
    r = random.Random(2)
    facts = [(r.choice(["hot", "hot", "k1", "k2", "none", None]), f"2024-01-{r.randrange(1, 29):02d} {r.randrange(24):02d}:00:00", i)
             for i in range(2000)]
    facts += [("hot", None, 5000), ("k1", "2024-01-10 00:00:00", 5001), ("hot", "2023-01-01 00:00:00", 5002)]
    versions = []
    for key in ("hot", "k1", "k2"):
        cuts = sorted(r.sample(range(1, 28), 4))
        for v, (s, e) in enumerate(zip(cuts, [*cuts[1:], None])):
            gap = key == "k2" and v == 1                 # closed before the next one starts
            end = None if e is None else f"2024-01-{e - gap:02d} 00:00:00"
            versions.append((key, v + 1, f"2024-01-{s:02d} 00:00:00", end if end is None or end > f"2024-01-{s:02d} 00:00:00" else f"2024-01-{s:02d} 01:00:00"))
    f = spark.createDataFrame(facts, "agent_id string, t string, i int").select("agent_id", F.col("t").cast("timestamp").alias("t"), "i")
    h = spark.createDataFrame(versions, "agent_id string, scd_version int, s string, e string").select(
        "agent_id", "scd_version", F.col("s").cast("timestamp").alias("effective_start_date"), F.col("e").cast("timestamp").alias("effective_end_date"))
    got = dims.valid_at(f, h, "agent_id", "t")
    want = f.alias("f").join(h.alias("h"), (F.col("f.agent_id") == F.col("h.agent_id")) & (F.col("t") >= F.col("effective_start_date"))
                             & (F.col("effective_end_date").isNull() | (F.col("t") < F.col("effective_end_date")))).select(
        "f.agent_id", "t", "i", "scd_version", "effective_start_date", "effective_end_date")
    assert got.columns == want.columns and canon(got) == canon(want) and got.count() > 500


# ---------------------------------------------------------------- rescued rows

def test_nothing_is_lost_on_decode(spark):
    bodies = ['{"listing_id": "1", "price": 5, "pool": "yes", "size": {"a": 1}}', '{"listing_id": "2"', '{"listing_id": "3", "price": "much"}',
              "[]", "null", "", None, "7", '{"listing_id": "4"}', " {} "]
    df = spark.createDataFrame([(None if b is None else bytearray(b.encode()),) for b in bodies], "body binary")
    raw = ingest.decode_json_rescued(df)
    kept = {r.listing_id: r[ingest.RESCUED] for r in ingest.kept_rows(raw).collect()}
    assert kept == {"1": {"pool": "yes", "size": '{"a":1}'}, "4": None, None: None}
    bad = sorted((r.record or "-", r.fault) for r in ingest.quarantined_rows(raw).collect())
    assert bad == sorted([(b or "-", "malformed") for b in (*bodies[1:6], "7")] + [("-", "no body")])
    counts = {r.outcome: r.row_count for r in ingest.fault_counts(raw).collect()}
    assert sum(counts.values()) == len(bodies) and counts["kept"] == 3


def test_ids_of_registered_partitioned_tables(spark):
    root = scratch_path(spark, "t_reg")
    catalog.create_database(spark, "t_reg_db", f"{root}/_db")
    t = table(spark, "t", slices=by_key("id", 4))
    t.overwrite(spark.range(20))
    catalog.register_table(spark, "t_reg_db", "t", t.location())
    assert spark.table("t_reg_db.t").count() == 20
    t.overwrite(spark.range(30))
    catalog.register_table(spark, "t_reg_db", "t", t.location())
    assert spark.table("t_reg_db.t").count() == 30
    assert os.path.basename(t.location()).startswith("load-")
