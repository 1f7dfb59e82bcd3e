"""SCD1 / SCD2 / change feed on hand-written rows and generated feeds."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tierlake.operators import dimensions as dims
from tierlake.schemas import AGENT, AGENT_SCD2

T0, T1, T2 = "2024-01-01 00:00:00", "2024-01-15 00:00:00", "2024-01-20 00:00:00"


def agents(spark, rows):
    return spark.createDataFrame(rows, AGENT)


def a(key, city="C1", tier="Std", name=None):
    return (key, name or f"agent {key}", city, tier, 4.0, 10)


def canon(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def history_of(df, key):
    return [(r.base_city, r.scd_version, r.is_current, r.effective_start_date,
             r.effective_end_date)
            for r in df.filter(df.agent_id == key).orderBy("scd_version").collect()]


def test_scd1_updates_set_columns_and_inserts(spark):
    dim = agents(spark, [a("1"), a("2"), a("3", tier=None)])
    upd = agents(spark, [(("1", "other name", "C9", "Premium", 1.0, 1)), a("4", tier="Elite"),
                         a("3", tier="Gold")])
    out = {r.agent_id: r for r in dims.scd1_upsert(dim, upd).collect()}
    assert len(out) == 4
    assert out["1"].tier == "Premium" and out["1"].agent_name == "agent 1"   # only tier set
    assert out["1"].base_city == "C1"
    assert out["2"].tier == "Std"
    assert out["3"].tier == "Gold"                                           # NULL replaced
    assert out["4"].tier == "Elite" and out["4"].agent_name == "agent 4"     # insert


def test_scd1_rejects_duplicate_source_key(spark):
    dim = agents(spark, [a("1")])
    upd = agents(spark, [a("1", tier="X"), a("1", tier="Y")])
    with pytest.raises((Py4JJavaError, PySparkException)):
        dims.scd1_upsert(dim, upd).collect()


def test_scd2_apply_cases(spark):
    hist = dims.scd2_init(agents(spark, [a("1"), a("2"), a("3"), a("4", city=None)]), T0)
    feed = agents(spark, [a("1", city="C2"),            # move
                          a("2", city="C1", tier="Gold"),  # no tracked change -> no-op
                          a("5", city="C7"),            # new key
                          a("4", city=None)])           # NULL -> NULL: no-op
    out = dims.scd2_apply(hist, feed, as_of=T1)
    assert history_of(out, "1") == [
        ("C1", 1, False, datetime(2024, 1, 1), datetime(2024, 1, 15)),
        ("C2", 2, True, datetime(2024, 1, 15), None)]
    assert history_of(out, "2") == [("C1", 1, True, datetime(2024, 1, 1), None)]
    assert history_of(out, "3") == [("C1", 1, True, datetime(2024, 1, 1), None)]
    assert history_of(out, "4") == [(None, 1, True, datetime(2024, 1, 1), None)]
    assert history_of(out, "5") == [("C7", 1, True, datetime(2024, 1, 15), None)]
    # applying the same feed again changes nothing
    again = dims.scd2_apply(out, feed, as_of=T1)
    assert canon(again.collect()) == canon(out.collect())
    # a NULL city is a change (null-safe compare), in both directions
    out2 = dims.scd2_apply(out, agents(spark, [a("1", city=None), a("4", city="C3")]), as_of=T2)
    assert [h[0] for h in history_of(out2, "1")] == ["C1", "C2", None]
    assert [h[0] for h in history_of(out2, "4")] == [None, "C3"]


def test_scd2_several_changes_in_one_feed(spark):
    hist = dims.scd2_init(agents(spark, [a("1")]), T0)
    rows = [("1", "n", "C2", "t", 1.0, 1, datetime(2024, 1, 5)),
            ("1", "n", "C2", "t", 1.0, 1, datetime(2024, 1, 6)),   # repeat -> no-op
            ("1", "n", "C1", "t", 1.0, 1, datetime(2024, 1, 9)),   # back to old city
            ("9", "n", "C4", "t", 1.0, 1, datetime(2024, 1, 3))]
    feed = spark.createDataFrame(rows, AGENT.simpleString()[:-1] + ",ts:timestamp>")
    out = dims.scd2_apply(hist, feed, change_time="ts")
    assert [(h[0], h[1], h[2]) for h in history_of(out, "1")] == [
        ("C1", 1, False), ("C2", 2, False), ("C1", 3, True)]
    ends = [h[4] for h in history_of(out, "1")]
    assert ends == [datetime(2024, 1, 5), datetime(2024, 1, 9), None]
    # stale rows (not newer than the current version) are ignored on replay
    assert canon(dims.scd2_apply(out, feed, change_time="ts").collect()) == \
        canon(out.collect())


def test_scd2_rejects_two_rows_same_key_and_time(spark):
    hist = dims.scd2_init(agents(spark, [a("1")]), T0)
    with pytest.raises((Py4JJavaError, PySparkException)):
        dims.scd2_apply(hist, agents(spark, [a("1", city="X"), a("1", city="Y")]),
                        as_of=T1).collect()


def test_scd2_queries(spark):
    hist = dims.scd2_apply(dims.scd2_init(agents(spark, [a("1"), a("2")]), T0),
                           agents(spark, [a("1", city="C2")]), as_of=T1)
    c = dims.scd2_counts(hist).first()
    assert (c.total_records, c.current_records, c.historical_records) == (3, 2, 1)
    assert [r.agent_id for r in dims.scd2_changed_keys(hist).collect()] == ["1"]
    assert dims.scd2_dedup(hist.unionByName(hist)).count() == 3
    assert dims.scd2_current(hist).count() == 2


def test_valid_time_join_boundaries(spark):
    hist = dims.scd2_apply(dims.scd2_init(agents(spark, [a("1")]), T0),
                           agents(spark, [a("1", city="C2")]), as_of=T1)
    facts = spark.createDataFrame(
        [("1", datetime(2024, 1, 1)), ("1", datetime(2024, 1, 15)), ("1", datetime(2023, 12, 31))],
        "agent_id string, ts timestamp")
    got = sorted((r.ts, r.scd_version) for r in dims.valid_at(facts, hist, "agent_id", "ts")
                 .collect())
    # exactly at a start -> that version; at an end -> the next version; before -> none
    assert got == [(datetime(2024, 1, 1), 1), (datetime(2024, 1, 15), 2)]


def test_change_feed_kinds(spark):
    before = agents(spark, [a("1"), a("2"), a("3")])
    after = agents(spark, [a("1"), a("2", tier="Gold"), a("4")])
    got = sorted((r.agent_id, r._change_type, r.tier)
                 for r in dims.change_feed(before, after, "agent_id").collect())
    assert got == [("2", "update_postimage", "Gold"), ("2", "update_preimage", "Std"),
                   ("3", "delete", "Std"), ("4", "insert", "Std")]


cities = st.sampled_from(["C1", "C2", "C3", None])
snapshots = st.dictionaries(st.sampled_from([str(i) for i in range(8)]), cities, max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(before=snapshots, after=snapshots)
def test_change_feed_replays_to_new_snapshot(spark, before, after):
    b = agents(spark, [a(k, city=c) for k, c in before.items()])
    n = agents(spark, [a(k, city=c) for k, c in after.items()])
    replayed = dims.apply_change_feed(b, dims.change_feed(b, n, "agent_id"), "agent_id")
    assert canon(replayed.collect()) == canon(n.collect())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(initial=snapshots, feed=snapshots)
def test_scd2_invariants(spark, initial, feed):
    hist = dims.scd2_init(agents(spark, [a(k, city=c) for k, c in initial.items()]), T0)
    f = agents(spark, [a(k, city=c) for k, c in feed.items()])
    out = dims.scd2_apply(hist, f, as_of=T1)
    rows = out.collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.agent_id, []).append(r)
    assert set(by_key) == set(initial) | set(feed)
    for k, vs in by_key.items():
        vs.sort(key=lambda r: r.scd_version)
        assert [v.scd_version for v in vs] == list(range(1, len(vs) + 1))   # contiguous
        assert sum(v.is_current for v in vs) == 1 and vs[-1].is_current    # one current
        for prev, nxt in zip(vs, vs[1:]):
            assert prev.effective_end_date == nxt.effective_start_date       # gap-free
        latest = feed.get(k, initial.get(k)) if k in feed else initial[k]
        assert vs[-1].base_city == latest
    again = dims.scd2_apply(out, f, as_of=T1)
    assert canon(again.collect()) == canon(rows)  # idempotent
    assert out.schema == AGENT_SCD2 or [x.name for x in out.schema] == AGENT_SCD2.fieldNames()


def test_scd2_key_with_only_closed_versions_continues_numbering(spark):
    closed = [("1", "n", "C1", "t", 1.0, 1, datetime(2024, 1, 1), datetime(2024, 1, 5), False, 1),
              ("1", "n", "C2", "t", 1.0, 1, datetime(2024, 1, 5), datetime(2024, 1, 9), False, 2)]
    hist = spark.createDataFrame(closed, AGENT_SCD2)
    out = dims.scd2_apply(hist, agents(spark, [a("1", city="C3")]), as_of=T1)
    assert [(h[0], h[1], h[2]) for h in history_of(out, "1")] == [
        ("C1", 1, False), ("C2", 2, False), ("C3", 3, True)]


def test_scd2_is_generic_over_the_dimension(spark):
    rows = [("p1", "red", 3), ("p2", "blue", 5)]
    dim = spark.createDataFrame(rows, "sku string, colour string, size int")
    hist = dims.scd2_init(dim, T0)
    feed = spark.createDataFrame([("p1", "green", 3), ("p3", "black", 1)],
                                 "sku string, colour string, size int")
    out = dims.scd2_apply(hist, feed, key="sku", tracked=["colour"], as_of=T1)
    assert out.columns == ["sku", "colour", "size", "effective_start_date",
                           "effective_end_date", "is_current", "scd_version"]
    got = sorted((r.sku, r.colour, r.scd_version, r.is_current) for r in out.collect())
    assert got == [("p1", "green", 2, True), ("p1", "red", 1, False), ("p2", "blue", 1, True),
                   ("p3", "black", 1, True)]


def test_rows_without_key_and_late_rows(spark):
    import pytest

    hist = dims.scd2_init(spark.createDataFrame([("1", "A", 1), (None, "B", 1)], "k string, city string, n int"),
                          "2024-01-01 00:00:00")
    bad = spark.createDataFrame([(None, "C", 1)], "k string, city string, n int")
    with pytest.raises(Exception, match="without a key"):
        dims.scd2_apply(hist, bad, "k", ["city"], as_of="2024-02-01 00:00:00").collect()
    with pytest.raises(Exception, match="without a key"):
        dims.scd1_upsert(hist.select("k", "city", "n"), bad, "k", ["city"]).collect()
    feed = spark.createDataFrame([("1", "C", 1)], "k string, city string, n int")
    now = dims.scd2_apply(hist, feed, "k", ["city"], as_of="2024-02-01 00:00:00")
    assert now.count() == 3
    late = spark.createDataFrame([("1", "D", 1)], "k string, city string, n int")
    for when, n in (("2023-06-01 00:00:00", 1), ("2024-01-20 00:00:00", 1), ("2024-03-01 00:00:00", 0)):
        assert dims.scd2_late(now, late, "k", ["city"], as_of=when).count() == n
    assert dims.scd2_late(now, feed, "k", ["city"], as_of="2024-02-01 00:00:00").count() == 0
    assert dims.scd2_apply(now, late, "k", ["city"], as_of="2023-06-01 00:00:00").count() == 3
    same = hist.select("k", "city", "n")
    kinds = [r[0] for r in dims.change_feed(same, same.filter("k = '1'"), "k").select("_change_type").collect()]
    assert kinds == ["delete"]


def test_merges_read_each_input_once(spark):
    from tierlake.operators import star
    from tierlake.session import scratch_path
    import contextlib
    import io

    def scans(df):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("simple")
        return out.getvalue().count("FileScan")

    def table(df):
        path = scratch_path(spark, "t_scans")
        df.write.parquet(path)
        return spark.read.parquet(path)
    master = table(spark.createDataFrame([("1", "A", 1)], "agent_id string, base_city string, tier int"))
    feed = table(spark.createDataFrame([("1", "B", 2)], "agent_id string, base_city string, tier int"))
    assert scans(dims.scd1_upsert(master, feed)) == 2
    history = table(dims.scd2_init(master.selectExpr("agent_id", "'x' AS agent_name", "base_city", "tier"),
                                   "2024-01-01 00:00:00"))
    moves = feed.selectExpr("agent_id", "'x' AS agent_name", "base_city", "tier")
    assert scans(dims.scd2_apply(history, moves, as_of="2024-01-15 00:00:00")) == 2
    facts = table(spark.sql("SELECT '1' agent_id, 'A' city, 1L n_listings, 1D pos_sum, 1L pos_cnt"))
    assert scans(star.agent_city_movement_from(facts, history)) == 2
