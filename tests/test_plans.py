"""Plan-shape checks: the scale properties the design relies on."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tierlake.plans.layers import LayerRun
from tierlake.queries import QUERIES, silver
from tierlake.session import scratch_path

from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_join_or_python_in_plan(spark, key):
    text = plan_text(entry.queries()[key](spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in text]


def test_point_filters_reach_the_scan(spark):
    run = LayerRun(scratch_path(spark, "t_pushdown"))
    t = run.silver(spark)
    t.overwrite(silver(spark, SF_SMALL))
    q = t.read().filter((F.col("city") == "ASIA") & (F.col("event_type") == "NEW_LISTING")) \
        .agg(F.count(F.lit(1)).alias("n"))
    text = plan_text(q)
    assert "EqualTo(city,ASIA)" in text and "EqualTo(event_type,NEW_LISTING)" in text
    assert "ReadSchema: struct<event_type:string,city:string>" in text


def test_dedup_combines_before_the_shuffle(spark):
    text = plan_text(silver(spark, SF_SMALL))
    assert "partial_min" in text                       # map-side combine of copies
    assert text.index("partial_min") < text.rindex("Exchange")


def test_gold_aggregates_before_joining_the_dimension(spark):
    text = plan_text(entry.queries()["gold_agent_performance"](spark, SF_SMALL))
    phys = text.split("== Physical Plan ==")[1].split("\n\n")[0]
    join_line = next(i for i, ln in enumerate(phys.splitlines()) if "Join" in ln)
    below = "\n".join(phys.splitlines()[join_line:])
    assert "HashAggregate" in below                    # facts are aggregated under the join


def test_rank_has_no_window_over_a_whole_group(spark):
    from tierlake.operators.windows import rank_within

    text = plan_text(rank_within(spark.range(100).selectExpr("id % 2 AS g", "id AS x"), "g", "x", total_col="t"))
    windows = [ln for ln in text.splitlines() if "windowspecdefinition" in ln]
    assert windows and all("windowspecdefinition(_range" in ln for ln in windows)


def test_valid_at_has_no_range_predicate_and_splits_a_key_by_time(spark):
    text = plan_text(entry.queries()["agent_pre_post_move"](spark, SF_SMALL))
    joins = [ln for ln in text.splitlines() if ln.startswith("Join condition")]
    assert not [ln for ln in joins if "<" in ln or ">" in ln]
    assert any(w.startswith("agent_id") and "_slice" in w.split(", ")[1] for w in text.split("windowspecdefinition(")[1:])


def test_snapshots_are_compared_without_a_shuffle(spark):
    from tierlake.operators import dimensions as dims
    from tierlake.plans.catalog import create_database

    root = scratch_path(spark, "t_buckets")
    create_database(spark, "t_buckets", f"{root}/_db")
    for name, n in (("a", 100), ("b", 120)):
        dims.write_snapshot(spark.range(n).selectExpr("id % 50 AS g", "id AS k", "id * 2 AS v"), ["g", "k"], f"t_buckets.{name}",
                            f"{root}/{name}", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feed = dims.snapshot_changes(spark.table("t_buckets.a"), spark.table("t_buckets.b"))
        text = plan_text(feed)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert feed.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
