"""Data-quality gates as one aggregate.

Row-level gates (completeness, validity, range, timeliness) are
``count_if`` columns of a single global aggregate, so the whole report is
one scan with map-side partial aggregation.  The uniqueness gate needs a
shuffle on its key and is computed as its own small aggregate and appended
to the report.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.schemas import EVENT_TYPES


@dataclass(frozen=True)
class Gate:
    name: str
    violation: Column | None  # row predicate; None for the volume gate


def listing_gates(as_of: str | None = None, max_age_days: int | None = None) -> list[Gate]:
    """The clean-table gates.  NULL passes validity and range (NULL is not
    a violation there; completeness gates catch it)."""
    gates = [
        Gate("completeness_listing_id", F.col("listing_id").isNull()),
        Gate("completeness_event_timestamp", F.col("event_timestamp").isNull()),
        Gate("validity_event_type", ~F.col("event_type").isin(EVENT_TYPES)),
        Gate("range_price", F.col("price") < 0),
        Gate("range_bedrooms", (F.col("bedrooms") <= 0) | (F.col("bedrooms") > 20)),
        Gate("volume", None),
    ]
    if as_of is not None and max_age_days is not None:
        gates.append(timeliness_gate(as_of, max_age_days))
    return gates


def timeliness_gate(as_of: str, max_age_days: int, column: str = "event_timestamp") -> Gate:
    """Rows whose event time is more than ``max_age_days`` before ``as_of``."""
    cutoff = F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(max_age_days))
    return Gate("timeliness", F.col(column) < cutoff)


def report(df: DataFrame, gates: Sequence[Gate], unique_keys: Sequence[str] | None = None
           ) -> DataFrame:
    """One row per gate: ``check, violations, total, passed``.

    The volume gate has one violation when the table is empty.  With
    ``unique_keys`` a ``uniqueness`` row counts surplus copies of the key.
    """
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, g in enumerate(gates):
        if g.violation is not None:
            aggs.append(F.count_if(g.violation).alias(f"_v{i}"))
    totals = df.agg(*aggs)
    rows = []
    for i, g in enumerate(gates):
        v = (F.when(F.col("_total") == 0, 1).otherwise(0).cast("long") if g.violation is None
             else F.col(f"_v{i}"))
        rows.append(F.struct(F.lit(g.name).alias("check"), v.alias("violations")))
    out = totals.select(F.explode(F.array(*rows)).alias("g"), "_total").select(
        "g.check", "g.violations", F.col("_total").alias("total"))
    if unique_keys:
        out = out.unionByName(uniqueness(df, unique_keys))
    return out.withColumn("passed", F.col("violations") == 0)


def uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Surplus copies of ``keys`` (rows minus distinct keys), as a report row."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit("uniqueness").alias("check"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("violations"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"))


class QualityGateError(AssertionError):
    pass


def enforce(report_df: DataFrame) -> DataFrame:
    """Raise if any gate failed; returns the report unchanged otherwise.

    Collects the report itself, which has one row per gate.
    """
    failed = [(r["check"], r["violations"]) for r in
              report_df.filter(~F.col("passed")).select("check", "violations").collect()]
    if failed:
        raise QualityGateError("quality gates failed: " + ", ".join(
            f"{name} ({n} violations)" for name, n in failed))
    return report_df
