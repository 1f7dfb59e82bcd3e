"""Deduplication.

All forms are aggregates, never windows: Spark plans them as a partial
aggregate before the shuffle and a final one after, so a key that holds a
third of the rows is first collapsed inside every map task and reaches its
reducer as one row per task, not as one huge group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVENT_KEYS = ("listing_id", "event_type", "event_timestamp")


def drop_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key; which one is unspecified (Spark's ``first``).

    Use when copies are identical, or when any survivor is acceptable.
    """
    return df.dropDuplicates(list(keys))


def keep_by_order(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  latest: bool = True) -> DataFrame:
    """Keep, per key, the row with the greatest (``latest``) or least ``order``.

    The row is packed as ``struct(order..., rest...)`` and reduced with
    ``max``/``min``: struct comparison is field by field, so the order
    columns decide and the remaining columns break ties, which makes the
    survivor deterministic even among exact ties.
    """
    keys = list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      F.struct(*[F.col(c) for c in order + rest]).alias("_row"))
    pick = F.max(packed) if latest else F.min(packed)
    out = df.groupBy(*keys).agg(pick.alias("_best"))
    return out.select(*[F.col(c) for c in keys],
                      *[F.col(f"_best._row.{c}").alias(c) for c in order + rest]).select(*df.columns)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once, with their multiplicity (``copies``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))
