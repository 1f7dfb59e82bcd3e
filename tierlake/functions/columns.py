"""Scalar and aggregate column helpers used across the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``
so expressions stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(c: str | Column) -> Column:
    """ISO-8601 string (with or without offset) -> timestamp; bad text -> NULL.

    ANSI mode makes ``to_timestamp`` throw on bad input, so the clean layer
    uses the ``try_`` form and lets a quality gate count the NULLs.
    """
    return F.try_to_timestamp(_col(c))


def normalized_label(c: str | Column) -> Column:
    """``upper(trim(x))`` for code-like labels (event type, city)."""
    return F.upper(F.trim(_col(c)))


def trimmed(c: str | Column) -> Column:
    return F.trim(_col(c))


def price_or_zero(c: str | Column) -> Column:
    """Missing price becomes 0 (REMOVED events carry no price)."""
    return F.coalesce(_col(c).cast("long"), F.lit(0).cast("long"))


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (NULL counts as not true)."""
    return F.count_if(cond)


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the columns' values; null is a value of its own, and values cannot run into
    each other (each goes in with its length)."""
    def part(c: str) -> Column:
        value = F.col(c).cast("string")
        return F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))
    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def positive_or_null(c: str | Column) -> Column:
    """``CASE WHEN x > 0 THEN x END``: feeds AVG/MIN that ignore zero prices."""
    x = _col(c)
    return F.when(x > 0, x)
