"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from tierlake.functions.columns import (count_where, normalized_label, parse_event_time,
                                        positive_or_null, price_or_zero, trimmed)

__all__ = ["count_where", "normalized_label", "parse_event_time", "positive_or_null",
           "price_or_zero", "trimmed"]
