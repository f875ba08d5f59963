"""Reusable column expressions (all built-in Spark functions, no UDFs)."""

from eventmart.functions.columns import (
    avg_zero_filled,
    count_rows,
    default_if_blank,
    first_present,
    raw,
    sum_zero_filled,
    unknown_if_null,
    zero_if_null,
)
from eventmart.functions.stamps import compact_stamp, delta_event_id, epoch_millis_now

__all__ = [
    "avg_zero_filled",
    "count_rows",
    "default_if_blank",
    "first_present",
    "raw",
    "sum_zero_filled",
    "unknown_if_null",
    "zero_if_null",
    "compact_stamp",
    "delta_event_id",
    "epoch_millis_now",
]
