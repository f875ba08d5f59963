"""Column helpers shared by staging, marts and checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"


def raw(name: str) -> Column:
    """Reference a raw column whose name may contain dots (``fee.amount``)."""
    return F.col(f"`{name}`")


def zero_if_null(c: Column | str) -> Column:
    """NULL counts as 0 *before* aggregation."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(0))


def unknown_if_null(c: Column | str) -> Column:
    """Literal default for a grouping key (P10): NULL and 'UNKNOWN' share a group."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(UNKNOWN))


def first_present(*cols: Column | str, default: str | None = None) -> Column:
    """Two- or three-way fallback (P8, P9): the first non-NULL argument wins."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


# Averaged measures are summed as fixed-point numbers.
SUM_TYPE = "decimal(38,18)"


def default_if_blank(c: Column | str, default: str) -> Column:
    """``value or default`` for text: NULL *and* empty string take the default."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def count_rows() -> Column:
    """``count(*)`` (A1, A2)."""
    return F.count(F.lit(1))


def sum_zero_filled(c: Column | str) -> Column:
    """``sum(coalesce(x, 0))`` (A3)."""
    return F.sum(zero_if_null(c))


def avg_zero_filled(c: Column | str) -> Column:
    """``avg(coalesce(x, 0))`` (A4): divides by *all* rows of the group, not the non-NULL ones.

    The sum is a fixed-point number, as the warehouse's is, so the average does not
    depend on the order of the rows.
    """
    return F.sum(zero_if_null(c).cast(SUM_TYPE)).cast("double") / F.count(F.lit(1))
