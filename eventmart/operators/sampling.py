"""Limits, reproducible samples and counter deltas.

* ``limit_rows`` orders first when asked, so the result is deterministic; with
  an order it plans as a top-k (``TakeOrderedAndProject``), never a full sort.
* ``sample_rows`` takes the ``k`` rows with the smallest seeded hash of the key
  — a uniform sample without replacement that any engine can reproduce (MD5 of
  ``"<seed>:<key>"``), again a top-k.
* ``apply_counter_deltas`` adds increments to counters by key; increments are
  summed per key first (partial aggregation before the shuffle), then left
  joined, so a key with many delta rows costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators.joins import DEFAULT_BROADCAST_ROWS, sized_broadcast


def limit_rows(df: DataFrame, n: int = 50, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """L1: ``LIMIT n`` (default 50), ordered when ``order_by`` is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def sample_key_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_rows(df: DataFrame, k: int, key: str, seed: int = 42) -> DataFrame:
    """L2: ``min(k, n)`` rows without replacement, reproducible from ``seed``."""
    return df.orderBy(sample_key_hash(key, seed), F.col(key)).limit(k)


def apply_counter_deltas(
    base: DataFrame,
    deltas: DataFrame,
    key: str,
    cols: Sequence[str],
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``coalesce(base, 0) + coalesce(sum(delta), 0)`` for each counter, by key.

    Rows of ``base`` without a delta get ``coalesce(x, 0)`` (the generator's
    ``(x or 0) + d`` with ``d = 0``); delta keys absent from ``base`` are ignored.
    """
    summed = deltas.groupBy(key).agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"__d_{c}") for c in cols])
    side, _ = sized_broadcast(summed, broadcast_rows)
    joined = base.join(side, key, "left")
    out = []
    for c in base.columns:
        if c in cols:
            out.append((F.coalesce(F.col(c), F.lit(0))
                        + F.coalesce(F.col(f"__d_{c}"), F.lit(0))).cast("bigint").alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)
