"""Join helpers: broadcast a side only behind a measured size bound.

Static planning broadcasts a parquet side below ``autoBroadcastJoinThreshold``
from its file size; AQE can later demote a shuffled join, but only after the
big side has already been shuffled.  For dimensions that are larger on disk
than the threshold yet small after pruning, an explicit, measured decision
avoids that shuffle.  Above the bound the join stays a shuffled sort-merge
join (AQE splits skewed partitions of it, NULL keys included).

The bound is proven, not guessed: one aggregate over the (column-pruned) side
returns its row count and the exact byte length of its variable-width columns;
fixed-width columns add their width per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_ROWS = 4_000_000
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
    T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.DecimalType: 16,
}
_ROW_OVERHEAD = 16


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated in-memory bytes) of ``df`` in one aggregate job."""
    fixed = 0
    var_cols = []
    for f in df.schema.fields:
        width = next((w for t, w in _FIXED_WIDTH.items() if isinstance(f.dataType, t)), None)
        if width is not None:
            fixed += width
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var_cols.append(f.name)
        else:  # nested values: measure their JSON text length as a proxy
            var_cols.append(f.name)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(var_cols):
        c = F.col(f"`{name}`")
        dtype = df.schema[name].dataType
        size = F.octet_length(c) if isinstance(dtype, (T.StringType, T.BinaryType)) \
            else F.length(F.to_json(F.struct(c)))
        aggs.append(F.coalesce(F.sum(size), F.lit(0)).alias(f"v{i}"))
    r = df.agg(*aggs).first()
    rows = int(r["rows"])
    var_bytes = sum(int(r[f"v{i}"]) for i in range(len(var_cols)))
    return rows, rows * (fixed + _ROW_OVERHEAD + 8 * len(var_cols)) + var_bytes


def sized_broadcast(
    df: DataFrame,
    max_rows: int | None = DEFAULT_BROADCAST_ROWS,
    known_rows: int | None = None,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> tuple[DataFrame, bool]:
    """Return ``(df_or_broadcast_df, broadcasted)``.

    ``df`` should already be pruned to the columns the join needs.  When the
    caller knows the row count (the DQ gate counts the delta) and the rows fit
    comfortably, the byte measurement is still taken, as rows alone bound
    nothing.  ``max_rows=None`` disables explicit broadcasting and leaves the
    choice to the planner; ``max_rows=0`` forces the shuffled plan.
    """
    if max_rows is None:
        return df, False
    if max_rows == 0 or (known_rows is not None and known_rows > max_rows):
        return df, False
    rows, size = measure(df)
    if rows <= max_rows and size <= max_bytes:
        return F.broadcast(df), True
    return df, False


def row_hash(df: DataFrame):
    """Deterministic hash of a row's hashable columns (maps cannot be hashed)."""
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields
            if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("bigint")


def hot_keys(fact: DataFrame, key: str, partitions: int) -> DataFrame:
    """Keys holding more than a fair partition share (``rows / partitions``) of ``fact``.

    Returns ``(_hk, _salts)``: the key and how many ways to split it
    (``ceil(rows_of_key / share)``, at least 2).  At most ``partitions`` keys
    can exceed the share, so the result has a proven bound and can be
    broadcast.  Only the key column is read; the per-key count is a partial
    aggregate (one row per key per map task reaches the shuffle).
    """
    k = F.col(f"`{key}`")
    per_key = fact.select(k.alias("_hk")).filter(F.col("_hk").isNotNull()) \
        .groupBy("_hk").agg(F.count(F.lit(1)).alias("_n"))
    total = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    parts = F.lit(max(1, partitions))
    return per_key.filter((F.col("_n") * parts > total) & (F.col("_n") > 1)).select(
        "_hk", F.greatest(F.ceil(F.col("_n") * parts / total), F.lit(2)).cast("int")
        .alias("_salts"))


def skew_left_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    max_rows: int | None = DEFAULT_BROADCAST_ROWS,
    partitions: int | None = None,
    key_source: DataFrame | None = None,
    salt_by: str | None = None,
) -> DataFrame:
    """``fact ⟕ dim ON fact_key = dim_key`` that survives hot keys.

    * a dimension within the measured broadcast bound is simply broadcast;
    * otherwise the join is salted: each hot key (see :func:`hot_keys`) is
      spread over ``_salts`` sub-keys — fact rows pick one by a deterministic
      row hash, the key's dimension rows are replicated once per sub-key — and
      NULL keys (which never match) are spread over all partitions.  The fact
      is read once; only the hot keys' dimension rows are copied.

    ``key_source`` (default ``fact``) is where hot keys are counted, e.g. the
    base table when ``fact`` is itself a join result with the same key spread.
    ``salt_by`` names a well-spread fact column to salt with (a row id), so that the
    join reads no column only for its salt; without it all columns are hashed.
    Output: all fact columns, then all dimension columns.  Column names of the
    two sides must not collide.  ``max_rows=0`` forces the salted plan;
    ``None`` leaves the strategy to the planner.
    """
    fk, dk = F.col(f"`{fact_key}`"), F.col(f"`{dim_key}`")
    if max_rows is None:  # no explicit strategy: the planner (and AQE) decides
        return fact.join(dim, fk == dk, "left")
    side, small = sized_broadcast(dim, max_rows)
    if small:
        return fact.join(side, fk == dk, "left")
    spark = fact.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # One small job; the list holds at most `parts` keys, so it is safe to bring
    # back and broadcast as a local relation (computed once, reused by both sides).
    found = hot_keys(key_source if key_source is not None else fact, fact_key, parts).collect()
    key_type = dim.schema[dim_key].dataType
    hot = F.broadcast(spark.createDataFrame(
        [(r["_hk"], r["_salts"]) for r in found],
        T.StructType([T.StructField("_hk", key_type), T.StructField("_salts", T.IntegerType())])))
    hashed = row_hash(fact) if salt_by is None else F.xxhash64(F.col(f"`{salt_by}`"))
    salted_fact = fact.join(hot, fk == F.col("_hk"), "left").select(
        *[F.col(f"`{c}`") for c in fact.columns],
        F.when(F.col("_salts").isNotNull(), F.pmod(hashed, F.col("_salts")))
        .when(fk.isNull(), F.pmod(hashed, F.lit(parts)))
        .otherwise(F.lit(0)).cast("int").alias("__fsalt"),
    )
    salted_dim = dim.join(hot, dk == F.col("_hk"), "left").select(
        *[F.col(f"`{c}`") for c in dim.columns],
        F.explode(F.when(F.col("_salts").isNotNull(),
                         F.sequence(F.lit(0), F.col("_salts") - 1))
                  .otherwise(F.array(F.lit(0)))).alias("__dsalt"),
    )
    joined = salted_fact.join(salted_dim, (fk == dk) & (F.col("__fsalt") == F.col("__dsalt")),
                              "left")
    return joined.drop("__fsalt", "__dsalt")
