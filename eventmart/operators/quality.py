"""Data quality: the staged-batch gate (Q1–Q8) and declarative column tests.

The reference issues one count query per check.  Here the five stage metrics
come from **one** job with one shuffle: a per-key partial aggregate (which also
yields the duplicate-key count) followed by a global aggregate.  A hot key — a
NULL key holding a third of the batch, say — collapses to one row per map task
in the partial aggregate, so it never lands whole on one reducer.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.config.schemas import EVENT_STATUS_DOMAIN

# Check names in recording order, with the failure message of each.
STAGE_CHECKS = [
    ("row_count", "stage table is empty"),
    ("null_event_id", "there are NULL event_id values"),
    ("duplicate_event_id", "there are duplicated event_id values"),
    ("negative_rsvp_values", "there are negative RSVP metrics"),
    ("invalid_status", "event_status outside the allowed domain"),
    ("stage_matches_delta_row_count", "stage row_count does not match delta row_count"),
]

RSVP_COUNTERS = ("yes_rsvp_count", "maybe_rsvp_count", "waitlist_count")
DELTA_EVENT_TYPES = ("DELTA_GENERATED", "DELTA_UPLOADED")


class DataQualityError(ValueError):
    """Raised by the gate after all results are recorded; message joins every failure."""


def _any_negative(cols: Iterable[str]) -> Column:
    conds = [F.coalesce(F.col(c), F.lit(0)) < 0 for c in cols]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def invalid_value(col: str, allowed: Sequence[str]) -> Column:
    """``x IS NOT NULL AND lower(x) NOT IN (allowed)``."""
    return F.col(col).isNotNull() & ~F.lower(F.col(col)).isin(*[a.lower() for a in allowed])


def stage_metrics(
    stage: DataFrame,
    key: str = "event_id",
    counters: Sequence[str] = RSVP_COUNTERS,
    status_col: str = "event_status",
    allowed_status: Sequence[str] = EVENT_STATUS_DOMAIN,
) -> DataFrame:
    """One row: row_count, null_event_id, duplicate_event_id, negative_rsvp_values,
    invalid_status (Q1–Q5).  ``duplicate_event_id`` counts duplicated *keys*; all
    NULL keys form one key, as in ``GROUP BY … HAVING COUNT(*) > 1``."""
    per_key = stage.groupBy(F.col(key).alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(_any_negative(counters)).alias("_neg"),
        F.count_if(invalid_value(status_col, allowed_status)).alias("_inv"),
    )
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0))
        .cast("bigint").alias("null_event_id"),
        F.count_if(F.col("_n") > 1).cast("bigint").alias("duplicate_event_id"),
        F.coalesce(F.sum("_neg"), F.lit(0)).cast("bigint").alias("negative_rsvp_values"),
        F.coalesce(F.sum("_inv"), F.lit(0)).cast("bigint").alias("invalid_status"),
    )


def expected_delta_rows(
    audit: DataFrame,
    dag_id: str,
    run_id: str,
    event_types: Sequence[str] = DELTA_EVENT_TYPES,
) -> DataFrame:
    """``COALESCE(MAX(row_count), 0)`` over the successful delta records of one run."""
    return audit.filter(
        (F.col("dag_id") == dag_id)
        & (F.col("run_id") == run_id)
        & F.col("event_type").isin(*event_types)
        & (F.col("status") == "SUCCESS")
    ).agg(F.coalesce(F.max("row_count"), F.lit(0)).cast("bigint").alias("expected_rows"))


# The audit event of a delta file's rows as they were loaded.
ARRIVED_EVENT_TYPE = "DELTA_ARRIVED"


def reconcile_deltas(audit: DataFrame) -> DataFrame:
    """Announced against arrived rows of every delta file and run of the log.

    Announcements and arrivals of a file are two entries of one append log; of either the
    latest counts (a file can be announced, or sent, again).  A file that only one side
    knows counts as 0 rows on the other.  One row per run - that of the arrival, else of
    the announcement: dag_id, run_id, files, announced_rows, arrived_rows, wrong_files,
    status.
    """
    def latest(events: Sequence[str], name: str) -> DataFrame:
        hit = audit.filter(F.col("event_type").isin(*events) & (F.col("status") == "SUCCESS"))
        at = F.struct("processed_at", "row_count")
        return hit.groupBy(F.col("s3_key").alias(f"{name}_key")).agg(
            F.max_by(F.struct("dag_id", "run_id", "row_count"), at).alias(name))

    announced, arrived = latest(DELTA_EVENT_TYPES, "announced"), latest([ARRIVED_EVENT_TYPE], "arrived")
    files = announced.join(arrived, F.col("announced_key").eqNullSafe(F.col("arrived_key")), "full_outer")
    rows = lambda side: F.coalesce(F.col(f"{side}.row_count"), F.lit(0))
    of = lambda c: F.coalesce(F.col(f"arrived.{c}"), F.col(f"announced.{c}")).alias(c)
    return files.groupBy(of("dag_id"), of("run_id")).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(rows("announced")).cast("bigint").alias("announced_rows"),
        F.sum(rows("arrived")).cast("bigint").alias("arrived_rows"),
        F.count_if(rows("announced") != rows("arrived")).cast("bigint").alias("wrong_files"),
        F.when(F.count_if(rows("announced") != rows("arrived")) == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def stage_check_results(metrics: DataFrame, expected: Column | int) -> DataFrame:
    """One row per check with PASS/FAIL and, on failure, a message (Q7).

    ``expected`` is the announced delta row count: a literal, or a scalar
    subquery column such as ``expected_delta_rows(...).scalar()``.
    """
    exp = F.lit(expected) if isinstance(expected, int) else expected
    names = [name for name, _ in STAGE_CHECKS]
    metric_of = {n: F.col(n) for n in names[:-1]}
    metric_of["stage_matches_delta_row_count"] = F.col("row_count")
    checks = F.explode(F.array(*[
        F.struct(F.lit(i).alias("check_order"), F.lit(n).alias("check_name"),
                 metric_of[n].cast("bigint").alias("metric_value"))
        for i, n in enumerate(names)
    ])).alias("_c")
    long = metrics.select(exp.cast("bigint").alias("_expected"),
                          F.col("row_count").alias("_rows"), checks).select(
        "_expected", "_rows", "_c.*")
    name, value = F.col("check_name"), F.col("metric_value")
    passed = (
        F.when(name == "row_count", value > 0)
        .when(name == "stage_matches_delta_row_count", value == F.col("_expected"))
        .otherwise(value == 0)
    )
    messages = {n: F.lit(text) for n, text in STAGE_CHECKS}
    messages["stage_matches_delta_row_count"] = F.concat(
        F.lit(dict(STAGE_CHECKS)["stage_matches_delta_row_count"] + ": stage "),
        F.col("_rows").cast("string"), F.lit(", delta "), F.col("_expected").cast("string"))
    message = F.lit(None).cast("string")
    for n in reversed(names):
        message = F.when(name == n, messages[n]).otherwise(message)
    return long.select(
        "check_order",
        "check_name",
        "metric_value",
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        F.when(passed, F.lit(None).cast("string")).otherwise(message).alias("error_message"),
    )


def failure_summary(rows: Iterable) -> str | None:
    """``check=value -> message`` for every failed check, joined by `` | `` (Q8)."""
    parts = [f"{r['check_name']}={r['metric_value']} -> {r['error_message']}"
             for r in sorted(rows, key=lambda r: r["check_order"]) if r["status"] == "FAIL"]
    return " | ".join(parts) if parts else None


# ---------------------------------------------------------------------------
# Declarative column tests (T1, T2) and reusable single checks.
# ---------------------------------------------------------------------------

def _status(failures: Column) -> Column:
    return F.when(failures == 0, "PASS").otherwise("FAIL")


def check_not_null(df: DataFrame, cols: Sequence[str], model: str = "") -> DataFrame:
    """One aggregate over the table, one result row per column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_nn_{i}") for i, c in enumerate(cols)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_nn_{i}").alias("failures"))
        for i, c in enumerate(cols)
    ])).alias("_t")
    return agg.select(rows).select(
        F.lit(model).alias("model"), F.col("_t.column_name").alias("column_name"),
        F.lit("not_null").alias("test"), F.col("_t.failures").cast("bigint").alias("failures"),
        _status(F.col("_t.failures")).alias("status"),
    )


def duplicated_keys(df: DataFrame, col: str, include_null: bool = False) -> DataFrame:
    """Keys occurring more than once (A7); NULL keys are dropped unless ``include_null``."""
    src = df if include_null else df.filter(F.col(col).isNotNull())
    return src.groupBy(col).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_unique(df: DataFrame, col: str, model: str = "") -> DataFrame:
    """Number of non-NULL keys that occur more than once (A7 + A8)."""
    return duplicated_keys(df, col).agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(col).alias("column_name"), F.lit("unique").alias("test"),
        "failures", _status(F.col("failures")).alias("status"),
    )


def check_accepted_values(df: DataFrame, col: str, allowed: Sequence[str],
                          model: str = "") -> DataFrame:
    agg = df.agg(F.count_if(invalid_value(col, allowed)).cast("bigint").alias("failures"))
    return agg.select(F.lit(model).alias("model"), F.lit(col).alias("column_name"),
                      F.lit("accepted_values").alias("test"), "failures",
                      _status(F.col("failures")).alias("status"))


def check_non_negative(df: DataFrame, cols: Sequence[str], model: str = "") -> DataFrame:
    agg = df.agg(F.count_if(_any_negative(cols)).cast("bigint").alias("failures"))
    return agg.select(F.lit(model).alias("model"), F.lit(",".join(cols)).alias("column_name"),
                      F.lit("non_negative").alias("test"), "failures",
                      _status(F.col("failures")).alias("status"))


def check_row_count(df: DataFrame, expected: int | None = None, model: str = "") -> DataFrame:
    """Row count > 0, or equal to ``expected`` when given."""
    agg = df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
    ok = (F.col("rows") > 0) if expected is None else (F.col("rows") == expected)
    return agg.select(F.lit(model).alias("model"), F.lit("*").alias("column_name"),
                      F.lit("row_count").alias("test"), F.col("rows").alias("failures"),
                      F.when(ok, "PASS").otherwise("FAIL").alias("status"))


TEST_RESULT_SCHEMA = "model string, column_name string, test string, failures bigint, status string"

# The declared column tests of the staging models and marts.
NOT_NULL_TESTS = {
    "stg_events": ["event_id", "group_id"],
    "stg_groups": ["group_id"],
    "stg_venues": ["venue_id"],
    "stg_categories": ["category_id"],
    "stg_topics": ["topic_id"],
    "stg_groups_topics": ["group_id", "topic_id"],
    "events_enriched": ["event_id", "group_id"],
    "agg_events_by_city": ["venue_city", "total_events"],
    "agg_groups_by_category": ["category_name", "total_groups"],
    "agg_groups_by_topic": ["topic_name", "total_groups"],
    "agg_events_by_group": ["group_id", "total_events"],
}
UNIQUE_TESTS = {
    "stg_events": "event_id",
    "stg_groups": "group_id",
    "events_enriched": "event_id",
}


def run_model_tests(models: dict[str, DataFrame], kinds: Sequence[str] = ("not_null", "unique")
                    ) -> DataFrame:
    """All declared tests over the given models, as one DataFrame.

    Columns: model, column_name, test, failures, status.
    """
    parts: list[DataFrame] = []
    if "not_null" in kinds:
        parts += [check_not_null(models[m], cols, m) for m, cols in NOT_NULL_TESTS.items()
                  if m in models]
    if "unique" in kinds:
        parts += [check_unique(models[m], col, m) for m, col in UNIQUE_TESTS.items() if m in models]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def expected_rows_per_run(audit: DataFrame,
                          event_types: Sequence[str] = DELTA_EVENT_TYPES) -> DataFrame:
    """:func:`expected_delta_rows` for every (dag_id, run_id) in the log at once."""
    hit = F.col("event_type").isin(*event_types) & (F.col("status") == "SUCCESS")
    return audit.groupBy("dag_id", "run_id").agg(
        F.coalesce(F.max(F.when(hit, F.col("row_count"))), F.lit(0)).cast("bigint")
        .alias("expected_rows"))
