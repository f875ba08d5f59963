"""Stage gate Q1–Q8, declarative tests T1/T2 and the audit lookup (FIXTURES.md §3 dq_*)."""

from __future__ import annotations

from datetime import datetime

import pytest

from eventmart.config.schemas import FILE_AUDIT_SCHEMA
from eventmart.operators import quality

STAGE = ("event_id string, yes_rsvp_count bigint, maybe_rsvp_count bigint, "
         "waitlist_count bigint, event_status string")


def _results(spark, data, expected):
    stage = spark.createDataFrame(data, STAGE)
    out = quality.stage_check_results(quality.stage_metrics(stage), expected)
    return {r["check_name"]: r.asDict() for r in out.collect()}


def test_all_checks_fail_together(spark):
    data = [(None, 1, 1, 1, "upcoming"), (None, 1, 1, 1, "upcoming"),
            ("a", 1, 1, 1, "upcoming"), ("a", 1, 1, 1, "upcoming"),
            ("b", -1, None, 0, "upcoming"), ("c", 0, 0, 0, "draft")]
    res = _results(spark, data, 5)
    assert {k: v["metric_value"] for k, v in res.items()} == {
        "row_count": 6, "null_event_id": 2, "duplicate_event_id": 2,  # the NULL pair is one key
        "negative_rsvp_values": 1, "invalid_status": 1, "stage_matches_delta_row_count": 6}
    assert {k: v["status"] for k, v in res.items()} == {
        "row_count": "PASS", "null_event_id": "FAIL", "duplicate_event_id": "FAIL",
        "negative_rsvp_values": "FAIL", "invalid_status": "FAIL",
        "stage_matches_delta_row_count": "FAIL"}
    assert res["row_count"]["error_message"] is None
    assert "stage 6, delta 5" in res["stage_matches_delta_row_count"]["error_message"]
    summary = quality.failure_summary(res.values())
    assert summary.count(" | ") == 4
    assert summary.startswith("null_event_id=2 -> ")


def test_status_case_and_null_pass(spark):
    data = [("a", 1, 1, 1, "Cancelled"), ("b", 1, 1, 1, "UPCOMING"), ("c", 1, 1, 1, None)]
    res = _results(spark, data, 3)
    assert all(v["status"] == "PASS" for v in res.values())
    assert quality.failure_summary(res.values()) is None


def test_empty_stage(spark):
    res = _results(spark, [], 0)
    assert res["row_count"]["status"] == "FAIL"
    assert res["stage_matches_delta_row_count"]["status"] == "PASS"
    res = _results(spark, [], 8)
    assert res["stage_matches_delta_row_count"]["status"] == "FAIL"


def _audit(spark, rows):
    now = datetime(2024, 1, 1)
    full = [("dag", run, "t", "f.csv", None, None, None, None, None, n, status, et, now)
            for run, n, status, et in rows]
    return spark.createDataFrame(full, FILE_AUDIT_SCHEMA)


def test_expected_rows_from_audit(spark):
    audit = _audit(spark, [("r1", 5, "SUCCESS", "DELTA_GENERATED"),
                           ("r1", 8, "SUCCESS", "DELTA_UPLOADED"),
                           ("r2", 99, "SUCCESS", "DELTA_UPLOADED"),
                           ("r1", 50, "FAILED", "DELTA_UPLOADED"),
                           ("r1", 70, "SUCCESS", "FILE_NORMALIZED")])
    assert quality.expected_delta_rows(audit, "dag", "r1").first()[0] == 8
    assert quality.expected_delta_rows(audit, "dag", "nope").first()[0] == 0
    per_run = {r["run_id"]: r["expected_rows"]
               for r in quality.expected_rows_per_run(audit).collect()}
    assert per_run == {"r1": 8, "r2": 99}


def test_expected_rows_as_scalar_subquery(spark):
    audit = _audit(spark, [("r1", 2, "SUCCESS", "DELTA_GENERATED")])
    stage = spark.createDataFrame([("a", 1, 1, 1, None), ("b", 1, 1, 1, None)], STAGE)
    exp = quality.expected_delta_rows(audit, "dag", "r1").scalar()
    res = quality.stage_check_results(quality.stage_metrics(stage), exp)
    assert {r["status"] for r in res.collect()} == {"PASS"}


def test_not_null_and_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, "c")],
                               "k bigint, v string")
    nn = {r["column_name"]: r["failures"] for r in
          quality.check_not_null(df, ["k", "v"], "m").collect()}
    assert nn == {"k": 2, "v": 1}
    uq = quality.check_unique(df, "k", "m").first()
    assert (uq["failures"], uq["status"]) == (1, "FAIL")   # NULLs ignored, unlike the gate
    assert quality.duplicated_keys(df, "k", include_null=True).count() == 2


def test_single_checks(spark):
    df = spark.createDataFrame([("upcoming", 1), ("Draft", -1), (None, None)],
                               "s string, n bigint")
    assert quality.check_accepted_values(df, "s", ("upcoming",)).first()["failures"] == 1
    assert quality.check_non_negative(df, ["n"]).first()["failures"] == 1
    assert quality.check_row_count(df, 3).first()["status"] == "PASS"
    assert quality.check_row_count(df.limit(0)).first()["status"] == "FAIL"


@pytest.mark.parametrize("kinds, n", [(["not_null"], 2), (["unique"], 1)])
def test_model_tests_cover_declared_columns(spark, kinds, n):
    stg = spark.createDataFrame([("a", 1)], "event_id string, group_id bigint")
    res = quality.run_model_tests({"stg_events": stg}, kinds)
    assert res.count() == n
    assert {r["status"] for r in res.collect()} == {"PASS"}
