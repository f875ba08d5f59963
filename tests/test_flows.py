"""End to end: landing CSV → raw tables → marts → exports → gated batches and stream."""

from __future__ import annotations

import csv
import io
import os

import pytest
from pyspark.sql import functions as F

from eventmart.config import schemas
from eventmart.config.settings import load_settings
from eventmart.operators import quality
from eventmart.operators.quality import DataQualityError
from eventmart.plans.flows import Pipeline, RunContext
from eventmart.sinks.tables import write_bucketed
from eventmart.sources import encoding


def _csv_bytes(header, rows, encoding="utf-8"):
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(header)
    for r in rows:
        w.writerow(["" if v is None else v for v in r])
    return buf.getvalue().encode(encoding)


def _event(i, group_id, venue_id, **over):
    base = {src: None for src, _ in schemas.STG_EVENTS}
    base.update({"event_id": f"e{i}", "event_name": f"Évent {i}", "event_status": "upcoming",
                 "created": 1700000000000 + i, "updated": 1700000000000 + i,
                 "yes_rsvp_count": i, "maybe_rsvp_count": 1, "waitlist_count": 0,
                 "fee.amount": "2.5", "rating.average": "4.0", "group_id": group_id,
                 "venue_id": venue_id, "venue.zip": "01234", "venue.repinned": "false"})
    base.update(over)
    return [base[src] for src, _ in schemas.STG_EVENTS]


def _landing(root):
    os.makedirs(root, exist_ok=True)
    files = {
        # events in cp1252 (accented names), NULL tokens in a numeric column
        "events.csv": _csv_bytes([s for s, _ in schemas.STG_EVENTS], [
            _event(1, 1, 100), _event(2, 1, 200, **{"venue.city": "Own"}),
            _event(3, 2, None, **{"rating.average": "NULL"}), _event(4, 9, 100),
        ], "cp1252"),
        "groups.csv": _csv_bytes([s for s, _ in schemas.STG_GROUPS], [
            [1, 10, None, None, 5, "Lima", None, "pe", 40, 4.5] + [None] * 9,
            [2, 11, "Own cat", None, 6, "Quito", None, "ec", 10, None] + [None] * 9,
        ]),
        "venues.csv": _csv_bytes([s for s, _ in schemas.STG_VENUES], [
            [100, "Hall", "Lima", "LI", "pe", "Av 1", None, None, "Peru", 3.5, 2, None],
            [200, "Club", "Quito", None, "ec", None, None, None, "Ecuador", None, None, None],
        ]),
        "categories.csv": _csv_bytes(["category_id", "category_name", "shortname"],
                                     [[10, "Tech", "tech"], [11, "Art", "art"]]),
        "topics.csv": _csv_bytes(["topic_id", "topic_name"], [[7, "Python"]]),
        "groups_topics.csv": _csv_bytes(["group_id", "topic_id", "topic_name"],
                                        [[1, 7, "py"], [2, 8, "rust"]]),
        "cities.csv": _csv_bytes(["city_id", "city"], [[5, "Lima"]]),
        "members_topics.csv": _csv_bytes(["member_id", "topic_id"], [[1, 7]]),
    }
    for name, data in files.items():
        with open(os.path.join(root, name), "wb") as fh:
            fh.write(data)


@pytest.fixture()
def pipeline(spark, tmp_path):
    p = Pipeline(spark, load_settings(), warehouse_root=str(tmp_path / "wh"), event_buckets=4,
                 files_per_bucket=2,
                 use_catalog=False)
    p.setup()
    _landing(str(tmp_path / "landing"))
    counts = p.load_raw(source_dir=str(tmp_path / "landing"),
                        normalized_dir=str(tmp_path / "normalized"))
    assert counts["events"] == 4 and counts["groups"] == 2 and len(counts) == 8
    return p


def _events(p):
    return {r["event_id"]: r for r in p.store.read("raw", "events").collect()}


def test_raw_load_types_encodings_and_audit(pipeline):
    ev = pipeline.store.read("raw", "events")
    types = dict(ev.dtypes)
    assert types["event_id"] == "string" and types["`fee.amount`".strip("`")] == "double"
    assert types["group_id"] == "bigint" and types["venue.zip"] == "string"
    assert _events(pipeline)["e1"]["event_name"] == "Évent 1"
    audit = {r["file_name"]: r for r in pipeline.store.read("monitoring", "file_audit").collect()}
    assert audit["events.csv"]["detected_encoding"] == "cp1252"
    assert audit["groups.csv"]["detected_encoding"] == "utf-8-sig"
    assert audit["events.csv"]["row_count"] == 4
    assert pipeline.store.exists("raw", "events_stage")
    # The normalised copy is UTF-8 and re-reads to the same text.
    norm = audit["events.csv"]["normalized_key"]
    labels = {r["detected_encoding"] for r in
              encoding.detect_encodings(pipeline.spark, norm).collect()}
    assert labels == {"utf-8-sig"}


def test_build_marts_and_export(pipeline, tmp_path):
    results = pipeline.build_marts()
    assert results.count() == 21
    assert {r["status"] for r in results.collect()} == {"PASS"}
    city = {r["venue_city"]: r["total_events"]
            for r in pipeline.store.read("analytics", "agg_events_by_city").collect()}
    assert city == {"Lima": 2, "Own": 1, "UNKNOWN": 1}
    assert "processed_at" in pipeline.store.read("analytics", "agg_events_by_city").columns
    out = pipeline.export("20240101000000", root=str(tmp_path / "exports"))
    assert set(out) == {"events_enriched", "agg_events_by_city", "agg_groups_by_category",
                        "agg_groups_by_topic", "agg_events_by_group"}
    parts = [f for f in os.listdir(out["agg_events_by_city"]) if f.endswith(".csv")]
    assert len(parts) == 1
    with pytest.raises(Exception, match="(?i)already exists"):
        pipeline.export("20240101000000", root=str(tmp_path / "exports"))


def test_fan_out_fails_the_unique_test(pipeline, spark):
    venues = pipeline.store.read("raw", "venues")
    dup = venues.filter(F.col("venue_id") == 100)
    # Write the widened table aside first: a table is never overwritten while read.
    pipeline.store.replace(venues.unionByName(dup), "raw", "venues_tmp")
    pipeline.store.replace(pipeline.store.read("raw", "venues_tmp"), "raw", "venues")
    # events e1 and e4 both sit at venue 100, so two keys fan out.
    with pytest.raises(DataQualityError, match=r"unique\(events_enriched.event_id\)=2"):
        pipeline.build_marts()


def _delta(spark, rows):
    return spark.createDataFrame(rows, "event_id string, yes_rsvp_count bigint, "
                                 "maybe_rsvp_count bigint, waitlist_count bigint, "
                                 "updated bigint, event_status string")


def test_run_batch_merges(pipeline, spark):
    delta = _delta(spark, [("e1", 50, None, 2, 1800000000000, "cancelled"),
                           ("delta-000000000001", 5, 0, 0, 1800000000000, "upcoming")])
    metrics = pipeline.run_batch(delta, RunContext(run_id="run_1"), expected_rows=2, build=False)
    assert metrics["row_count"] == 2
    ev = _events(pipeline)
    assert len(ev) == 5
    assert (ev["e1"]["yes_rsvp_count"], ev["e1"]["maybe_rsvp_count"],
            ev["e1"]["event_status"], ev["e1"]["event_name"]) == (50, None, "cancelled",
                                                                  "Évent 1")
    assert ev["delta-000000000001"]["group_id"] is None
    dq = pipeline.store.read("monitoring", "dq_results").filter(F.col("run_id") == "run_1")
    assert dq.count() == 6 and {r["status"] for r in dq.collect()} == {"PASS"}


def test_gate_failure_records_and_blocks_merge(pipeline, spark):
    bad = _delta(spark, [(None, 1, 1, 1, 1, "upcoming"), ("e2", -1, 1, 1, 1, "draft")])
    with pytest.raises(DataQualityError) as err:
        pipeline.run_batch(bad, RunContext(run_id="run_bad"), expected_rows=5, build=False)
    assert "null_event_id=1" in str(err.value) and "invalid_status=1" in str(err.value)
    dq = pipeline.store.read("monitoring", "dq_results").filter(F.col("run_id") == "run_bad")
    assert {r["check_name"]: r["status"] for r in dq.collect()}["negative_rsvp_values"] == "FAIL"
    assert _events(pipeline)["e2"]["yes_rsvp_count"] == 2   # untouched


def test_stream_processes_files_and_replay_is_idempotent(pipeline, spark, tmp_path):
    from eventmart.sources import csv as csv_src
    from eventmart.streaming.incremental import announce_files, start_incremental

    incoming = str(tmp_path / "incoming")
    d1 = _delta(spark, [("e1", 11, 1, 1, 1800000000001, "upcoming")])
    d2 = _delta(spark, [("e3", 33, 3, 3, 1800000000003, "cancelled"),
                        ("delta-aaaaaaaaaaaa", 1, 0, 0, 1800000000003, "upcoming")])
    csv_src.write_csv(d1.coalesce(1), f"{incoming}/f1", mode="errorifexists")
    csv_src.write_csv(d2.coalesce(1), f"{incoming}/f2", mode="errorifexists")
    announce_files(pipeline, incoming, RunContext(run_id="announce"))
    q = start_incremental(pipeline, incoming, str(tmp_path / "ckpt1"), available_now=True,
                          build=False)
    q.awaitTermination()
    assert q.exception() is None
    first = sorted(tuple(r) for r in pipeline.store.read("raw", "events").collect())
    ev = _events(pipeline)
    assert ev["e1"]["yes_rsvp_count"] == 11 and ev["e3"]["event_status"] == "cancelled"
    assert len(ev) == 5
    # Restart on the same checkpoint: nothing new, nothing re-run.
    batches = pipeline.store.read("monitoring", "dq_results").select("run_id").distinct().count()
    q1b = start_incremental(pipeline, incoming, str(tmp_path / "ckpt1"), available_now=True,
                            build=False)
    q1b.awaitTermination()
    assert q1b.exception() is None
    assert pipeline.store.read("monitoring", "dq_results").select("run_id").distinct().count() \
        == batches
    # A fresh checkpoint replays every file: the merge is idempotent.
    q2 = start_incremental(pipeline, incoming, str(tmp_path / "ckpt2"), available_now=True,
                           build=False)
    q2.awaitTermination()
    assert q2.exception() is None
    assert sorted(tuple(r) for r in pipeline.store.read("raw", "events").collect()) == first


def test_incremental_mart_refresh_equals_full_rebuild(pipeline, spark):
    pipeline.build_marts()
    m3_before = pipeline.store.read("analytics", "agg_groups_by_category").collect()
    delta = spark.createDataFrame(
        [("e1", 70, 7, 7, 1800000000000, "cancelled", 1),
         ("delta-000000000002", 9, 0, 0, 1800000000000, "upcoming", 2)],
        "event_id string, yes_rsvp_count bigint, maybe_rsvp_count bigint, "
        "waitlist_count bigint, updated bigint, event_status string, group_id bigint")
    pipeline.run_batch(delta, RunContext(run_id="run_inc"), expected_rows=2, build=True)

    def snapshot(name):
        df = pipeline.read_mart(name).drop("processed_at")
        return sorted(tuple(str(v) for v in r) for r in df.collect())

    incremental = {n: snapshot(n) for n in ("events_enriched", "agg_events_by_city",
                                            "agg_events_by_group")}
    # M3 does not read events: it was not rewritten by the batch.
    assert pipeline.store.read("analytics", "agg_groups_by_category").collect() == m3_before
    assert any(r[0] == "delta-000000000002" for r in incremental["events_enriched"])
    pipeline.build_marts()   # full rebuild from the merged raw tables
    for name, rows_ in incremental.items():
        assert snapshot(name) == rows_, name


def test_stream_quarantines_a_failing_file(pipeline, spark, tmp_path):
    from eventmart.sources import csv as csv_src
    from eventmart.streaming.incremental import announce_files, start_incremental

    incoming = str(tmp_path / "incoming_q")
    bad = _delta(spark, [(None, 1, 1, 1, 1, "upcoming")])           # NULL key: gate fails
    good = _delta(spark, [("e4", 44, 4, 4, 1800000000004, "upcoming")])
    unloadable = spark.createDataFrame([("e1", "many")], "event_id string, yes_rsvp_count string")
    csv_src.write_csv(bad.coalesce(1), f"{incoming}/a_bad", mode="errorifexists")
    csv_src.write_csv(unloadable.coalesce(1), f"{incoming}/a_unloadable", mode="errorifexists")
    csv_src.write_csv(good.coalesce(1), f"{incoming}/b_good", mode="errorifexists")
    announce_files(pipeline, incoming, RunContext(run_id="announce_q"))
    q = start_incremental(pipeline, incoming, str(tmp_path / "ckpt_q"), available_now=True,
                          build=False, on_failure="quarantine")
    q.awaitTermination()
    assert q.exception() is None
    ev = _events(pipeline)
    assert len(ev) == 4 and ev["e4"]["yes_rsvp_count"] == 44
    assert ev["e1"]["yes_rsvp_count"] == 1                            # unloadable file skipped
    dq = pipeline.store.read("monitoring", "dq_results").filter(
        F.col("check_name") == "null_event_id").collect()
    assert sorted(r["status"] for r in dq) == ["FAIL", "PASS"]


def test_incremental_refresh_replay_after_a_crash(pipeline, spark, monkeypatch):
    from eventmart.operators import marts as mart_ops

    pipeline.build_marts()
    delta = spark.createDataFrame(
        [("e1", 70, 7, 7, 1800000000000, "cancelled", 1)],
        "event_id string, yes_rsvp_count bigint, maybe_rsvp_count bigint, "
        "waitlist_count bigint, updated bigint, event_status string, group_id bigint")
    ctx = RunContext(run_id="run_crash")
    real = mart_ops.merge_state
    calls = {"n": 0}

    def crash_once(*args, **kwargs):
        calls["n"] += 1
        if calls["n"] == 1:    # dies after M1's touched buckets were rewritten
            raise RuntimeError("driver lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(mart_ops, "merge_state", crash_once)
    with pytest.raises(RuntimeError):
        pipeline.run_batch(delta, ctx, expected_rows=1, build=True)
    pipeline.run_batch(delta, ctx, expected_rows=1, build=True)   # the replay

    def snapshot(name):
        df = pipeline.read_mart(name).drop("processed_at")
        return sorted(tuple(str(v) for v in r) for r in df.collect())

    after = {n: snapshot(n) for n in ("agg_events_by_city", "agg_events_by_group")}
    pipeline.build_marts()
    assert {n: snapshot(n) for n in after} == after


def test_replayed_batch_keeps_its_exports(pipeline, spark, tmp_path):
    pipeline.build_marts()
    delta = spark.createDataFrame(
        [("e2", 20, 2, 2, 1800000000000, "upcoming", 1)],
        "event_id string, yes_rsvp_count bigint, maybe_rsvp_count bigint, "
        "waitlist_count bigint, updated bigint, event_status string, group_id bigint")
    ctx = RunContext(run_id="run_exp")
    out = str(tmp_path / "exports")
    pipeline.run_batch(delta, ctx, expected_rows=1, build=True, export_root=out)
    pipeline.run_batch(delta, ctx, expected_rows=1, build=True, export_root=out)  # replay
    assert os.path.exists(os.path.join(out, "agg_events_by_city", "run_exp", "_SUCCESS"))
    with pytest.raises(Exception, match="(?i)already exists"):
        pipeline.export("exp", root=out)          # a plain export still refuses to overwrite


def _marts(pipeline):
    def snapshot(name):
        df = pipeline.read_mart(name).drop("processed_at")
        return sorted(tuple(str(v) for v in r) for r in df.collect())

    return {n: snapshot(n) for n in ("agg_events_by_city", "agg_events_by_group")}


def _one_event(spark, event, yes):
    return spark.createDataFrame(
        [(event, yes, 7, 7, 1800000000000, "cancelled", 1)],
        "event_id string, yes_rsvp_count bigint, maybe_rsvp_count bigint, "
        "waitlist_count bigint, updated bigint, event_status string, group_id bigint")


def test_an_older_run_again_and_a_lost_run_leave_the_marts_right(pipeline, spark):
    pipeline.build_marts()
    for run, yes in (("a", 70), ("b", 2), ("a", 70)):
        pipeline.run_batch(_one_event(spark, "e1", yes), RunContext(run_id=run), expected_rows=1)
    # A run that ends after its merge, then one of another event under a new id.
    pipeline.run_batch(_one_event(spark, "e1", 54), RunContext(run_id="lost"), expected_rows=1, build=False)
    assert pipeline.unfinished_runs() == ["lost"]
    pipeline.run_batch(_one_event(spark, "e2", 9), RunContext(run_id="new"), expected_rows=1)
    assert pipeline.unfinished_runs() == []
    after = _marts(pipeline)
    pipeline.build_marts()
    assert _marts(pipeline) == after


def _all_marts(pipeline):
    return {n: sorted(tuple(str(v) for v in r) for r in pipeline.read_mart(n).collect())
            for n in ("events_enriched", "agg_events_by_city", "agg_groups_by_category",
                      "agg_groups_by_topic", "agg_events_by_group")}


def test_a_failed_test_holds_back_its_mart_and_what_depends_on_it(pipeline, spark):
    """A NULL key in M1: M1, M2 and M5 stay as they were, M3 and M4 are built."""
    pipeline.build_marts()
    before, store = _all_marts(pipeline), pipeline.store
    m3 = store.version("analytics", "agg_groups_by_category").number
    fresh = _one_event(spark, "e9", 5).select("event_id", "yes_rsvp_count",
                                              F.lit(None).cast("bigint").alias("group_id"))
    events = store.read("raw", "events").drop("key_bucket")
    write_bucketed(store, events.unionByName(fresh, allowMissingColumns=True), "raw", "events", "event_id", 4)
    with pytest.raises(DataQualityError, match=r"not_null\(stg_events.group_id\)=1 \| not published: "
                       "agg_events_by_city, agg_events_by_group, events_enriched"):
        pipeline.build_marts()
    after = _all_marts(pipeline)
    for name in ("events_enriched", "agg_events_by_city", "agg_events_by_group"):
        assert after[name] == before[name]
    assert store.version("analytics", "agg_groups_by_category").number == m3 + 1
    # Only reported: everything is published.
    results = pipeline.build_marts(fail_on_test_error=False)
    assert results.filter("status = 'FAIL'").count() == 3
    assert pipeline.read_mart("events_enriched").filter("event_id = 'e9'").count() == 1


def test_a_batch_that_fails_its_tests_is_made_up_for_later(pipeline, spark, monkeypatch):
    """M5 is held back by a batch; the next one knows that the marts do not match."""
    pipeline.build_marts()
    real = quality.NOT_NULL_TESTS
    monkeypatch.setattr(quality, "NOT_NULL_TESTS", real | {"agg_events_by_group": ["group_id", "category_id"]})
    no_group = _one_event(spark, "e3", 8).withColumn("group_id", F.lit(1).cast("bigint"))
    failing = pipeline.store.read("raw", "groups").withColumn("category_id", F.lit(None).cast("bigint")) \
        if "category_id" in pipeline.store.read("raw", "groups").columns else None
    before = _marts(pipeline)
    if failing is not None:
        pipeline.store.replace(failing, "raw", "groups")
        with pytest.raises(DataQualityError):
            pipeline.run_batch(no_group, RunContext(run_id="held"), expected_rows=1)
        assert _marts(pipeline)["agg_events_by_group"] == before["agg_events_by_group"]
        assert pipeline.unfinished_runs() == ["held"]
    monkeypatch.setattr(quality, "NOT_NULL_TESTS", real)
    pipeline.run_batch(_one_event(spark, "e1", 3), RunContext(run_id="later"), expected_rows=1)
    assert pipeline.unfinished_runs() == []
    after = _marts(pipeline)
    pipeline.build_marts()
    assert _marts(pipeline) == after


def test_old_versions_and_staging_are_removed(pipeline, spark):
    pipeline.keep_versions = 2
    pipeline.build_marts()
    for i in range(4):
        pipeline.run_batch(_one_event(spark, "e1", i), RunContext(run_id=f"v{i}"), expected_rows=1)
    assert len(pipeline.store.versions("raw", "events")) == 2
    folder = pipeline.store.path("raw", "events")
    named = {x for n in pipeline.store.versions("raw", "events")
             for x in pipeline.store.version("raw", "events", n).loads}
    assert {x for x in os.listdir(folder) if x.startswith("load=")} == named
    assert os.listdir(os.path.join(pipeline.warehouse_root, "_raw_staging")) == []


def test_marts_of_many_events_are_built_some_buckets_at_a_time(pipeline, spark, monkeypatch):
    from eventmart.operators import marts
    from eventmart.sinks import tables

    def marts_now():
        return {n: sorted(map(str, pipeline.read_mart(n).drop("processed_at").collect()))
                for n in marts.MART_NAMES}

    pipeline.build_marts()
    whole = marts_now()
    monkeypatch.setattr(tables, "SLICE_ROWS", 1)
    made = []
    m1 = marts.events_enriched
    monkeypatch.setattr(marts, "events_enriched", lambda *a, **k: made.append(1) or m1(*a, **k))
    pipeline.build_marts()
    assert len(made) > 1 and marts_now() == whole
    pipeline.run_batch(_one_event(spark, "e2", 50), RunContext(run_id="one"), expected_rows=1)
    refreshed = marts_now()
    pipeline.build_marts()
    assert refreshed == marts_now() != whole


def _m1(p):
    rows = p.read_mart("events_enriched").drop("processed_at").collect()
    return sorted(map(tuple, rows), key=str)


def test_a_batch_joins_only_its_new_events_to_the_dimensions(pipeline, spark, monkeypatch):
    from eventmart.operators import marts

    pipeline.files_per_bucket = 1
    pipeline.build_marts()
    joined = []
    m1 = marts.events_enriched
    monkeypatch.setattr(marts, "events_enriched",
                        lambda events, *a, **k: joined.append(events.count()) or m1(events, *a, **k))
    delta = _one_event(spark, "e2", 50).unionByName(_one_event(spark, "new", 7))
    pipeline.run_batch(delta, RunContext(run_id="one"), expected_rows=2)
    assert joined == [1]
    after = _m1(pipeline)
    pipeline.build_marts()
    assert _m1(pipeline) == after and len(after) == 5

    # Other dimensions: the touched buckets are recomputed, and so are those of the next batch.
    groups = pipeline.store.read("raw", "groups")
    pipeline.store.replace(groups.withColumn("city", F.concat("city", F.lit(" 2"))), "raw", "groups")
    for run in ("two", "three"):
        joined.clear()
        pipeline.run_batch(_one_event(spark, "e2", 60), RunContext(run_id=run), expected_rows=1)
        assert len(joined) == 1 and joined[0] >= 1
        mine = {r["event_id"]: r["group_city"] for r in pipeline.read_mart("events_enriched").collect()}
        assert mine["e2"] == "Lima 2"


def test_a_large_raw_load_is_written_in_slices(spark, tmp_path, monkeypatch):
    from eventmart.plans import flows
    from eventmart.sinks import tables

    _landing(str(tmp_path / "landing"))
    lines = (tmp_path / "landing" / "events.csv").read_bytes().splitlines(keepends=True)
    os.remove(tmp_path / "landing" / "events.csv")
    os.makedirs(tmp_path / "landing" / "events.csv")
    for i, line in enumerate(lines[1:]):
        (tmp_path / "landing" / "events.csv" / f"{i}.csv").write_bytes(lines[0] + line)
    monkeypatch.setattr(tables, "SLICE_ROWS", 2)
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")   # a task, and a part, for each file
    parts = []
    write = flows.write_bucketed
    monkeypatch.setattr(flows, "write_bucketed", lambda store, rows, *a: write(
        store, (parts.append(r.count()) or r for r in rows), *a))
    try:
        p = Pipeline(spark, load_settings(), warehouse_root=str(tmp_path / "wh"), event_buckets=4, use_catalog=False)
        p.setup()
        assert p.load_raw(source_dir=str(tmp_path / "landing"))["events"] == 4
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert parts == [2, 2] and set(_events(p)) == {"e1", "e2", "e3", "e4"}
    assert _events(p)["e1"]["event_name"] == "\u00c9vent 1"
