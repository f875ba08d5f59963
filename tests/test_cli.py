"""The command-line entry drives the flows end to end."""

from __future__ import annotations

import json

from eventmart import cli
from eventmart.sinks.tables import TableStore
from tests.test_flows import _landing


def _run(capsys, *argv):
    assert cli.main(list(argv)) == 0
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_cli_flows(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setenv("EVENTMART_ROOT", str(tmp_path / "bucket"))
    wh = str(tmp_path / "wh")
    landing = str(tmp_path / "landing")
    _landing(landing)
    common = ["--warehouse", wh, "--buckets", "4"]
    _run(capsys, "setup", *common)
    loaded = _run(capsys, "load-raw", *common, "--source", landing)["result"]
    assert loaded["events"] == 4
    tests = _run(capsys, "build-marts", *common)["result"]
    assert len(tests) == 21 and {t["status"] for t in tests} == {"PASS"}
    # the flows register their tables in the catalog: SQL users query them by name
    city = spark.sql("SELECT venue_city, total_events FROM analytics.agg_events_by_city "
                     "ORDER BY venue_city").collect()
    assert [(r[0], r[1]) for r in city] == [("Lima", 2), ("Own", 1), ("UNKNOWN", 1)]
    assert spark.sql("SELECT count(*) FROM raw.events").first()[0] == 4
    delta = tmp_path / "delta.csv"
    delta.write_text("event_id,yes_rsvp_count,maybe_rsvp_count,waitlist_count,updated,"
                     "event_status,group_id\ne1,9,1,0,1800000000000,cancelled,1\n")
    metrics = _run(capsys, "batch", *common, "--delta", str(delta), "--run-id", "cli_1",
                   "--expected-rows", "1")["result"]
    assert metrics["row_count"] == 1
    exported = _run(capsys, "export", *common, "--exports", str(tmp_path / "exp"),
                    "--run-stamp", "20240101000000")["result"]
    assert set(exported) >= {"events_enriched", "agg_events_by_city"}
    split = _run(capsys, "split-buckets", *common)["result"]
    assert split == {"raw.events": 8, "analytics.events_enriched": 8, "analytics.agg_events_by_group": 8,
                     "analytics.agg_events_by_group__state": 8}
    again = _run(capsys, "batch", "--warehouse", wh, "--buckets", "8", "--delta", str(delta),
                 "--run-id", "cli_1", "--expected-rows", "1")["result"]
    assert again["row_count"] == 1
    assert isinstance(_run(capsys, "vacuum", *common)["result"], dict)
    assert _run(capsys, "compact", *common, "--table", "monitoring.dq_results")["result"] \
        == "monitoring.dq_results"
    assert spark.sql("SELECT count(*) FROM monitoring.dq_results").first()[0] == 6


def test_announced_counts_and_line_breaks(spark, tmp_path, capsys, monkeypatch):
    """A stream of a delta with a quoted line break passes with the right announced count,
    and fails with a wrong one; a later announcement replaces an earlier one."""
    import pytest
    from pyspark.errors import StreamingQueryException

    monkeypatch.setenv("EVENTMART_ROOT", str(tmp_path / "bucket"))
    wh, landing, deltas = str(tmp_path / "wh"), str(tmp_path / "landing"), tmp_path / "del ta"
    _landing(landing)
    common = ["--warehouse", wh, "--buckets", "4"]
    _run(capsys, "setup", *common)
    _run(capsys, "load-raw", *common, "--source", landing)
    deltas.mkdir()
    (deltas / "d 1.csv").write_text('event_id,event_name,event_status\ne99,"two\nlines",upcoming\ne2,x,cancelled\n')
    from eventmart.streaming.incremental import delta_file_stream  # noqa: F401 - the path form is the stream's
    seen = spark.read.format("binaryFile").load(str(deltas)).select("path").first()[0]

    def announce(n):
        manifest = tmp_path / f"manifest{n}.csv"
        manifest.write_text(f'file,row_count\n"{seen}",{n}\n')
        _run(capsys, "announce", *common, "--manifest", str(manifest))

    stream = ["stream", *common, "--delta-dir", str(deltas), "--checkpoint", str(tmp_path / "ckpt"), "--available-now", "--no-build", "--multi-line"]
    announce(5)
    with pytest.raises(StreamingQueryException):
        cli.main(stream)
    announce(2)
    _run(capsys, *stream)
    rows = TableStore(spark, wh, use_catalog=False).read("raw", "events").filter("event_name like 'two%'").collect()
    assert [r["event_id"] for r in rows] == ["e99"]
    audit = TableStore(spark, wh, use_catalog=False).read("monitoring", "file_audit").filter("task_id = 'announce'")
    assert sorted(r["event_type"] for r in audit.collect()) == ["DELTA_GENERATED"] * 2 + ["DELTA_UPLOADED"] * 2
