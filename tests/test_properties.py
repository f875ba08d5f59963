"""Brute-force properties on random small fixtures: upsert and gate metrics."""

from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventmart.operators import quality
from eventmart.operators.upsert import upsert
from tests.conftest import rows

SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e"]))
counts = st.one_of(st.none(), st.integers(min_value=-2, max_value=9))
status = st.one_of(st.none(), st.sampled_from(["upcoming", "Cancelled", "draft"]))

TARGET = "event_id string, name string, yes bigint, status string"
SOURCE = "event_id string, yes bigint, status string, extra string"


def brute_merge(target, source):
    """MERGE ON event_id: matched → (yes, status) from source; unmatched source inserted."""
    by_key = {s[0]: s for s in source if s[0] is not None}
    out = []
    matched = set()
    for t in target:
        s = by_key.get(t[0]) if t[0] is not None else None
        if s is not None:
            matched.add(t[0])
            out.append((t[0], t[1], s[1], s[2]))
        else:
            out.append(t)
    target_keys = {t[0] for t in target if t[0] is not None}
    for s in source:
        if s[0] is None or s[0] not in target_keys:
            out.append((s[0], None, s[1], s[2]))
    return out


@SETTINGS
@given(target=st.lists(st.tuples(keys, st.sampled_from(["x", "y"]), counts, status),
                       max_size=8),
       source_keys=st.lists(keys, max_size=6, unique=True),
       values=st.lists(st.tuples(counts, status), min_size=6, max_size=6),
       shuffled=st.booleans())
def test_upsert_matches_brute_force_merge(spark, target, source_keys, values, shuffled):
    # source keys are unique (the gate guarantees it); NULL at most once here
    source = [(k, v[0], v[1], "z") for k, v in zip(source_keys, values)]
    t_df = spark.createDataFrame(target, TARGET)
    s_df = spark.createDataFrame(source, SOURCE)
    kwargs = {"broadcast_rows": 0} if shuffled else {}
    got = rows(upsert(t_df, s_df, "event_id", ["yes", "status"], **kwargs))
    want = sorted(brute_merge(target, source),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
    assert got == want


@SETTINGS
@given(stage=st.lists(st.tuples(keys, counts, counts, counts, status), max_size=12))
def test_gate_metrics_match_brute_force(spark, stage):
    df = spark.createDataFrame(stage, "event_id string, yes_rsvp_count bigint, "
                               "maybe_rsvp_count bigint, waitlist_count bigint, "
                               "event_status string")
    got = quality.stage_metrics(df).first().asDict()
    per_key = Counter(r[0] for r in stage)                  # NULL keys form one key
    want = {
        "row_count": len(stage),
        "null_event_id": sum(1 for r in stage if r[0] is None),
        "duplicate_event_id": sum(1 for n in per_key.values() if n > 1),
        "negative_rsvp_values": sum(1 for r in stage if any((v or 0) < 0 for v in r[1:4])),
        "invalid_status": sum(1 for r in stage
                              if r[4] is not None and r[4].lower() not in
                              ("upcoming", "cancelled")),
    }
    assert got == want
