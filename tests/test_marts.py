"""Mart semantics on hand-made fixtures (FIXTURES.md §3)."""

from __future__ import annotations

import pytest

from eventmart.config import schemas
from eventmart.operators import marts, staging
from tests.conftest import rows


def _staged_events(spark, records):
    """Staged events with every column NULL except the given ones."""
    cols = [dst for _, dst in schemas.STG_EVENTS]
    types = {c: "string" for c in cols}
    types.update({c: "bigint" for c in ("group_id", "venue_id", "yes_rsvp_count",
                                        "maybe_rsvp_count", "waitlist_count")})
    types.update({c: "double" for c in ("fee_amount", "event_rating_average", "venue_lat",
                                        "venue_lon")})
    schema = ", ".join(f"{c} {types[c]}" for c in cols)
    data = [tuple(r.get(c) for c in cols) for r in records]
    return spark.createDataFrame(data, schema)


def _groups(spark, records):
    cols = [dst for _, dst in schemas.STG_GROUPS]
    types = {c: "string" for c in cols}
    types.update({"group_id": "bigint", "category_id": "bigint", "group_members": "bigint",
                  "group_rating": "double"})
    schema = ", ".join(f"{c} {types[c]}" for c in cols)
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in records], schema)


def _venues(spark, records):
    cols = [dst for _, dst in schemas.STG_VENUES]
    types = {c: "string" for c in cols}
    types.update({"venue_id": "bigint", "rating": "double", "lat": "double", "lon": "double"})
    schema = ", ".join(f"{c} {types[c]}" for c in cols)
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in records], schema)


@pytest.fixture()
def dims(spark):
    groups = _groups(spark, [
        {"group_id": 1, "category_id": 10, "group_rating": 4.0, "group_members": 5},
        {"group_id": 2, "category_id": 10, "group_rating": None, "group_members": None},
    ])
    venues = _venues(spark, [
        {"venue_id": 100, "venue_name": "Hall", "city": "Lima", "state": "LI", "country": "pe"},
        {"venue_id": 200, "venue_name": "Dup A", "city": "Quito"},
        {"venue_id": 200, "venue_name": "Dup B", "city": "Quito"},
    ])
    return groups, venues


def test_enriched_keeps_unmatched_events(spark, dims):
    groups, venues = dims
    events = _staged_events(spark, [
        {"event_id": "a", "group_id": 99, "venue_id": 999},
        {"event_id": "b", "group_id": 1, "venue_id": None},
    ])
    out = marts.events_enriched(events, groups, venues)
    assert len(out.columns) == 69
    got = rows(out, "event_id", "category_id", "group_rating", "venue_city", "venue_rating")
    assert got == [("a", None, None, None, None), ("b", 10, 4.0, None, None)]


def test_enriched_venue_fallback_fills_null_only(spark, dims):
    groups, venues = dims
    events = _staged_events(spark, [
        {"event_id": "a", "group_id": 1, "venue_id": 100},
        {"event_id": "b", "group_id": 1, "venue_id": 100, "venue_city": "Own"},
    ])
    got = rows(marts.events_enriched(events, groups, venues), "event_id", "venue_city",
               "venue_name", "venue_country")
    assert got == [("a", "Lima", "Hall", "pe"), ("b", "Own", "Hall", "pe")]


def test_enriched_fans_out_on_duplicate_venue(spark, dims):
    from eventmart.operators import quality

    groups, venues = dims
    events = _staged_events(spark, [{"event_id": "a", "group_id": 1, "venue_id": 200}])
    out = marts.events_enriched(events, groups, venues)
    assert out.count() == 2
    assert quality.check_unique(out, "event_id").first()["failures"] == 1


def test_city_unknown_and_avg_zero(spark, dims):
    groups, venues = dims
    events = _staged_events(spark, [
        {"event_id": "a", "group_id": 1, "venue_city": "UNKNOWN", "event_rating_average": 4.0,
         "yes_rsvp_count": 3},
        {"event_id": "b", "group_id": 2, "venue_city": None, "event_rating_average": None,
         "yes_rsvp_count": None},
    ])
    enriched = marts.events_enriched(events, groups, venues)
    got = marts.agg_events_by_city(enriched).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.venue_city, r.venue_state, r.venue_country) == ("UNKNOWN",) * 3
    assert r.total_events == 2 and r.total_yes_rsvp == 3
    assert r.avg_event_rating == 2.0      # (4 + 0) / 2, not 4
    assert r.avg_group_rating == 2.0      # group 2 has a NULL rating


def test_null_group_forms_one_group(spark, dims):
    groups, venues = dims
    events = _staged_events(spark, [
        {"event_id": "a", "group_id": None}, {"event_id": "b", "group_id": None},
        {"event_id": "c", "group_id": 1},
    ])
    out = marts.agg_events_by_group(marts.events_enriched(events, groups, venues))
    got = rows(out, "group_id", "category_name", "total_events")
    assert got == [(1, "UNKNOWN", 1), (None, "UNKNOWN", 2)]


def test_category_own_name_wins(spark):
    groups = _groups(spark, [
        {"group_id": 1, "category_id": 7, "category_name": "Own", "group_members": 3},
        {"group_id": 2, "category_id": 7, "group_members": 4, "group_rating": 1.0},
        {"group_id": 3, "category_id": None},
    ])
    cats = spark.createDataFrame([(7, "Dim", "dm")],
                                 "category_id bigint, category_name string, shortname string")
    got = rows(marts.agg_groups_by_category(groups, cats), "category_id", "category_name",
               "category_shortname", "total_groups", "total_members", "avg_group_rating")
    assert got == [(7, "Dim", "dm", 1, 4, 1.0), (7, "Own", "dm", 1, 3, 0.0),
                   (None, "UNKNOWN", "UNKNOWN", 1, 0, 0.0)]


def test_topic_dimension_name_wins_and_distinct_groups(spark):
    bridge = spark.createDataFrame(
        [(1, 5, "bridge"), (1, 5, "bridge"), (2, 5, None), (3, 6, "only bridge")],
        "group_id bigint, topic_id bigint, topic_name string")
    topics = spark.createDataFrame([(5, "Dim")], "topic_id bigint, topic_name string")
    groups = _groups(spark, [{"group_id": 1, "group_members": 10, "group_rating": 2.0},
                             {"group_id": 2, "group_members": 1}])
    got = rows(marts.agg_groups_by_topic(bridge, topics, groups), "topic_id", "topic_name",
               "total_groups", "total_group_members", "avg_group_rating")
    # group 1 twice in the bridge: counted once, its members twice.
    assert got == [(5, "Dim", 2, 21, 4.0 / 3), (6, "only bridge", 1, 0, 0.0)]


def test_staging_rename_of_dotted_columns(spark):
    raw = spark.createDataFrame([(1, 2.5, "x")], "`group_id` bigint, `fee.amount` double, "
                                "`venue.city` string")
    out = staging.rename_project(raw, [("fee.amount", "fee_amount"),
                                       ("venue.city", "venue_city"), ("group_id", "group_id")])
    assert out.columns == ["fee_amount", "venue_city", "group_id"]
    assert tuple(out.first()) == (2.5, "x", 1)


def test_processed_at_is_added_by_writer(spark, dims):
    from datetime import datetime

    groups, venues = dims
    events = _staged_events(spark, [{"event_id": "a", "group_id": 1}])
    m2 = marts.agg_events_by_city(marts.events_enriched(events, groups, venues))
    assert "processed_at" not in m2.columns
    stamped = marts.with_processed_at(m2, datetime(2024, 1, 2, 3, 4, 5))
    assert stamped.first()["processed_at"] == datetime(2024, 1, 2, 3, 4, 5)


def test_skew_split_join_matches_plain_join(spark):
    from eventmart.operators.joins import hot_keys, skew_left_join

    # key 1 holds most rows (hot), NULL keys never match, key 3 has no dimension row.
    fact = spark.createDataFrame([(i, 1 if i < 40 else (None if i < 45 else 2 + i % 2))
                                  for i in range(60)], "id bigint, k bigint")
    dim = spark.createDataFrame([(1, "one"), (2, "two"), (2, "two-dup")],
                                "dk bigint, name string")
    assert [(r["_hk"], r["_salts"]) for r in hot_keys(fact, "k", 4).collect()] == [(1, 3)]
    split = skew_left_join(fact, dim, "k", "dk", max_rows=0, partitions=4)
    plain = fact.join(dim, fact["k"] == dim["dk"], "left")
    assert rows(split, "id", "k", "dk", "name") == rows(plain, "id", "k", "dk", "name")
    assert split.count() == 60 + 7   # the 7 rows of key 2 fan out over two dimension rows
