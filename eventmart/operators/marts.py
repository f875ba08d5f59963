"""The five marts M1–M5.

Marts take staged DataFrames and return DataFrames without the load stamp;
``processed_at`` is added by the writer (:func:`with_processed_at`) so the
queries themselves stay deterministic.

Plan notes (scale):
* every join is a single-key left equi-join; dimension sides are broadcast only
  behind a measured bound (:func:`eventmart.operators.joins.sized_broadcast`),
  otherwise :func:`~eventmart.operators.joins.skew_left_join` salts hot keys
  (and NULL keys) so no sort-merge partition holds more than a fair share;
* every aggregate is hash-partial → exchange on the grouping keys → final, so a
  hot key contributes one row per map task to the shuffle;
* ``count(distinct group_id)`` next to sum/avg is planned by Catalyst as a
  two-level aggregate (keys+group_id, then keys) without an Expand.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import (
    SUM_TYPE,
    avg_zero_filled,
    count_rows,
    first_present,
    sum_zero_filled,
    unknown_if_null,
    zero_if_null,
)
from eventmart.operators.joins import DEFAULT_BROADCAST_ROWS, skew_left_join

# Column lists of events_enriched, in output order.
ENRICHED_EVENT_COLUMNS = [
    "event_id", "event_name", "event_description", "event_url", "event_status",
    "event_visibility", "event_created", "event_updated", "event_time", "duration",
    "utc_offset", "headcount", "rsvp_limit", "yes_rsvp_count", "maybe_rsvp_count",
    "waitlist_count", "photo_url", "why", "how_to_find_us",
    "fee_accepts", "fee_amount", "fee_currency", "fee_description", "fee_label",
    "fee_required",
    "event_rating_average", "event_rating_count",
    "group_id", "event_group_name", "event_group_urlname", "event_group_join_mode",
    "event_group_who", "event_group_created", "event_group_lat", "event_group_lon",
]
ENRICHED_GROUP_COLUMNS = [
    "category_id", "category_name", "category_shortname", "city_id", "group_city",
    "group_state", "group_country", "group_members", "group_rating", "group_visibility",
    "group_timezone", "group_urlname", "group_who", "group_link", "group_lat", "group_lon",
    "organizer_member_id", "organizer_name",
]
# (output name, event column, venue column): the event's own value wins.
ENRICHED_VENUE_FALLBACKS = [
    ("venue_name", "venue_name", "venue_name"),
    ("venue_city", "venue_city", "city"),
    ("venue_state", "venue_state", "state"),
    ("venue_country", "venue_country", "country"),
    ("venue_address_1", "venue_address_1", "address_1"),
]
ENRICHED_VENUE_FALLBACKS_2 = [
    ("venue_lat", "venue_lat", "lat"),
    ("venue_lon", "venue_lon", "lon"),
    ("venue_localized_country_name", "venue_localized_country_name",
     "localized_country_name"),
]
ENRICHED_VENUE_ONLY = [
    ("venue_rating", "rating"),
    ("venue_rating_count", "rating_count"),
    ("venue_normalised_rating", "normalised_rating"),
]


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in df.columns])


def events_enriched(
    events: DataFrame,
    groups: DataFrame,
    venues: DataFrame,
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
    columns: list[str] | None = None,
) -> DataFrame:
    """M1: one row per event (per matching group × venue row), 69 columns.

    With ``columns`` only these: the dimensions are cut to what they need before their
    size is measured, so a mart over a few columns reads and broadcasts no others.
    """
    from_group = {c: c for c in ENRICHED_GROUP_COLUMNS}
    from_venue = {out: v for out, _, v in ENRICHED_VENUE_FALLBACKS + ENRICHED_VENUE_FALLBACKS_2}
    from_venue |= dict(ENRICHED_VENUE_ONLY)

    def pruned(dim: DataFrame, key: str, prefix: str, sources: dict[str, str]) -> DataFrame:
        if columns is not None:
            dim = dim.select(*dict.fromkeys([key, *(src for out, src in sources.items() if out in columns)]))
        return _prefixed(dim, prefix)

    g = pruned(groups, "group_id", "g__", from_group)
    v = pruned(venues, "venue_id", "v__", from_venue)
    joined = skew_left_join(events, g, "group_id", "g__group_id", broadcast_rows,
                            salt_by="event_id")
    joined = skew_left_join(joined, v, "venue_id", "v__venue_id", broadcast_rows,
                            key_source=events, salt_by="event_id")
    made = {c: c for c in ENRICHED_EVENT_COLUMNS}
    made |= {c: f"g__{c}" for c in ENRICHED_GROUP_COLUMNS}
    made["venue_id"] = "venue_id"
    made |= {out: (own, f"v__{v}") for out, own, v in ENRICHED_VENUE_FALLBACKS}
    made["venue_address_2"] = "venue_address_2"
    made |= {out: (own, f"v__{v}") for out, own, v in ENRICHED_VENUE_FALLBACKS_2}
    made |= {c: c for c in ("venue_phone", "venue_repinned", "venue_zip")}
    made |= {out: f"v__{src}" for out, src in ENRICHED_VENUE_ONLY}
    cols = [(F.col(of) if isinstance(of, str) else first_present(*map(F.col, of))).alias(out)
            for out, of in made.items() if columns is None or out in columns]
    return joined.select(*cols)


# Averaged measures are summed as fixed-point numbers: a stored state can then be
# corrected by subtracting old and adding new contributions without drift, and a
# full rebuild gives bit-identical averages (the warehouse also averages in
# fixed point, ``SUM_TYPE``).

CITY_KEYS = ["venue_city", "venue_state", "venue_country"]
CITY_COUNTERS = [("total_yes_rsvp", "yes_rsvp_count"), ("total_maybe_rsvp", "maybe_rsvp_count"),
                 ("total_waitlist", "waitlist_count")]
CITY_AVERAGES = [("avg_event_rating", "event_rating_average"),
                 ("avg_group_rating", "group_rating"), ("avg_fee_amount", "fee_amount")]

GROUP_KEYS = ["group_id", "group_name", "category_id", "category_name"]
GROUP_COUNTERS = [("total_yes_rsvp", "yes_rsvp_count")]
GROUP_AVERAGES = [("avg_event_rating", "event_rating_average"),
                  ("avg_group_rating", "group_rating")]

# What M2 and M5 read of M1.
CITY_INPUTS = CITY_KEYS + [src for _, src in CITY_COUNTERS + CITY_AVERAGES]
GROUP_INPUTS = ["group_id", "event_group_name", "category_id", "category_name"] + [
    src for _, src in GROUP_COUNTERS + GROUP_AVERAGES]


def _state(grouped, counters, averages) -> DataFrame:
    return grouped.agg(
        count_rows().alias("total_events"),
        *[sum_zero_filled(src).alias(out) for out, src in counters],
        *[F.sum(zero_if_null(src).cast(SUM_TYPE)).alias(f"sum_{out}") for out, src in averages],
    )


def _from_state(state: DataFrame, keys, counters, averages) -> DataFrame:
    return state.select(
        *keys, "total_events", *[out for out, _ in counters],
        *[(F.col(f"sum_{out}").cast("double") / F.col("total_events")).alias(out)
          for out, _ in averages],
    )


def events_by_city_state(enriched: DataFrame) -> DataFrame:
    """Additive state of M2: row count and exact sums per (city, state, country)."""
    return _state(enriched.groupBy(*[unknown_if_null(k).alias(k) for k in CITY_KEYS]),
                  CITY_COUNTERS, CITY_AVERAGES)


def city_from_state(state: DataFrame) -> DataFrame:
    return _from_state(state, CITY_KEYS, CITY_COUNTERS, CITY_AVERAGES)


def agg_events_by_city(enriched: DataFrame) -> DataFrame:
    """M2: per (city, state, country) with NULL → 'UNKNOWN' before grouping."""
    return city_from_state(events_by_city_state(enriched))


def merge_state(state: DataFrame, minus: DataFrame, plus: DataFrame, keys: list[str]
                ) -> DataFrame:
    """``state − minus + plus`` per key (NULL keys group together); empty keys vanish."""
    measures = [c for c in state.columns if c not in keys]
    negated = minus.select(*keys, *[(-F.col(c)).alias(c) for c in measures])
    both = state.unionByName(negated).unionByName(plus.select(*keys, *measures))
    merged = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures])
    return merged.filter(F.col("total_events") > 0)


def agg_groups_by_category(
    groups: DataFrame,
    categories: DataFrame,
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """M3: groups ⟕ categories; the group's own category name wins over the dimension."""
    c = _prefixed(categories, "c__")
    joined = skew_left_join(groups, c, "category_id", "c__category_id", broadcast_rows,
                            salt_by="group_id")
    return joined.groupBy(
        F.col("category_id"),
        first_present(F.col("category_name"), F.col("c__category_name"),
                      default="UNKNOWN").alias("category_name"),
        first_present(F.col("category_shortname"), F.col("c__shortname"),
                      default="UNKNOWN").alias("category_shortname"),
    ).agg(
        F.countDistinct(F.col("group_id")).alias("total_groups"),
        sum_zero_filled(F.col("group_members")).alias("total_members"),
        avg_zero_filled(F.col("group_rating")).alias("avg_group_rating"),
    )


def agg_groups_by_topic(
    groups_topics: DataFrame,
    topics: DataFrame,
    groups: DataFrame,
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """M4: bridge ⟕ topics ⟕ groups; the *dimension's* topic name wins over the bridge's.

    ``sum(members)`` counts a group once per bridge row, ``count(distinct)`` once per topic.
    """
    t = _prefixed(topics, "t__")
    g = _prefixed(groups.select("group_id", "group_members", "group_rating"), "g__")
    joined = skew_left_join(groups_topics, t, "topic_id", "t__topic_id", broadcast_rows,
                            salt_by="group_id")
    joined = skew_left_join(joined, g, "group_id", "g__group_id", broadcast_rows,
                            key_source=groups_topics, salt_by="topic_id")
    return joined.groupBy(
        F.col("topic_id"),
        first_present(F.col("t__topic_name"), F.col("topic_name"),
                      default="UNKNOWN").alias("topic_name"),
    ).agg(
        F.countDistinct(F.col("group_id")).alias("total_groups"),
        sum_zero_filled(F.col("g__group_members")).alias("total_group_members"),
        avg_zero_filled(F.col("g__group_rating")).alias("avg_group_rating"),
    )


def events_by_group_state(enriched: DataFrame) -> DataFrame:
    """Additive state of M5 per (group_id, group name, category_id, category name)."""
    return _state(enriched.groupBy(
        F.col("group_id"),
        F.col("event_group_name").alias("group_name"),
        F.col("category_id"),
        unknown_if_null("category_name").alias("category_name"),
    ), GROUP_COUNTERS, GROUP_AVERAGES)


def group_from_state(state: DataFrame) -> DataFrame:
    return _from_state(state, GROUP_KEYS, GROUP_COUNTERS, GROUP_AVERAGES)


def agg_events_by_group(enriched: DataFrame) -> DataFrame:
    """M5: per (group_id, group name, category_id, category name); only the name is defaulted."""
    return group_from_state(events_by_group_state(enriched))


def with_processed_at(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Load stamp added at write time (one value per statement, like the warehouse)."""
    stamp = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    return df.withColumn("processed_at", stamp)


MART_NAMES = [
    "events_enriched",
    "agg_events_by_city",
    "agg_groups_by_category",
    "agg_groups_by_topic",
    "agg_events_by_group",
]

# What each mart is built from: a failed test of an input holds the mart back.
MART_INPUTS = {
    "events_enriched": ["stg_events", "stg_groups", "stg_venues"],
    "agg_events_by_city": ["events_enriched"],
    "agg_groups_by_category": ["stg_groups", "stg_categories"],
    "agg_groups_by_topic": ["stg_groups_topics", "stg_topics", "stg_groups"],
    "agg_events_by_group": ["events_enriched"],
}


def build_all(staged: dict[str, DataFrame], enriched: DataFrame | None = None,
              broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> dict[str, DataFrame]:
    """All five marts from staged inputs.

    ``enriched`` may be passed as the materialised M1 table (read back from
    parquet) so M2 and M5 prune to their 9 columns instead of recomputing joins.
    """
    m1 = events_enriched(staged["events"], staged["groups"], staged["venues"], broadcast_rows)
    base = enriched if enriched is not None else m1
    return {
        "events_enriched": m1,
        "agg_events_by_city": agg_events_by_city(base),
        "agg_groups_by_category": agg_groups_by_category(
            staged["groups"], staged["categories"], broadcast_rows),
        "agg_groups_by_topic": agg_groups_by_topic(
            staged["groups_topics"], staged["topics"], staged["groups"], broadcast_rows),
        "agg_events_by_group": agg_events_by_group(base),
    }
