"""Fixed names and declared types.

The staging rename maps are **explicit**: raw names carry dots and the staging
prefixes are not derivable by a rule (``description`` → ``event_description``,
``city`` → ``group_city``, ``rating.average`` → ``event_rating_average``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw column → staging column, in select-list order.
STG_EVENTS = [
    ("event_id", "event_id"),
    ("event_name", "event_name"),
    ("description", "event_description"),
    ("event_url", "event_url"),
    ("event_status", "event_status"),
    ("visibility", "event_visibility"),
    ("created", "event_created"),
    ("updated", "event_updated"),
    ("event_time", "event_time"),
    ("duration", "duration"),
    ("utc_offset", "utc_offset"),
    ("headcount", "headcount"),
    ("rsvp_limit", "rsvp_limit"),
    ("yes_rsvp_count", "yes_rsvp_count"),
    ("maybe_rsvp_count", "maybe_rsvp_count"),
    ("waitlist_count", "waitlist_count"),
    ("photo_url", "photo_url"),
    ("why", "why"),
    ("how_to_find_us", "how_to_find_us"),
    ("fee.accepts", "fee_accepts"),
    ("fee.amount", "fee_amount"),
    ("fee.currency", "fee_currency"),
    ("fee.description", "fee_description"),
    ("fee.label", "fee_label"),
    ("fee.required", "fee_required"),
    ("rating.average", "event_rating_average"),
    ("rating.count", "event_rating_count"),
    ("group_id", "group_id"),
    ("group.name", "event_group_name"),
    ("group.urlname", "event_group_urlname"),
    ("group.join_mode", "event_group_join_mode"),
    ("group.who", "event_group_who"),
    ("group.created", "event_group_created"),
    ("group.group_lat", "event_group_lat"),
    ("group.group_lon", "event_group_lon"),
    ("venue_id", "venue_id"),
    ("venue.name", "venue_name"),
    ("venue.city", "venue_city"),
    ("venue.state", "venue_state"),
    ("venue.country", "venue_country"),
    ("venue.address_1", "venue_address_1"),
    ("venue.address_2", "venue_address_2"),
    ("venue.lat", "venue_lat"),
    ("venue.lon", "venue_lon"),
    ("venue.localized_country_name", "venue_localized_country_name"),
    ("venue.phone", "venue_phone"),
    ("venue.repinned", "venue_repinned"),
    ("venue.zip", "venue_zip"),
]

STG_GROUPS = [
    ("group_id", "group_id"),
    ("category_id", "category_id"),
    ("category.name", "category_name"),
    ("category.shortname", "category_shortname"),
    ("city_id", "city_id"),
    ("city", "group_city"),
    ("state", "group_state"),
    ("country", "group_country"),
    ("members", "group_members"),
    ("rating", "group_rating"),
    ("visibility", "group_visibility"),
    ("timezone", "group_timezone"),
    ("urlname", "group_urlname"),
    ("who", "group_who"),
    ("link", "group_link"),
    ("lat", "group_lat"),
    ("lon", "group_lon"),
    ("organizer.member_id", "organizer_member_id"),
    ("organizer.name", "organizer_name"),
]

STG_VENUES = [
    ("venue_id", "venue_id"),
    ("venue_name", "venue_name"),
    ("city", "city"),
    ("state", "state"),
    ("country", "country"),
    ("address_1", "address_1"),
    ("lat", "lat"),
    ("lon", "lon"),
    ("localized_country_name", "localized_country_name"),
    ("rating", "rating"),
    ("rating_count", "rating_count"),
    ("normalised_rating", "normalised_rating"),
]

STG_CATEGORIES = [
    ("category_id", "category_id"),
    ("category_name", "category_name"),
    ("shortname", "shortname"),
]

STG_TOPICS = [
    ("topic_id", "topic_id"),
    ("topic_name", "topic_name"),
]

STG_GROUPS_TOPICS = [
    ("group_id", "group_id"),
    ("topic_id", "topic_id"),
    ("topic_name", "topic_name"),
]

STAGING_MAPS = {
    "events": STG_EVENTS,
    "groups": STG_GROUPS,
    "venues": STG_VENUES,
    "categories": STG_CATEGORIES,
    "topics": STG_TOPICS,
    "groups_topics": STG_GROUPS_TOPICS,
}

# Columns the upsert overwrites on a key match (the rest of the row is kept).
EVENT_UPDATE_COLUMNS = [
    "yes_rsvp_count",
    "maybe_rsvp_count",
    "waitlist_count",
    "updated",
    "event_status",
]

# Allowed values of event_status (compared lower-cased; NULL is allowed).
EVENT_STATUS_DOMAIN = ("upcoming", "cancelled")

# Raw columns that must stay text whatever their content looks like.
STRING_OVERRIDES = {"event_id", "venue.zip", "venue.phone"}

# Monitoring tables: declared types (the auto-increment id is not kept; the
# natural keys are (run_id, task_id, check_name) and (run_id, file_name, event_type)).
DQ_RESULTS_SCHEMA = T.StructType(
    [
        T.StructField("dag_id", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("metric_value", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("checked_at", T.TimestampNTZType()),
    ]
)

FILE_AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("dag_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("source_key", T.StringType()),
        T.StructField("normalized_key", T.StringType()),
        T.StructField("s3_key", T.StringType()),
        T.StructField("detected_encoding", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)
