"""Independent DuckDB SQL for every registered query (the correctness oracle).

The benchmark tables are pre-registered as views.  The stand-in CTEs restate,
in plain SQL, the mapping of ``eventmart.plans.standins``; the mart, check and
upsert SQL restate the reference semantics directly, so the Spark code and the
oracle agree only if both compute the same thing.
"""

from __future__ import annotations

from eventmart.config import schemas


def _stg(name: str, mapping: list[tuple[str, str]], source: str) -> str:
    cols = ",\n    ".join(f'"{src}" AS {dst}' for src, dst in mapping)
    return f"{name} AS (\n  SELECT\n    {cols}\n  FROM {source}\n)"


RAW_EVENTS = """raw_events AS (
  SELECT
    'e' || l_orderkey || '-' || l_linenumber AS event_id,
    'Event ' || l_partkey AS event_name,
    CASE WHEN l_returnflag = 'R' THEN NULL
         ELSE 'part ' || l_partkey || ' by supplier ' || l_suppkey END AS description,
    'https://events.example/' || l_orderkey || '/' || l_linenumber AS event_url,
    CASE WHEN l_linestatus = 'O' THEN 'upcoming' ELSE 'past' END AS event_status,
    'public' AS visibility,
    epoch_ms(l_shipdate) - 2592000000 AS created,
    epoch_ms(l_shipdate) - CAST(l_linenumber AS BIGINT) * 86400000 AS updated,
    epoch_ms(l_shipdate) AS event_time,
    CAST(l_linenumber AS BIGINT) * 1800000 AS duration,
    CAST(0 AS BIGINT) AS utc_offset,
    CAST(0 AS BIGINT) AS headcount,
    CASE WHEN l_quantity > 40 THEN NULL ELSE CAST(50 AS BIGINT) END AS rsvp_limit,
    CAST(l_quantity AS BIGINT) AS yes_rsvp_count,
    CAST(l_linenumber AS BIGINT) AS maybe_rsvp_count,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_linenumber - 1 AS BIGINT) END
      AS waitlist_count,
    CAST(NULL AS VARCHAR) AS photo_url,
    CAST(NULL AS VARCHAR) AS why,
    CAST(NULL AS VARCHAR) AS how_to_find_us,
    'cash' AS "fee.accepts",
    CASE WHEN l_discount = 0 THEN NULL
         ELSE CAST(floor(l_extendedprice * 4) AS DOUBLE) / 4 END AS "fee.amount",
    'USD' AS "fee.currency",
    CAST(NULL AS VARCHAR) AS "fee.description",
    'price' AS "fee.label",
    l_discount > CAST(0.05 AS DOUBLE) AS "fee.required",
    CASE WHEN l_returnflag = 'A' THEN NULL
         ELSE CAST(l_linenumber AS DOUBLE) * CAST(0.5 AS DOUBLE) + CAST(1.0 AS DOUBLE) END
      AS "rating.average",
    CAST(l_linenumber AS BIGINT) AS "rating.count",
    l_orderkey AS group_id,
    'Group ' || l_orderkey AS "group.name",
    'group-' || l_orderkey AS "group.urlname",
    'open' AS "group.join_mode",
    'Members' AS "group.who",
    CAST(NULL AS BIGINT) AS "group.created",
    CAST(NULL AS DOUBLE) AS "group.group_lat",
    CAST(NULL AS DOUBLE) AS "group.group_lon",
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL ELSE l_suppkey END AS venue_id,
    CASE WHEN l_linenumber <= 2 THEN 'Venue ' || l_suppkey END AS "venue.name",
    CASE WHEN l_returnflag = 'A' AND l_linenumber >= 6 THEN 'UNKNOWN'
         WHEN l_linenumber = 5 THEN 'Own City ' || l_linestatus END AS "venue.city",
    CAST(NULL AS VARCHAR) AS "venue.state",
    CAST(NULL AS VARCHAR) AS "venue.country",
    CAST(NULL AS VARCHAR) AS "venue.address_1",
    CAST(NULL AS VARCHAR) AS "venue.address_2",
    CAST(NULL AS DOUBLE) AS "venue.lat",
    CAST(NULL AS DOUBLE) AS "venue.lon",
    CAST(NULL AS VARCHAR) AS "venue.localized_country_name",
    CAST(NULL AS VARCHAR) AS "venue.phone",
    false AS "venue.repinned",
    CAST(NULL AS VARCHAR) AS "venue.zip"
  FROM lineitem
)"""

RAW_GROUPS = """raw_groups AS (
  SELECT
    CASE WHEN o_orderstatus = 'P' THEN -o_orderkey ELSE o_orderkey END AS group_id,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL
         ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) * 6
              + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END END AS category_id,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'own urgent' END
      AS "category.name",
    CAST(NULL AS VARCHAR) AS "category.shortname",
    o_custkey AS city_id,
    o_orderpriority AS city,
    CAST(NULL AS VARCHAR) AS state,
    'XX' AS country,
    o_custkey AS members,
    CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN NULL
         ELSE CAST(floor(o_totalprice / 100000 * 4) AS DOUBLE) / 4 END AS rating,
    'public' AS visibility,
    'UTC' AS timezone,
    'group-' || o_orderkey AS urlname,
    'Members' AS who,
    'https://events.example/g/' || o_orderkey AS link,
    CAST(NULL AS DOUBLE) AS lat,
    CAST(NULL AS DOUBLE) AS lon,
    o_custkey AS "organizer.member_id",
    'Customer#' || o_custkey AS "organizer.name"
  FROM orders
)"""

RAW_VENUES = """raw_venues AS (
  SELECT
    CASE WHEN s_nationkey >= 20 THEN -s_suppkey ELSE s_suppkey END AS venue_id,
    s_name AS venue_name,
    'City ' || s_nationkey AS city,
    CASE WHEN s_acctbal < 0 THEN NULL ELSE 'ST' END AS state,
    'XX' AS country,
    s_suppkey || ' Main St' AS address_1,
    CAST(NULL AS DOUBLE) AS lat,
    CAST(NULL AS DOUBLE) AS lon,
    'Nowhere' AS localized_country_name,
    CAST(floor(s_acctbal / 2000 * 4) AS DOUBLE) / 4 AS rating,
    CAST(s_nationkey AS BIGINT) AS rating_count,
    CAST(NULL AS DOUBLE) AS normalised_rating
  FROM supplier
)"""

RAW_CATEGORIES = """raw_categories AS (
  SELECT CAST(n_nationkey AS BIGINT) AS category_id, n_name AS category_name,
         lower(substr(n_name, 1, 3)) AS shortname
  FROM nation
)"""

RAW_TOPICS = """raw_topics AS (
  SELECT CASE WHEN p_size > 40 THEN -p_partkey ELSE p_partkey END AS topic_id,
         p_name AS topic_name FROM part
)"""

RAW_GROUPS_TOPICS = """raw_groups_topics AS (
  SELECT l_orderkey AS group_id, l_partkey AS topic_id,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE 'topic ' || l_partkey END AS topic_name
  FROM lineitem
)"""

STAGING = ",\n".join([
    RAW_EVENTS, RAW_GROUPS, RAW_VENUES, RAW_CATEGORIES, RAW_TOPICS, RAW_GROUPS_TOPICS,
    _stg("stg_events", schemas.STG_EVENTS, "raw_events"),
    _stg("stg_groups", schemas.STG_GROUPS, "raw_groups"),
    _stg("stg_venues", schemas.STG_VENUES, "raw_venues"),
    _stg("stg_categories", schemas.STG_CATEGORIES, "raw_categories"),
    _stg("stg_topics", schemas.STG_TOPICS, "raw_topics"),
    _stg("stg_groups_topics", schemas.STG_GROUPS_TOPICS, "raw_groups_topics"),
])

# The marts' columns, fallbacks and formulas, restated for the oracle.
EVENTS_ENRICHED_BODY = """SELECT
    e.event_id, e.event_name, e.event_description, e.event_url, e.event_status,
    e.event_visibility, e.event_created, e.event_updated, e.event_time, e.duration,
    e.utc_offset, e.headcount, e.rsvp_limit, e.yes_rsvp_count, e.maybe_rsvp_count,
    e.waitlist_count, e.photo_url, e.why, e.how_to_find_us,
    e.fee_accepts, e.fee_amount, e.fee_currency, e.fee_description, e.fee_label,
    e.fee_required,
    e.event_rating_average, e.event_rating_count,
    e.group_id, e.event_group_name, e.event_group_urlname, e.event_group_join_mode,
    e.event_group_who, e.event_group_created, e.event_group_lat, e.event_group_lon,
    g.category_id, g.category_name, g.category_shortname, g.city_id, g.group_city,
    g.group_state, g.group_country, g.group_members, g.group_rating, g.group_visibility,
    g.group_timezone, g.group_urlname, g.group_who, g.group_link, g.group_lat, g.group_lon,
    g.organizer_member_id, g.organizer_name,
    e.venue_id,
    coalesce(e.venue_name, v.venue_name) AS venue_name,
    coalesce(e.venue_city, v.city) AS venue_city,
    coalesce(e.venue_state, v.state) AS venue_state,
    coalesce(e.venue_country, v.country) AS venue_country,
    coalesce(e.venue_address_1, v.address_1) AS venue_address_1,
    e.venue_address_2,
    coalesce(e.venue_lat, v.lat) AS venue_lat,
    coalesce(e.venue_lon, v.lon) AS venue_lon,
    coalesce(e.venue_localized_country_name, v.localized_country_name)
      AS venue_localized_country_name,
    e.venue_phone, e.venue_repinned, e.venue_zip,
    v.rating AS venue_rating,
    v.rating_count AS venue_rating_count,
    v.normalised_rating AS venue_normalised_rating
  FROM stg_events e
  LEFT JOIN stg_groups g ON e.group_id = g.group_id
  LEFT JOIN stg_venues v ON e.venue_id = v.venue_id"""

WITH_ENRICHED = f"WITH {STAGING},\nevents_enriched AS (\n  {EVENTS_ENRICHED_BODY}\n)\n"

SQL_EVENTS_ENRICHED = f"WITH {STAGING}\n{EVENTS_ENRICHED_BODY}"

SQL_AGG_EVENTS_BY_CITY = WITH_ENRICHED + """SELECT
  coalesce(venue_city, 'UNKNOWN') AS venue_city,
  coalesce(venue_state, 'UNKNOWN') AS venue_state,
  coalesce(venue_country, 'UNKNOWN') AS venue_country,
  count(*) AS total_events,
  CAST(sum(coalesce(yes_rsvp_count, 0)) AS BIGINT) AS total_yes_rsvp,
  CAST(sum(coalesce(maybe_rsvp_count, 0)) AS BIGINT) AS total_maybe_rsvp,
  CAST(sum(coalesce(waitlist_count, 0)) AS BIGINT) AS total_waitlist,
  avg(coalesce(event_rating_average, 0)) AS avg_event_rating,
  avg(coalesce(group_rating, 0)) AS avg_group_rating,
  avg(coalesce(fee_amount, 0)) AS avg_fee_amount
FROM events_enriched
GROUP BY 1, 2, 3"""

SQL_AGG_GROUPS_BY_CATEGORY = f"WITH {STAGING}\n" + """SELECT
  g.category_id,
  coalesce(g.category_name, c.category_name, 'UNKNOWN') AS category_name,
  coalesce(g.category_shortname, c.shortname, 'UNKNOWN') AS category_shortname,
  count(DISTINCT g.group_id) AS total_groups,
  CAST(sum(coalesce(g.group_members, 0)) AS BIGINT) AS total_members,
  avg(coalesce(g.group_rating, 0)) AS avg_group_rating
FROM stg_groups g
LEFT JOIN stg_categories c ON g.category_id = c.category_id
GROUP BY 1, 2, 3"""

SQL_AGG_GROUPS_BY_TOPIC = f"WITH {STAGING}\n" + """SELECT
  gt.topic_id,
  coalesce(t.topic_name, gt.topic_name, 'UNKNOWN') AS topic_name,
  count(DISTINCT gt.group_id) AS total_groups,
  CAST(sum(coalesce(g.group_members, 0)) AS BIGINT) AS total_group_members,
  avg(coalesce(g.group_rating, 0)) AS avg_group_rating
FROM stg_groups_topics gt
LEFT JOIN stg_topics t ON gt.topic_id = t.topic_id
LEFT JOIN stg_groups g ON gt.group_id = g.group_id
GROUP BY 1, 2"""

SQL_AGG_EVENTS_BY_GROUP = WITH_ENRICHED + """SELECT
  group_id,
  event_group_name AS group_name,
  category_id,
  coalesce(category_name, 'UNKNOWN') AS category_name,
  count(*) AS total_events,
  CAST(sum(coalesce(yes_rsvp_count, 0)) AS BIGINT) AS total_yes_rsvp,
  avg(coalesce(event_rating_average, 0)) AS avg_event_rating,
  avg(coalesce(group_rating, 0)) AS avg_group_rating
FROM events_enriched
GROUP BY 1, 2, 3, 4"""



def _body(sql: str) -> str:
    """Strip the leading WITH-clause of a mart query, keeping its final SELECT."""
    return sql[sql.rindex("\nSELECT") + 1:]


ALL_MODELS = (
    f"WITH {STAGING},\nevents_enriched AS (\n  {EVENTS_ENRICHED_BODY}\n),\n"
    f"agg_events_by_city AS (\n{_body(SQL_AGG_EVENTS_BY_CITY)}\n),\n"
    f"agg_groups_by_category AS (\n{_body(SQL_AGG_GROUPS_BY_CATEGORY)}\n),\n"
    f"agg_groups_by_topic AS (\n{_body(SQL_AGG_GROUPS_BY_TOPIC)}\n),\n"
    f"agg_events_by_group AS (\n{_body(SQL_AGG_EVENTS_BY_GROUP)}\n)\n"
)

# Declared column tests (model → columns), restated for the oracle.
NOT_NULL = [
    ("stg_events", "event_id"), ("stg_events", "group_id"), ("stg_groups", "group_id"),
    ("stg_venues", "venue_id"), ("stg_categories", "category_id"), ("stg_topics", "topic_id"),
    ("stg_groups_topics", "group_id"), ("stg_groups_topics", "topic_id"),
    ("events_enriched", "event_id"), ("events_enriched", "group_id"),
    ("agg_events_by_city", "venue_city"), ("agg_events_by_city", "total_events"),
    ("agg_groups_by_category", "category_name"), ("agg_groups_by_category", "total_groups"),
    ("agg_groups_by_topic", "topic_name"), ("agg_groups_by_topic", "total_groups"),
    ("agg_events_by_group", "group_id"), ("agg_events_by_group", "total_events"),
]
UNIQUE = [("stg_events", "event_id"), ("stg_groups", "group_id"), ("events_enriched", "event_id")]

SQL_DQ_NOT_NULL = ALL_MODELS + "\nUNION ALL\n".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, 'not_null' AS test, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS failures, "
    f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status "
    f"FROM {m}"
    for m, c in NOT_NULL
)

SQL_DQ_UNIQUE = ALL_MODELS + "\nUNION ALL\n".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, 'unique' AS test, count(*) AS failures, "
    f"CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status "
    f"FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
    for m, c in UNIQUE
)

SQL_HAVING_DUPLICATES = f"WITH {RAW_EVENTS}\n" + """SELECT event_id, count(*) AS n
FROM raw_events GROUP BY event_id HAVING count(*) > 1"""

STAGE_BATCH = """stage AS (
  SELECT
    CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS VARCHAR) END AS event_id,
    CASE event_type WHEN 'view' THEN 'upcoming' WHEN 'click' THEN 'Cancelled'
                    WHEN 'signup' THEN 'UPCOMING' WHEN 'purchase' THEN NULL
                    ELSE event_type END AS event_status,
    user_id AS yes_rsvp_count,
    CAST(floor(value) AS BIGINT) AS maybe_rsvp_count,
    CAST(floor(value) AS BIGINT) - 5 AS waitlist_count,
    (epoch_us(ts) // 1000) AS updated
  FROM events
)"""

AUDIT_LOG = """audit AS (
  SELECT
    'eventmart_incremental' AS dag_id,
    'run_' || day AS run_id,
    'audit' AS task_id,
    'events_delta_' || day || '_' || et || '.csv' AS file_name,
    CAST(NULL AS VARCHAR) AS table_name,
    CAST(NULL AS VARCHAR) AS source_key,
    CAST(NULL AS VARCHAR) AS normalized_key,
    'incremental/events/events_delta_' || day || '.csv' AS s3_key,
    CAST(NULL AS VARCHAR) AS detected_encoding,
    n AS row_count,
    CASE WHEN et = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN et = 'click' THEN 'DELTA_GENERATED'
         WHEN et IN ('purchase', 'error') THEN 'DELTA_UPLOADED'
         ELSE 'FILE_NORMALIZED' END AS event_type
  FROM (SELECT event_type AS et, strftime(ts, '%Y%m%d') AS day, count(*) AS n
        FROM events GROUP BY 1, 2)
)"""

SQL_FILE_AUDIT_EXPECTED_ROWS = f"WITH {AUDIT_LOG}\n" + """SELECT dag_id, run_id,
  coalesce(max(CASE WHEN event_type IN ('DELTA_GENERATED', 'DELTA_UPLOADED')
                     AND status = 'SUCCESS' THEN row_count END), 0) AS expected_rows
FROM audit GROUP BY dag_id, run_id"""


def _check(order: int, name: str, value: str, ok: str, message: str) -> str:
    return (f"SELECT {order} AS check_order, '{name}' AS check_name, "
            f"CAST({value} AS BIGINT) AS metric_value, "
            f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"CASE WHEN {ok} THEN NULL ELSE {message} END AS error_message FROM m, e")


SQL_DQ_STAGE_CHECKS = f"WITH {STAGE_BATCH},\n{AUDIT_LOG},\n" + """m AS (
  SELECT
    count(*) AS row_count,
    count(*) FILTER (WHERE event_id IS NULL) AS null_event_id,
    (SELECT count(*) FROM (SELECT event_id FROM stage GROUP BY 1 HAVING count(*) > 1))
      AS duplicate_event_id,
    count(*) FILTER (WHERE coalesce(yes_rsvp_count, 0) < 0 OR coalesce(maybe_rsvp_count, 0) < 0
                        OR coalesce(waitlist_count, 0) < 0) AS negative_rsvp_values,
    count(*) FILTER (WHERE event_status IS NOT NULL
                       AND lower(event_status) NOT IN ('upcoming', 'cancelled')) AS invalid_status
  FROM stage
),
e AS (
  SELECT coalesce(max(row_count), 0) AS expected FROM audit
  WHERE dag_id = 'eventmart_incremental' AND run_id = 'run_20240101'
    AND event_type IN ('DELTA_GENERATED', 'DELTA_UPLOADED') AND status = 'SUCCESS'
)
""" + "\nUNION ALL\n".join([
    _check(0, "row_count", "row_count", "row_count > 0", "'stage table is empty'"),
    _check(1, "null_event_id", "null_event_id", "null_event_id = 0",
           "'there are NULL event_id values'"),
    _check(2, "duplicate_event_id", "duplicate_event_id", "duplicate_event_id = 0",
           "'there are duplicated event_id values'"),
    _check(3, "negative_rsvp_values", "negative_rsvp_values", "negative_rsvp_values = 0",
           "'there are negative RSVP metrics'"),
    _check(4, "invalid_status", "invalid_status", "invalid_status = 0",
           "'event_status outside the allowed domain'"),
    _check(5, "stage_matches_delta_row_count", "row_count", "row_count = expected",
           "'stage row_count does not match delta row_count: stage ' || row_count "
           "|| ', delta ' || expected"),
])


TARGET_EVENTS = """tgt AS (
  SELECT
    CAST(event_id AS VARCHAR) AS event_id,
    'Event ' || event_type || ' ' || event_id AS event_name,
    'upcoming' AS event_status,
    user_id AS group_id,
    (epoch_us(ts) // 1000) AS created,
    (epoch_us(ts) // 1000) AS updated,
    user_id AS yes_rsvp_count,
    CAST(floor(value) AS BIGINT) AS maybe_rsvp_count,
    CAST(floor(value) AS BIGINT) - 5 AS waitlist_count
  FROM events
)"""

DELTA_EVENTS = """src AS (
  SELECT
    CASE WHEN event_type = 'click' THEN CAST(event_id AS VARCHAR)
         ELSE 'delta-' || event_id END AS event_id,
    'Delta ' || event_id AS event_name,
    CASE WHEN event_type = 'click' AND value < 50 THEN 'cancelled' ELSE 'upcoming' END
      AS event_status,
    (epoch_us(ts) // 1000) AS created,
    (epoch_us(ts) // 1000) + 3600000 AS updated,
    user_id AS yes_rsvp_count,
    CASE WHEN event_type = 'click' AND user_id < 50 THEN NULL
         ELSE CAST(floor(value + 7) AS BIGINT) END AS maybe_rsvp_count,
    CAST(floor(value + 7) AS BIGINT) - 5 AS waitlist_count
  FROM events
  WHERE event_type IN ('click', 'purchase')
)"""

SQL_MERGE_EVENTS = f"WITH {TARGET_EVENTS},\n{DELTA_EVENTS}\n" + """SELECT
  t.event_id, t.event_name,
  CASE WHEN s.present THEN s.event_status ELSE t.event_status END AS event_status,
  t.group_id, t.created,
  CASE WHEN s.present THEN s.updated ELSE t.updated END AS updated,
  CASE WHEN s.present THEN s.yes_rsvp_count ELSE t.yes_rsvp_count END AS yes_rsvp_count,
  CASE WHEN s.present THEN s.maybe_rsvp_count ELSE t.maybe_rsvp_count END AS maybe_rsvp_count,
  CASE WHEN s.present THEN s.waitlist_count ELSE t.waitlist_count END AS waitlist_count
FROM tgt t
LEFT JOIN (SELECT *, true AS present FROM src) s ON t.event_id = s.event_id
UNION ALL
SELECT s.event_id, s.event_name, s.event_status, CAST(NULL AS BIGINT) AS group_id, s.created,
       s.updated, s.yes_rsvp_count, s.maybe_rsvp_count, s.waitlist_count
FROM src s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.event_id = s.event_id)"""


# Columns of the raw events stand-in that are entirely NULL: inference types them as text.
ALL_NULL_EVENT_COLUMNS = {
    "photo_url", "why", "how_to_find_us", "fee.description", "group.created",
    "group.group_lat", "group.group_lon", "venue.state", "venue.country", "venue.address_1",
    "venue.address_2", "venue.lat", "venue.lon", "venue.localized_country_name",
    "venue.phone", "venue.zip",
}

SQL_CSV_LOAD_TYPED = f"WITH {RAW_EVENTS}\nSELECT " + ", ".join(
    (f'CAST("{src}" AS VARCHAR) AS "{src}"' if src in ALL_NULL_EVENT_COLUMNS else f'"{src}"')
    for src, _ in schemas.STG_EVENTS
) + " FROM raw_events"

SQL_CSV_BIND_BY_NAME = f"WITH {DELTA_EVENTS}\n" + """SELECT event_id, event_name, event_status,
  CAST(NULL AS BIGINT) AS group_id, created, updated, yes_rsvp_count, maybe_rsvp_count,
  waitlist_count
FROM src"""

SQL_ENCODING_DETECT = """SELECT doc_id, lang,
  CASE WHEN coalesce(lang NOT IN ('de', 'es'), true) THEN 'utf-8-sig'
       WHEN regexp_matches(text, '[^\x00-\x7F]') THEN 'cp1252'
       ELSE 'utf-8-sig' END AS detected_encoding,
  text
FROM documents"""

SQL_FILE_ENCODINGS = f"WITH d AS ({SQL_ENCODING_DETECT})\n" + """SELECT lang, detected_encoding,
  count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS characters
FROM d GROUP BY 1, 2"""


SQL_RENAME_FLATTEN = f"WITH {STAGING}\nSELECT * FROM stg_events"

SQL_COALESCE_FALLBACK = f"WITH {STAGING}\n" + """SELECT e.event_id, e.venue_id,
  coalesce(e.venue_city, v.city) AS venue_city,
  coalesce(e.venue_name, v.venue_name, 'UNKNOWN') AS venue_name,
  coalesce(e.venue_state, v.state, 'UNKNOWN') AS venue_state
FROM stg_events e LEFT JOIN stg_venues v ON e.venue_id = v.venue_id"""

SQL_LIMIT_ORDERED = f"WITH {STAGING}\n" + """SELECT group_id, group_city, group_members
FROM stg_groups ORDER BY group_id LIMIT 50"""

SQL_SAMPLE_N = f"WITH {TARGET_EVENTS}\n" + """SELECT * FROM tgt
ORDER BY md5('42:' || event_id), event_id LIMIT 5"""

SQL_COUNTER_DELTAS = f"WITH {TARGET_EVENTS},\n" + """d AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(1 AS BIGINT) AS yes_rsvp_count,
         CAST(NULL AS BIGINT) AS maybe_rsvp_count, CAST(0 AS BIGINT) AS waitlist_count
  FROM events
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), CAST(floor(value / 40) + 1 AS BIGINT),
         CASE WHEN value > 245 THEN 1 ELSE 0 END, CAST(floor(value / 100) AS BIGINT)
  FROM events WHERE event_type = 'click'
),
s AS (
  SELECT event_id, sum(coalesce(yes_rsvp_count, 0)) AS dy, sum(coalesce(maybe_rsvp_count, 0)) AS dm,
         sum(coalesce(waitlist_count, 0)) AS dw
  FROM d GROUP BY event_id
)
SELECT t.event_id, t.event_name, t.event_status, t.group_id, t.created, t.updated,
  CAST(coalesce(t.yes_rsvp_count, 0) + coalesce(s.dy, 0) AS BIGINT) AS yes_rsvp_count,
  CAST(coalesce(t.maybe_rsvp_count, 0) + coalesce(s.dm, 0) AS BIGINT) AS maybe_rsvp_count,
  CAST(coalesce(t.waitlist_count, 0) + coalesce(s.dw, 0) AS BIGINT) AS waitlist_count
FROM tgt t LEFT JOIN s ON t.event_id = s.event_id"""

# The types inference must give the raw event columns of the stand-in
# (an all-NULL column stays text; event_id, venue.phone and venue.zip are forced text).
EXPECTED_EVENT_TYPES = {
    "created": "bigint", "updated": "bigint", "event_time": "bigint", "duration": "bigint",
    "utc_offset": "bigint", "headcount": "bigint", "rsvp_limit": "bigint",
    "yes_rsvp_count": "bigint", "maybe_rsvp_count": "bigint", "waitlist_count": "bigint",
    "fee.amount": "double", "fee.required": "boolean", "rating.average": "double",
    "rating.count": "bigint", "group_id": "bigint", "venue_id": "bigint",
    "venue.repinned": "boolean",
}

SQL_INFERRED_TEMPLATE = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{src}', '{EXPECTED_EVENT_TYPES.get(src, 'string')}')"
    for i, (src, _) in enumerate(schemas.STG_EVENTS)
) + ") AS t(order_id, column_name, data_type) WHERE (SELECT count(*) FROM lineitem) > 0"

SQL_EXPORT_ROUNDTRIP = SQL_AGG_EVENTS_BY_CITY


# Skewed variant of the events stand-in: 'R' line items all in group 0, 'A' ones venue-less.
_GROUP_LINE = "    l_orderkey AS group_id,\n"
_VENUE_LINE = ("    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL ELSE l_suppkey END "
               "AS venue_id,\n")
assert _GROUP_LINE in RAW_EVENTS and _VENUE_LINE in RAW_EVENTS
RAW_EVENTS_HOT = RAW_EVENTS.replace(
    _GROUP_LINE, "    CASE WHEN l_returnflag = 'R' THEN CAST(0 AS BIGINT) ELSE l_orderkey END"
                 " AS group_id,\n").replace(
    _VENUE_LINE, "    CASE WHEN l_returnflag = 'A' THEN NULL"
                 " WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL ELSE l_suppkey END"
                 " AS venue_id,\n")
STAGING_HOT = STAGING.replace(RAW_EVENTS, RAW_EVENTS_HOT)
SQL_EVENTS_ENRICHED_HOT = f"WITH {STAGING_HOT}\n{EVENTS_ENRICHED_BODY}"
SQL_AGG_EVENTS_BY_GROUP_HOT = SQL_AGG_EVENTS_BY_GROUP.replace(STAGING, STAGING_HOT)


# The whole flow on stand-in data: raw events merged with a delta batch (MERGE:
# matched keys take the five update columns, new keys are inserted by name).
_FLOW_UPDATE = {"yes_rsvp_count", "maybe_rsvp_count", "waitlist_count", "updated",
                "event_status"}
_FLOW_DELTA_COLS = _FLOW_UPDATE | {"event_id", "group_id", "venue_id"}
FLOW_DELTA = """flow_delta AS (
  SELECT 'e' || l_orderkey || '-' || l_linenumber AS event_id,
         CAST(max(l_quantity) AS BIGINT) + 100 AS yes_rsvp_count,
         CAST(NULL AS BIGINT) AS maybe_rsvp_count,
         CAST(count(*) AS BIGINT) AS waitlist_count,
         max(epoch_ms(l_shipdate)) + 1 AS updated,
         'cancelled' AS event_status,
         CAST(NULL AS BIGINT) AS group_id,
         CAST(NULL AS BIGINT) AS venue_id
  FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'
  GROUP BY l_orderkey, l_linenumber
  UNION ALL
  SELECT 'delta-' || l_orderkey, CAST(sum(l_quantity) AS BIGINT), CAST(0 AS BIGINT),
         CAST(0 AS BIGINT), max(epoch_ms(l_shipdate)), 'upcoming', l_orderkey, min(l_suppkey)
  FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 1
  GROUP BY l_orderkey
)"""
FLOW_MERGED_EVENTS = "raw_events AS (\n  SELECT " + ", ".join(
    (f'CASE WHEN d.event_id IS NOT NULL THEN d.{src} ELSE t."{src}" END AS "{src}"'
     if src in _FLOW_UPDATE else f't."{src}"')
    for src, _ in schemas.STG_EVENTS
) + "\n  FROM raw_events0 t LEFT JOIN flow_delta d ON t.event_id = d.event_id\n" \
    "  UNION ALL\n  SELECT " + ", ".join(
    (f'd.{src}' if src in _FLOW_DELTA_COLS else "NULL") for src, _ in schemas.STG_EVENTS
) + "\n  FROM flow_delta d\n  WHERE NOT EXISTS " \
    "(SELECT 1 FROM raw_events0 t WHERE t.event_id = d.event_id)\n)"
STAGING_FLOW = STAGING.replace(
    RAW_EVENTS,
    RAW_EVENTS.replace("raw_events AS (", "raw_events0 AS (", 1) + ",\n" + FLOW_DELTA
    + ",\n" + FLOW_MERGED_EVENTS)
SQL_FLOW_CITY_AFTER_BATCH = SQL_AGG_EVENTS_BY_CITY.replace(STAGING, STAGING_FLOW)
SQL_FLOW_GROUP_AFTER_BATCH = SQL_AGG_EVENTS_BY_GROUP.replace(STAGING, STAGING_FLOW)
assert STAGING in SQL_AGG_EVENTS_BY_CITY and STAGING in SQL_AGG_EVENTS_BY_GROUP


# Fan-out variant: every venue of nation 3 listed twice (annex name, rating + 0.5).
RAW_VENUES_FANOUT = RAW_VENUES.replace("raw_venues AS (", "raw_venues0 AS (", 1) + """,
raw_venues AS (
  SELECT * FROM raw_venues0
  UNION ALL
  SELECT venue_id, venue_name || ' (annex)', city, state, country, address_1, lat, lon,
         localized_country_name, rating + 0.5, rating_count, normalised_rating
  FROM raw_venues0 WHERE city = 'City 3'
)"""
STAGING_FANOUT = STAGING.replace(RAW_VENUES, RAW_VENUES_FANOUT)
SQL_EVENTS_ENRICHED_FANOUT = f"WITH {STAGING_FANOUT}\n{EVENTS_ENRICHED_BODY}"
SQL_AGG_EVENTS_BY_CITY_FANOUT = SQL_AGG_EVENTS_BY_CITY.replace(STAGING, STAGING_FANOUT)


SQL_TABLE_VERSIONS = f"WITH merged AS ({SQL_MERGE_EVENTS}),\n{TARGET_EVENTS}\n" + """SELECT 1 AS version, event_id, event_status, yes_rsvp_count FROM tgt
UNION ALL SELECT 2, event_id, event_status, yes_rsvp_count FROM merged
UNION ALL SELECT 3, event_id, event_status, yes_rsvp_count FROM merged WHERE event_status <> 'cancelled'"""

RAW_CATEGORIES_RENAMED = RAW_CATEGORIES.replace("raw_categories AS (", "raw_categories0 AS (", 1) + """,
raw_categories AS (
  SELECT * REPLACE (category_name || ' 2' AS category_name) FROM raw_categories0
)"""
SQL_M3_RENAMED = SQL_AGG_GROUPS_BY_CATEGORY.replace(RAW_CATEGORIES, RAW_CATEGORIES_RENAMED)
SQL_FLOW_FAILED_TEST = f"""SELECT 'agg_events_by_city' AS mart, venue_city AS name, total_events AS total
FROM ({SQL_AGG_EVENTS_BY_CITY})
UNION ALL
SELECT 'agg_groups_by_category', category_name, total_groups FROM ({SQL_M3_RENAMED})"""

SQL_CSV_QUOTED_BREAKS = """SELECT page_id,
  CASE WHEN url IN ('NULL', 'null', '') THEN NULL ELSE url END AS url,
  CASE WHEN html IN ('NULL', 'null', '') THEN NULL ELSE html END AS html
FROM pages"""

SQL_CSV_EXACT_DECIMALS = """SELECT l_orderkey || '-' || l_linenumber AS line,
  (l_orderkey + 12345678901000000) || '.25' AS wide,
  '0.' || lpad(CAST(l_orderkey AS VARCHAR), 19, '0') AS fine,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_partkey + 0.5::DOUBLE END AS short,
  'string decimal(19,2) decimal(19,19) double' AS types
FROM lineitem"""


_DELTA_FILES = """files AS (
  SELECT event_type, strftime(ts, '%Y%m%d') AS day, count(*) AS announced,
         count(*) FILTER (WHERE event_type <> 'click' OR value >= 5) AS arrived
  FROM events GROUP BY 1, 2
)"""

SQL_DELTA_RECONCILIATION = f"WITH {_DELTA_FILES}\n" + """SELECT 'eventmart_incremental' AS dag_id, 'run_' || day AS run_id,
  count(*) AS files, CAST(sum(announced) AS BIGINT) AS announced_rows,
  CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE arrived END) AS BIGINT) AS arrived_rows,
  count(*) FILTER (WHERE event_type = 'error' OR arrived <> announced) AS wrong_files,
  CASE WHEN count(*) FILTER (WHERE event_type = 'error' OR arrived <> announced) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM files GROUP BY day"""

SQL_LOGS_REPLAYED = f"WITH gate AS ({SQL_DQ_STAGE_CHECKS}),\n{_DELTA_FILES},\n" + """log AS (
  SELECT event_type, day, 'DELTA_GENERATED' AS kind, announced + 10 AS n FROM files WHERE event_type = 'signup'
  UNION ALL SELECT event_type, day, 'DELTA_UPLOADED', announced FROM files
  UNION ALL SELECT event_type, day, 'DELTA_ARRIVED', arrived FROM files WHERE event_type <> 'error'
)
SELECT 'file_audit' AS log, event_type || '_' || day || '.csv' AS name, kind, 'SUCCESS' AS status, n, CAST(1 AS BIGINT) AS same_id FROM log
UNION ALL SELECT 'dq_results', check_name, error_message, status, metric_value, 1 FROM gate"""

SQL_NORMALIZED_COPY = """SELECT 'id, name ,plain,quo ted' AS line
UNION ALL SELECT n_nationkey || ',  ' || n_name || ', ' || lower(n_name) || '  ,"' || n_name || ' ""x"", "' FROM nation"""

SQL_DELTA_COLUMNS = """SELECT event_id,
  CASE WHEN event_type IN ('view', 'click') THEN 'upcoming' ELSE event_type END AS event_status,
  'delta-' || substr(sha256(CAST(event_id AS VARCHAR)), 1, 12) AS delta_id,
  strftime(ts, '%Y%m%d%H%M%S') AS stamp
FROM events"""

SQL_MERGE_HOT_TARGET_KEY = SQL_MERGE_EVENTS.replace(
    "WITH tgt AS (", "WITH tgt0 AS (").replace(",\nsrc AS (", """,
tgt AS (SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN '3' ELSE event_id END AS event_id) FROM tgt0),
src0 AS (""").replace("""WHERE event_type IN ('click', 'purchase')
)""", """WHERE event_type IN ('click', 'purchase')
),
src AS (
  SELECT * FROM src0 WHERE event_id <> '3'
  UNION ALL SELECT '3', 'Delta 3', 'cancelled', 0, 1, 7, NULL, 9
)""")


def oracle_sql() -> dict[str, str]:
    return {
        "events_enriched": SQL_EVENTS_ENRICHED,
        "agg_events_by_city": SQL_AGG_EVENTS_BY_CITY,
        "agg_groups_by_category": SQL_AGG_GROUPS_BY_CATEGORY,
        "agg_groups_by_topic": SQL_AGG_GROUPS_BY_TOPIC,
        "agg_events_by_group": SQL_AGG_EVENTS_BY_GROUP,
        "dq_stage_checks": SQL_DQ_STAGE_CHECKS,
        "dq_not_null": SQL_DQ_NOT_NULL,
        "dq_unique": SQL_DQ_UNIQUE,
        "having_duplicates": SQL_HAVING_DUPLICATES,
        "file_audit_expected_rows": SQL_FILE_AUDIT_EXPECTED_ROWS,
        "merge_events": SQL_MERGE_EVENTS,
        "merge_events_shuffled": SQL_MERGE_EVENTS,
        "csv_load_typed": SQL_CSV_LOAD_TYPED,
        "csv_bind_by_name": SQL_CSV_BIND_BY_NAME,
        "encoding_detect": SQL_ENCODING_DETECT,
        "file_encodings": SQL_FILE_ENCODINGS,
        "incremental_stream": SQL_MERGE_EVENTS,
        "rename_flatten": SQL_RENAME_FLATTEN,
        "coalesce_fallback": SQL_COALESCE_FALLBACK,
        "limit_ordered": SQL_LIMIT_ORDERED,
        "sample_n": SQL_SAMPLE_N,
        "counter_deltas": SQL_COUNTER_DELTAS,
        "inferred_template": SQL_INFERRED_TEMPLATE,
        "export_roundtrip": SQL_EXPORT_ROUNDTRIP,
        "events_enriched_shuffled": SQL_EVENTS_ENRICHED,
        "agg_groups_by_topic_shuffled": SQL_AGG_GROUPS_BY_TOPIC,
        "events_enriched_hot_keys": SQL_EVENTS_ENRICHED_HOT,
        "agg_events_by_group_hot_keys": SQL_AGG_EVENTS_BY_GROUP_HOT,
        "flow_city_after_batch": SQL_FLOW_CITY_AFTER_BATCH,
        "flow_group_after_batch": SQL_FLOW_GROUP_AFTER_BATCH,
        "flow_rerun_older_run": SQL_FLOW_CITY_AFTER_BATCH,
        "flow_crash_new_run_id": SQL_FLOW_GROUP_AFTER_BATCH,
        "agg_groups_by_category_shuffled": SQL_AGG_GROUPS_BY_CATEGORY,
        "events_enriched_fanout": SQL_EVENTS_ENRICHED_FANOUT,
        "agg_events_by_city_fanout": SQL_AGG_EVENTS_BY_CITY_FANOUT,
        "table_versions": SQL_TABLE_VERSIONS,
        "merge_after_bucket_split": SQL_MERGE_EVENTS,
        "flow_failed_test": SQL_FLOW_FAILED_TEST,
        "csv_quoted_breaks": SQL_CSV_QUOTED_BREAKS,
        "csv_exact_decimals": SQL_CSV_EXACT_DECIMALS,
        "delta_reconciliation": SQL_DELTA_RECONCILIATION,
        "logs_replayed": SQL_LOGS_REPLAYED,
        "normalized_copy": SQL_NORMALIZED_COPY,
        "delta_columns": SQL_DELTA_COLUMNS,
        "merge_hot_target_key": SQL_MERGE_HOT_TARGET_KEY,
    }
