"""Map the benchmark tables onto the domain's raw tables.

The correctness oracle only sees the benchmark tables (``lineitem``, ``orders``,
``supplier``, ``nation``, ``part``, ``events``).  This layer renames and derives
columns so the **same production code** (staging → marts, checks, upsert) runs
over them, and it deliberately breaks referential integrity and injects NULLs
through value predicates so the NULL/UNKNOWN/fan-out paths are exercised:

* groups keep only orders whose status is not ``P`` → events with an unknown group;
* venues keep suppliers of nations below 20 → unknown venues; some events have
  no venue id at all;
* categories come from ``nation`` and one group category id (25) has no row;
* topics of parts of size > 40 have a key no link uses → the bridge's own topic name is
  the fallback.

Numeric measures are integers, or doubles on a quarter grid with small
magnitude, so every sum is exact whatever the summation order; averages then
agree bit for bit with an independent engine.

Every function reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def _null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _epoch_ms(ts: str) -> Column:
    """Epoch milliseconds of a zone-less timestamp, read as UTC whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, F.col(ts))


def _quarter_floor(c: Column) -> Column:
    """Round down to a multiple of 0.25 (exactly representable)."""
    return F.floor(c * 4).cast("double") / 4


# The hot group of the skewed variant and the return flags that map to it.
HOT_GROUP_ID = 0
HOT_GROUP_FLAG = "R"      # a third of all line items
NULL_VENUE_FLAG = "A"     # another third: no venue id at all


def raw_events(spark: SparkSession, sf_dir: str, hot_keys: bool = False) -> DataFrame:
    """48 raw event columns from ``lineitem`` (one event per line item).

    ``hot_keys=True`` gives the skewed variant: every ``R`` line item belongs
    to one group (a third of all events on one key) and every ``A`` line item
    has no venue (a third of all events on the NULL key).
    """
    li = read_table(spark, sf_dir, "lineitem")
    flag, status, line = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    ship_ms = _epoch_ms("l_shipdate")
    group_id = F.col("l_orderkey")
    venue_id = F.when((flag == "R") & (line == 1), _null("bigint")).otherwise(F.col("l_suppkey"))
    if hot_keys:
        group_id = F.when(flag == HOT_GROUP_FLAG, F.lit(HOT_GROUP_ID).cast("bigint")) \
            .otherwise(F.col("l_orderkey"))
        venue_id = F.when(flag == NULL_VENUE_FLAG, _null("bigint")).otherwise(venue_id)
    return li.select(
        F.concat(F.lit("e"), F.col("l_orderkey"), F.lit("-"), line).alias("event_id"),
        F.concat(F.lit("Event "), F.col("l_partkey")).alias("event_name"),
        F.when(flag == "R", _null("string")).otherwise(
            F.concat(F.lit("part "), F.col("l_partkey"), F.lit(" by supplier "),
                     F.col("l_suppkey"))).alias("description"),
        F.concat(F.lit("https://events.example/"), F.col("l_orderkey"), F.lit("/"), line)
        .alias("event_url"),
        F.when(status == "O", "upcoming").otherwise("past").alias("event_status"),
        F.lit("public").alias("visibility"),
        (ship_ms - F.lit(2_592_000_000)).alias("created"),
        (ship_ms - line.cast("bigint") * 86_400_000).alias("updated"),
        ship_ms.alias("event_time"),
        (line.cast("bigint") * 1_800_000).alias("duration"),
        F.lit(0).cast("bigint").alias("utc_offset"),
        F.lit(0).cast("bigint").alias("headcount"),
        F.when(F.col("l_quantity") > 40, _null("bigint")).otherwise(F.lit(50).cast("bigint"))
        .alias("rsvp_limit"),
        F.col("l_quantity").cast("bigint").alias("yes_rsvp_count"),
        line.cast("bigint").alias("maybe_rsvp_count"),
        F.when(flag == "N", _null("bigint")).otherwise((line - 1).cast("bigint"))
        .alias("waitlist_count"),
        _null("string").alias("photo_url"),
        _null("string").alias("why"),
        _null("string").alias("how_to_find_us"),
        F.lit("cash").alias("fee.accepts"),
        F.when(F.col("l_discount") == 0, _null("double"))
        .otherwise(_quarter_floor(F.col("l_extendedprice"))).alias("fee.amount"),
        F.lit("USD").alias("fee.currency"),
        _null("string").alias("fee.description"),
        F.lit("price").alias("fee.label"),
        (F.col("l_discount") > 0.05).alias("fee.required"),
        F.when(flag == "A", _null("double")).otherwise(line.cast("double") * 0.5 + 1.0)
        .alias("rating.average"),
        line.cast("bigint").alias("rating.count"),
        group_id.alias("group_id"),
        F.concat(F.lit("Group "), F.col("l_orderkey")).alias("group.name"),
        F.concat(F.lit("group-"), F.col("l_orderkey")).alias("group.urlname"),
        F.lit("open").alias("group.join_mode"),
        F.lit("Members").alias("group.who"),
        _null("bigint").alias("group.created"),
        _null("double").alias("group.group_lat"),
        _null("double").alias("group.group_lon"),
        venue_id.alias("venue_id"),
        F.when(line <= 2, F.concat(F.lit("Venue "), F.col("l_suppkey"))).otherwise(_null("string"))
        .alias("venue.name"),
        F.when((flag == "A") & (line >= 6), F.lit("UNKNOWN"))
        .when(line == 5, F.concat(F.lit("Own City "), status))
        .otherwise(_null("string")).alias("venue.city"),
        _null("string").alias("venue.state"),
        _null("string").alias("venue.country"),
        _null("string").alias("venue.address_1"),
        _null("string").alias("venue.address_2"),
        _null("double").alias("venue.lat"),
        _null("double").alias("venue.lon"),
        _null("string").alias("venue.localized_country_name"),
        _null("string").alias("venue.phone"),
        F.lit(False).alias("venue.repinned"),
        _null("string").alias("venue.zip"),
    )


def _unused_if(condition: Column, key: str) -> Column:
    """The key, negated where ``condition`` holds: all rows stay, those are orphans."""
    return F.when(condition, -F.col(key)).otherwise(F.col(key))


def raw_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """19 raw group columns from ``orders``; those with status ``P`` get a key that no
    event uses (negated), so their events find no group."""
    o = read_table(spark, sf_dir, "orders")
    prio, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    category = F.when(prio == "5-LOW", _null("bigint")).otherwise(
        F.substring(prio, 1, 1).cast("bigint") * 6
        + F.when(status == "F", F.lit(0)).otherwise(F.lit(1))
    )
    return o.select(
        _unused_if(status == "P", "o_orderkey").alias("group_id"),
        category.alias("category_id"),
        F.when((status == "F") & (prio == "1-URGENT"), F.lit("own urgent"))
        .otherwise(_null("string")).alias("category.name"),
        _null("string").alias("category.shortname"),
        F.col("o_custkey").alias("city_id"),
        prio.alias("city"),
        _null("string").alias("state"),
        F.lit("XX").alias("country"),
        F.col("o_custkey").alias("members"),
        F.when((status == "O") & (prio == "2-HIGH"), _null("double"))
        .otherwise(_quarter_floor(F.col("o_totalprice") / 100000)).alias("rating"),
        F.lit("public").alias("visibility"),
        F.lit("UTC").alias("timezone"),
        F.concat(F.lit("group-"), F.col("o_orderkey")).alias("urlname"),
        F.lit("Members").alias("who"),
        F.concat(F.lit("https://events.example/g/"), F.col("o_orderkey")).alias("link"),
        _null("double").alias("lat"),
        _null("double").alias("lon"),
        F.col("o_custkey").alias("organizer.member_id"),
        F.concat(F.lit("Customer#"), F.col("o_custkey")).alias("organizer.name"),
    )


def raw_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """12 raw venue columns from suppliers; those of nations from 20 on get a key that
    no event uses (negated)."""
    s = read_table(spark, sf_dir, "supplier")
    return s.select(
        _unused_if(F.col("s_nationkey") >= 20, "s_suppkey").alias("venue_id"),
        F.col("s_name").alias("venue_name"),
        F.concat(F.lit("City "), F.col("s_nationkey")).alias("city"),
        F.when(F.col("s_acctbal") < 0, _null("string")).otherwise(F.lit("ST")).alias("state"),
        F.lit("XX").alias("country"),
        F.concat(F.col("s_suppkey"), F.lit(" Main St")).alias("address_1"),
        _null("double").alias("lat"),
        _null("double").alias("lon"),
        F.lit("Nowhere").alias("localized_country_name"),
        _quarter_floor(F.col("s_acctbal") / 2000).alias("rating"),
        F.col("s_nationkey").cast("bigint").alias("rating_count"),
        _null("double").alias("normalised_rating"),
    )


# Fixed value: the nation whose suppliers appear twice in the fan-out variant.
FANOUT_NATION = 3


def raw_venues_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues where every supplier of one nation is listed twice (a second row with
    another name and rating): events there fan out in the left join."""
    venues = raw_venues(spark, sf_dir)
    dup = venues.filter(F.col("city") == f"City {FANOUT_NATION}").select(
        *[(F.concat(F.col(c), F.lit(" (annex)")).alias(c) if c == "venue_name"
           else (F.col(c) + 0.5).alias(c) if c == "rating" else F.col(c))
          for c in venues.columns])
    return venues.unionByName(dup)


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("category_id"),
        F.col("n_name").alias("category_name"),
        F.lower(F.substring("n_name", 1, 3)).alias("shortname"),
    )


def raw_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics from ``part``; those of a size over 40 get a key that no link uses (negated)."""
    p = read_table(spark, sf_dir, "part")
    return p.select(_unused_if(F.col("p_size") > 40, "p_partkey").alias("topic_id"),
                    F.col("p_name").alias("topic_name"))


def raw_groups_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("group_id"),
        F.col("l_partkey").alias("topic_id"),
        F.when(F.col("l_linenumber") == 1, _null("string"))
        .otherwise(F.concat(F.lit("topic "), F.col("l_partkey"))).alias("topic_name"),
    )


RAW_BUILDERS = {
    "events": raw_events,
    "groups": raw_groups,
    "venues": raw_venues,
    "categories": raw_categories,
    "topics": raw_topics,
    "groups_topics": raw_groups_topics,
}


def raw_tables(spark: SparkSession, sf_dir: str, hot_keys: bool = False
               ) -> dict[str, DataFrame]:
    out = {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
    if hot_keys:
        out["events"] = raw_events(spark, sf_dir, hot_keys=True)
    return out


# ---------------------------------------------------------------------------
# Incremental-batch stand-ins, from the ``events`` benchmark table.
# ---------------------------------------------------------------------------

# Benchmark event types that play the staged-delta roles.
UPDATE_TYPE = "click"       # rows re-sent with new counters (key matches the target)
INSERT_TYPE = "purchase"    # rows sent under a fresh ``delta-`` key (no match)


def _event_counters(value: Column) -> list[Column]:
    return [
        F.col("user_id").alias("yes_rsvp_count"),
        F.floor(value).cast("bigint").alias("maybe_rsvp_count"),
        (F.floor(value).cast("bigint") - 5).alias("waitlist_count"),
    ]


def target_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current ``events`` table for the upsert: every benchmark event."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("Event "), F.col("event_type"), F.lit(" "), F.col("event_id"))
        .alias("event_name"),
        F.lit("upcoming").alias("event_status"),
        F.col("user_id").alias("group_id"),
        _epoch_ms("ts").alias("created"),
        _epoch_ms("ts").alias("updated"),
        *_event_counters(F.col("value")),
    )


def delta_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A valid delta: updates for ``click`` events, inserts for ``purchase`` events.

    Updates shift the counters and move ``updated`` one hour on; every third
    update (by user) sends a NULL ``maybe_rsvp_count``, which must overwrite.
    Inserts carry the whole row under a ``delta-`` key and omit ``group_id``
    (by-name insert leaves it NULL).
    """
    ev = read_table(spark, sf_dir, "events").filter(
        F.col("event_type").isin(UPDATE_TYPE, INSERT_TYPE))
    is_update = F.col("event_type") == UPDATE_TYPE
    key = F.when(is_update, F.col("event_id").cast("string")).otherwise(
        F.concat(F.lit("delta-"), F.col("event_id")))
    shifted = F.col("value") + 7
    counters = _event_counters(shifted)
    counters[1] = F.when(is_update & (F.col("user_id") < 50), _null("bigint")).otherwise(
        F.floor(shifted).cast("bigint")).alias("maybe_rsvp_count")
    return ev.select(
        key.alias("event_id"),
        F.concat(F.lit("Delta "), F.col("event_id")).alias("event_name"),
        F.when(is_update & (F.col("value") < 50), F.lit("cancelled"))
        .otherwise(F.lit("upcoming")).alias("event_status"),
        _epoch_ms("ts").alias("created"),
        (_epoch_ms("ts") + 3_600_000).alias("updated"),
        *counters,
    )


def stage_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged batch that fails several gate checks, for the DQ queries.

    * ``error`` events have a NULL key — a hot NULL group of a fifth of the rows;
    * ``waitlist_count`` is negative for values below 5;
    * status: ``view`` → 'upcoming', ``click`` → 'Cancelled', ``signup`` →
      'UPCOMING', ``purchase`` → NULL, ``error`` → 'error' (invalid).
    """
    ev = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    status = (F.when(et == "view", "upcoming").when(et == "click", "Cancelled")
              .when(et == "signup", "UPCOMING").when(et == "purchase", _null("string"))
              .otherwise(et))
    return ev.select(
        F.when(et == "error", _null("string")).otherwise(F.col("event_id").cast("string"))
        .alias("event_id"),
        status.alias("event_status"),
        *_event_counters(F.col("value")),
        _epoch_ms("ts").alias("updated"),
    )


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file-audit log derived from ``events``: one row per (event type, day).

    Row counts are the events of that type and day; ``click`` rows are the
    generated-delta records, ``purchase`` the uploaded ones, ``error`` rows are
    failed uploads and the rest normalised files.  Runs are named by day.
    """
    from eventmart.config.schemas import FILE_AUDIT_SCHEMA

    ev = read_table(spark, sf_dir, "events")
    day = F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd")
    et = F.col("event_type")
    per_day = ev.groupBy(et.alias("et"), day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    et, day, n = F.col("et"), F.col("day"), F.col("n")
    out = per_day.select(
        F.lit("eventmart_incremental").alias("dag_id"),
        F.concat(F.lit("run_"), day).alias("run_id"),
        F.lit("audit").alias("task_id"),
        F.concat(F.lit("events_delta_"), day, F.lit("_"), et, F.lit(".csv")).alias("file_name"),
        _null("string").alias("table_name"),
        _null("string").alias("source_key"),
        _null("string").alias("normalized_key"),
        F.concat(F.lit("incremental/events/events_delta_"), day, F.lit(".csv")).alias("s3_key"),
        _null("string").alias("detected_encoding"),
        n.alias("row_count"),
        F.when(et == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(et == "click", "DELTA_GENERATED").when(et == "purchase", "DELTA_UPLOADED")
        .when(et == "error", "DELTA_UPLOADED").otherwise("FILE_NORMALIZED").alias("event_type"),
        F.lit(None).cast("timestamp_ntz").alias("processed_at"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in FILE_AUDIT_SCHEMA.fields])


def pipeline_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delta batch for the raw (line-item) events, with unique keys.

    * updates: every event key that has an ``R``/``O`` line item — counters
      from those lines (``maybe_rsvp_count`` sent as NULL, which overwrites),
      status ``cancelled``;
    * inserts: one ``delta-<order>`` event per order with an ``A`` line item
      numbered 1, in that order's group, at its supplier's venue.
    """
    li = read_table(spark, sf_dir, "lineitem")
    key = F.concat(F.lit("e"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
    updates = li.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")) \
        .groupBy(key.alias("event_id")).agg(
            (F.max("l_quantity").cast("bigint") + 100).alias("yes_rsvp_count"),
            _null("bigint").alias("maybe_rsvp_count"),
            F.count(F.lit(1)).cast("bigint").alias("waitlist_count"),
            (F.max(_epoch_ms("l_shipdate")) + 1).alias("updated"),
            F.lit("cancelled").alias("event_status"),
            _null("bigint").alias("group_id"),
            _null("bigint").alias("venue_id"),
        )
    inserts = li.filter((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1)) \
        .groupBy("l_orderkey").agg(
            F.sum("l_quantity").cast("bigint").alias("yes_rsvp_count"),
            F.lit(0).cast("bigint").alias("maybe_rsvp_count"),
            F.lit(0).cast("bigint").alias("waitlist_count"),
            F.max(_epoch_ms("l_shipdate")).alias("updated"),
            F.lit("upcoming").alias("event_status"),
            F.min("l_suppkey").alias("venue_id"),
        ).select(
            F.concat(F.lit("delta-"), F.col("l_orderkey")).alias("event_id"),
            "yes_rsvp_count", "maybe_rsvp_count", "waitlist_count", "updated",
            "event_status", F.col("l_orderkey").alias("group_id"), "venue_id",
        )
    # Updates carry only the merge's columns; group and venue go with inserts.
    return updates.unionByName(inserts)
