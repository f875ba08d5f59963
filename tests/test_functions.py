"""Column helpers: defaults, fallbacks, stamps and generated keys."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import functions as F

from eventmart.functions import columns, stamps
from eventmart.sources import inference


def test_default_if_blank_and_zero_if_null(spark):
    df = spark.createDataFrame([(None, None), ("", 3), ("cancelled", -1)], "s string, n bigint")
    got = df.select(columns.default_if_blank("s", "upcoming").alias("s"),
                    (columns.zero_if_null("n") + 2).alias("n")).collect()
    assert [tuple(r) for r in got] == [("upcoming", 2), ("upcoming", 5), ("cancelled", 1)]


def test_first_present_with_default(spark):
    df = spark.createDataFrame([(None, None), (None, "b"), ("a", "b")], "x string, y string")
    got = [r[0] for r in df.select(columns.first_present("x", "y", default="UNKNOWN")).collect()]
    assert got == ["UNKNOWN", "b", "a"]


def test_delta_keys(spark):
    df = spark.createDataFrame([(1,), (2,)], "k bigint")
    seeded = [r[0] for r in df.select(stamps.delta_event_id(F.col("k"))).collect()]
    again = [r[0] for r in df.select(stamps.delta_event_id(F.col("k"))).collect()]
    assert seeded == again and len(set(seeded)) == 2
    assert all(re.fullmatch(r"delta-[0-9a-f]{12}", k) for k in seeded)
    rand = [r[0] for r in df.select(stamps.delta_event_id()).collect()]
    assert all(re.fullmatch(r"delta-[0-9a-f]{12}", k) for k in rand)


def test_stamps(spark):
    assert stamps.compact_stamp(datetime(2024, 3, 5, 7, 8, 9)) == "20240305070809"
    df = spark.createDataFrame([(datetime(2024, 3, 5, 7, 8, 9),)], "ts timestamp")
    assert df.select(stamps.compact_stamp_col(F.col("ts"))).first()[0] == "20240305070809"
    ms = spark.range(1).select(stamps.epoch_millis_now()).first()[0]
    assert abs(ms - datetime.now().timestamp() * 1000) < 120_000


def test_timestamp_with_zone_is_inferred(spark):
    df = spark.createDataFrame([("2024-01-02T10:00:00Z",), ("2024-01-02 10:00:00+01:00",)],
                               "c string")
    assert inference.infer_schema(df).fields[0].dataType.simpleString() == "timestamp"
