"""Table store: catalog registration, clone, truncate, append, bucketed replace."""

from __future__ import annotations

import time

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from eventmart.config.schemas import DQ_RESULTS_SCHEMA
from eventmart.sinks import tables
from eventmart.sinks.tables import (
    BUCKET_COL,
    TableStore,
    merge_into,
    split_buckets,
    write_bucketed,
)


def test_catalog_tables_are_queryable_by_sql(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"), use_catalog=True)
    store.create_database("mon_t")
    store.create_if_absent("mon_t", "dq_results", DQ_RESULTS_SCHEMA)
    assert spark.sql("SELECT count(*) AS n FROM mon_t.dq_results").first()["n"] == 0
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    store.replace(df, "mon_t", "things")
    store.create_like("mon_t", "things_stage", "things")
    assert spark.table("mon_t.things_stage").columns == ["id", "v"]
    assert spark.table("mon_t.things_stage").count() == 0
    assert spark.table("mon_t.things_stage").count() == 0
    store.append(df, "mon_t", "things_stage")
    assert store.read("mon_t", "things_stage").count() == 2
    assert spark.table("mon_t.things_stage").count() == 2      # SQL sees the append
    store.truncate("mon_t", "things_stage")
    assert store.read("mon_t", "things_stage").count() == 0
    assert spark.sql("SELECT count(*) FROM mon_t.things_stage").first()[0] == 0


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"), use_catalog=False)
    base = spark.range(200).select(F.col("id").cast("string").alias("event_id"),
                                   F.lit(0).cast("bigint").alias("yes_rsvp_count"))
    write_bucketed(store, base, "raw", "events", "event_id", 8)
    before = {r[BUCKET_COL]: r["n"] for r in store.read("raw", "events")
              .groupBy(BUCKET_COL).agg(F.count(F.lit(1)).alias("n")).collect()}
    delta = spark.createDataFrame([("5", 9), ("new", 1)], "event_id string, yes_rsvp_count bigint")
    touched = merge_into(store, delta, "raw", "events", "event_id", ["yes_rsvp_count"], 8)
    assert 1 <= len(touched) <= 2
    after_df = store.read("raw", "events")
    assert after_df.count() == 201
    after = {r[BUCKET_COL]: r["n"] for r in after_df.groupBy(BUCKET_COL)
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {b: n for b, n in after.items() if b not in touched} == \
        {b: n for b, n in before.items() if b not in touched}
    got = {r["event_id"]: r["yes_rsvp_count"] for r in after_df.filter(
        F.col("event_id").isin("5", "6", "new")).collect()}
    assert got == {"5": 9, "6": 0, "new": 1}


def test_compact_keeps_rows_and_reduces_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"), use_catalog=False)
    for i in range(5):
        store.append(spark.createDataFrame([(i, f"r{i}")], "id bigint, v string"), "mon", "log")

    def parts():
        return store.read("mon", "log").inputFiles()

    assert len(parts()) >= 5
    store.compact("mon", "log")
    assert len(parts()) == 1
    assert sorted(r["id"] for r in store.read("mon", "log").collect()) == [0, 1, 2, 3, 4]


def test_log_is_compacted_by_appends(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_LOADS", 4)
    store = TableStore(spark, str(tmp_path / "wh"), use_catalog=False)
    for i in range(7):
        store.append(spark.createDataFrame([(i,)], "id bigint"), "mon", "log")
    assert len(store.version("mon", "log").loads) == 3
    assert sorted(r["id"] for r in store.read("mon", "log").collect()) == list(range(7))
    with pytest.raises(ValueError, match="columns of mon.log"):
        store.append(spark.createDataFrame([("a",)], "id string"), "mon", "log")


def _ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_a_job_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch):
    """In the middle of the write, or between the write and the publication."""
    store = TableStore(spark, str(tmp_path / "wh"), use_catalog=False)
    store.replace(spark.range(5), "raw", "t")
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost")))
                                     .otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.replace(broken.repartition(4), "raw", "t")
    assert _ids(store.read("raw", "t")) == list(range(5))
    real = store.files.create
    monkeypatch.setattr(store.files, "create", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        store.replace(spark.range(9), "raw", "t")
    assert _ids(store.read("raw", "t")) == list(range(5))
    monkeypatch.setattr(store.files, "create", real)
    store.replace(spark.range(7), "raw", "t")
    assert _ids(store.read("raw", "t")) == list(range(7))


def test_readers_keep_their_version_until_it_is_removed(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"), use_catalog=False)
    store.replace(spark.range(3), "raw", "t")
    reader = store.read("raw", "t")
    store.replace(store.read("raw", "t").select((F.col("id") + 10).alias("id")), "raw", "t")
    store.replace(spark.range(1), "raw", "t")
    assert _ids(reader) == [0, 1, 2] and _ids(store.read("raw", "t", 2)) == [10, 11, 12]
    under_way = store.stage(spark.range(2), "raw", "t")
    assert len(store.vacuum("raw", "t", keep=2)) == 1
    assert store.versions("raw", "t") == [2, 3] and _ids(store.read("raw", "t", 2)) == [10, 11, 12]
    store.publish(under_way)                       # an unpublished write was not removed
    assert _ids(store.read("raw", "t")) == [0, 1]
    dead = store.stage(spark.range(2), "raw", "t")
    assert store.vacuum("raw", "t", keep=9, orphan_hours=-1) == [dead.load]


def test_concurrent_writers(spark, tmp_path):
    """Appends of several jobs all arrive; a bucket rewrite on an old version is refused."""
    store = TableStore(spark, str(tmp_path / "wh"), use_catalog=False)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: store.append(spark.range(i, i + 1), "mon", "log"), range(12)))
    assert _ids(store.read("mon", "log")) == list(range(12))
    assert store.versions("mon", "log") == list(range(1, 13))
    base = spark.range(20).select(F.col("id").cast("string").alias("k"), F.col("id"))
    write_bucketed(store, base, "raw", "t", "k", 4)
    number = store.version("raw", "t").number
    store.replace(store.read("raw", "t").filter("id < 10").drop(BUCKET_COL), "raw", "t")
    with pytest.raises(tables.ConcurrentWrite):
        tables.replace_buckets(store, base, "raw", "t", "k", 4, based_on=number)
    assert _ids(store.read("raw", "t")) == list(range(10))


def test_merge_writes_only_the_touched_buckets_once(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"), use_catalog=False)
    base = spark.range(200).select(F.col("id").cast("string").alias("k"), F.col("id").alias("n"))
    write_bucketed(store, base, "raw", "t", "k", 8)
    first = store.version("raw", "t")
    touched = merge_into(store, spark.createDataFrame([("5", 9), ("new", 1)], "k string, n bigint"),
                         "raw", "t", "k", ["n"], 8)
    second = store.version("raw", "t")
    (old, kept), (new, moved) = second.loads.items()
    assert [old] == list(first.loads) and sorted(moved) == touched
    assert sorted(kept + moved) == sorted(first.loads[old])
    folder = store.path("raw", "t")
    assert {f"{BUCKET_COL}={b}" for b in touched} == {
        n for n in store.files.names(f"{folder}/{new}") if n.startswith(BUCKET_COL)}
    pruned = store.read("raw", "t").filter(F.col(BUCKET_COL) == touched[0])
    assert "PartitionFilters: [isnotnull(key_bucket" in pruned._jdf.queryExecution().executedPlan().toString()


def test_split_buckets_and_merge_before_and_after(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"), use_catalog=False)
    base = spark.range(300).select(F.col("id").cast("string").alias("k"), F.col("id").alias("n"))
    write_bucketed(store, base.union(spark.createDataFrame([(None, -1)], "k string, n bigint")), "raw", "t", "k", 4)
    delta = spark.createDataFrame([("5", 1000), ("x", 1001)], "k string, n bigint")
    merge_into(store, delta, "raw", "t", "k", ["n"], 4)
    before = sorted(store.read("raw", "t").select("k", "n").collect(), key=str)
    assert split_buckets(store, "raw", "t", "k") == 8
    after = store.read("raw", "t")
    assert sorted(after.select("k", "n").collect(), key=str) == before
    assert after.filter(F.col(BUCKET_COL) != tables.bucket_of("k", 8)).count() == 0
    with pytest.raises(ValueError, match="8 buckets"):
        merge_into(store, delta, "raw", "t", "k", ["n"], 4)
    merge_into(store, delta.withColumn("n", F.col("n") + 1), "raw", "t", "k", ["n"], 8)
    got = {r["k"]: r["n"] for r in store.read("raw", "t").filter("n > 900").collect()}
    assert got == {"5": 1001, "x": 1002}


def test_sql_sees_the_current_version_without_a_gap(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"), use_catalog=True)
    store.create_database("ver_t")
    write_bucketed(store, spark.range(50).withColumn("k", F.col("id").cast("string")), "ver_t", "t", "k", 4)
    assert spark.table("ver_t.t").columns == ["id", "k"]      # no column of the layout
    merge_into(store, spark.createDataFrame([(99, "99")], "id bigint, k string"), "ver_t", "t", "k", ["id"], 4)
    assert spark.sql("SELECT count(*), max(id) FROM ver_t.t").first()[:] == (51, 99)
    store.replace(spark.createDataFrame([(1.5,)], "`a.b` double"), "ver_t", "t")
    assert spark.sql("SELECT `a.b` FROM ver_t.t").first()[0] == 1.5


def test_merge_of_a_large_table_goes_bucket_by_bucket(spark, tmp_path, monkeypatch):
    from eventmart.sinks import tables

    schema = "event_id string, event_status string, yes_rsvp_count bigint"
    store = tables.TableStore(spark, str(tmp_path / "wh"), use_catalog=False)
    rows = [(None if i % 10 == 0 else f"e{i % 40}", "upcoming", i) for i in range(60)]
    delta = [(f"e{i}", "cancelled", None) for i in range(30, 50)]
    old, new = spark.createDataFrame(rows, schema), spark.createDataFrame(delta, schema)
    columns, merged = ["event_status", "yes_rsvp_count"], {}
    writes = []
    stage = tables.spread_by_bucket
    monkeypatch.setattr(tables, "spread_by_bucket", lambda *a: writes.append(1) or stage(*a))
    for name, most in (("whole", 1000), ("sliced", 16)):
        monkeypatch.setattr(tables, "SLICE_ROWS", most)
        tables.write_bucketed(store, old, "raw", name, "event_id", 4)
        writes.clear()
        touched = tables.merge_into(store, new, "raw", name, "event_id", columns, 4)
        assert len(writes) == (1 if name == "whole" else 4)
        version = store.version("raw", name)
        assert version.number == 2 and touched == [0, 1, 2, 3]
        merged[name] = sorted(map(str, store.read("raw", name).collect()))
    assert merged["whole"] == merged["sliced"] and len(merged["whole"]) > 60


def test_shuffle_files_go_when_their_query_ends(spark, tmp_path):
    import os

    from eventmart.session import FREE_SHUFFLES, shuffles_freed

    def files() -> set[str]:
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f"{top}/{f}" for d in dirs for top, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    before, setting = files(), spark.conf.get(FREE_SHUFFLES)
    with shuffles_freed(spark):
        spark.range(10_000).repartition(4, "id").write.parquet(str(tmp_path / "freed"))
        for _ in range(50):
            if not files() - before:
                break
            time.sleep(0.1)
        assert not files() - before
    assert spark.conf.get(FREE_SHUFFLES) == setting


def test_a_small_merge_shuffles_only_its_inserts(spark, tmp_path, monkeypatch):
    from eventmart.sinks import tables

    store = tables.TableStore(spark, str(tmp_path), use_catalog=False)
    base = spark.range(40).selectExpr("concat('e', id) event_id", "id n", "'kept' note")
    tables.write_bucketed(store, base, "raw", "t", "event_id", 4)
    spread, dealt = tables.spread_by_bucket, []
    monkeypatch.setattr(tables, "spread_by_bucket", lambda df, *a: dealt.append(df.count()) or spread(df, *a))
    delta = spark.range(30, 50).selectExpr("concat('e', id) event_id", "-id n", "'new' note")
    tables.merge_into(store, delta, "raw", "t", "event_id", ["n"], 4)
    assert dealt == [10]
    now = store.read("raw", "t").withColumn("own", tables.bucket_of("event_id", 4) == F.col("key_bucket"))
    assert {r["event_id"]: (r["n"], r["note"], r["own"]) for r in now.collect()} == {
        f"e{i}": (i if i < 30 else -i, "kept" if i < 40 else "new", True) for i in range(50)}
    assert tables.stored_buckets(store, "raw", "t", "event_id") == 4
