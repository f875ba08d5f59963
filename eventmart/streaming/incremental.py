"""Incremental delta processing with Structured Streaming.

The stream is a file-listing stream (``binaryFile`` source, content never
read): its checkpoint records which delta files were processed, so a restart
resumes with the next new file, and a batch that failed (gate error, job
failure) is replayed with the same files before newer ones; lost executors are
already handled by Spark's task retries inside the batch.  Each micro-batch
reads its CSV files by header name into the events schema and hands them to
:meth:`Pipeline.run_batch`, which writes the stage table, gates, merges and
refreshes the marts — every step replay-safe.

* cadence: ``trigger(processingTime="15 minutes")`` or ``availableNow`` from an
  outside scheduler; micro-batches of one query never overlap (the reference's
  one active run);
* one file per batch by default (``maxFilesPerTrigger=1``), as in the reference;
* the state carried between batches is the events table itself.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmart.config.schemas import FILE_AUDIT_SCHEMA
from eventmart.operators.quality import ARRIVED_EVENT_TYPE, DataQualityError
from eventmart.plans.flows import EVENTS_TABLE, DeltaLoadError, Pipeline, RunContext
from eventmart.sinks import monitoring
from eventmart.sinks.tables import BUCKET_COL
from eventmart.sources import csv as csv_src


# The fixed schema of Spark's ``binaryFile`` source.
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def delta_file_stream(pipeline: Pipeline, delta_dir: str, files_per_batch: int = 1
                      ) -> DataFrame:
    return (pipeline.spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
            .option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", files_per_batch)
            .load(delta_dir)
            .select("path", "length"))


def start_incremental(
    pipeline: Pipeline,
    delta_dir: str,
    checkpoint_dir: str,
    available_now: bool = False,
    interval: str = "15 minutes",
    files_per_batch: int = 1,
    build: bool = True,
    export_root: str | None = None,
    dag_id: str = "eventmart_incremental",
    on_failure: str = "raise",
    multi_line: bool = False,
) -> StreamingQuery:
    """Start the micro-batch query.

    ``on_failure="raise"`` (default) stops the query on a failed gate or an
    unloadable file, so a restart replays that batch; ``"quarantine"`` records
    what it can and moves on to newer files.
    """
    spark = pipeline.spark
    raw_db = pipeline.settings.catalog.raw_db
    # Run ids are stable across restarts of one checkpoint (a replay reuses them).
    stream_name = os.path.basename(checkpoint_dir.rstrip("/")) or "stream"

    def process(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.select("path").collect())  # ≤ files_per_batch
        if not paths:
            return
        target_schema = pipeline.store.read(raw_db, EVENTS_TABLE).drop(BUCKET_COL).schema
        # Read by header name; run_batch writes it to the stage table before use.
        stage = csv_src.read_by_name(spark, paths, target_schema, multi_line=multi_line)
        ctx = RunContext(dag_id=dag_id, run_id=f"{stream_name}_batch_{batch_id}",
                         task_id="stream_batch")
        # What arrived, next to what was announced: quality.reconcile_deltas joins the two.
        text = csv_src.read_csv_text(spark, paths, multi_line=multi_line, with_file_path=True)
        arrived = text.groupBy(F.col("_file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("row_count"))
        _announce(pipeline, arrived, ctx, [ARRIVED_EVENT_TYPE], once=True)
        try:
            pipeline.run_batch(stage, ctx, file_keys=paths, build=build,
                               export_root=export_root)
        except (DataQualityError, DeltaLoadError):
            # A failed gate, or a file whose values do not fit the table's types (the
            # strict load rejects it, as a bulk load would).  Any other failure - storage,
            # a lost job - always stops the query, so that the batch is replayed.
            if on_failure != "quarantine":
                raise

    writer = (delta_file_stream(pipeline, delta_dir, files_per_batch)
              .writeStream.foreachBatch(process)
              .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/stream"))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=interval)
    return writer.start()


def announce_manifest(pipeline: Pipeline, manifest: DataFrame, context: RunContext) -> None:
    """Record what the producer of the deltas announces: ``manifest`` has a row for each
    file, with ``file`` (the path the stream sees) and ``row_count``.

    Each file gets an audit row when it was generated and one when it was uploaded;
    the gate compares the latest announcement with the rows that arrive.
    """
    _announce(pipeline, manifest, context, ["DELTA_GENERATED", "DELTA_UPLOADED"])


def _announce(pipeline: Pipeline, files: DataFrame, context: RunContext, events: list[str],
              once: bool = False) -> DataFrame:
    """One audit row for each file (file, row_count) and event, appended as a table."""
    rows = files.select(
        F.lit(context.dag_id).alias("dag_id"), F.lit(context.run_id).alias("run_id"),
        F.lit("announce" if ARRIVED_EVENT_TYPE not in events else context.task_id).alias("task_id"),
        F.regexp_extract("file", "[^/]+$", 0).alias("file_name"), F.col("file").alias("s3_key"),
        F.col("row_count").cast("bigint").alias("row_count"), F.lit("SUCCESS").alias("status"),
        F.explode(F.array(*map(F.lit, events))).alias("event_type"),
        F.current_timestamp().alias("processed_at"))
    bound = csv_src.bind_by_name(rows, FILE_AUDIT_SCHEMA)
    monitoring.append_log(pipeline.store, pipeline.settings.catalog.monitoring_db,
                          monitoring.AUDIT_TABLE, bound, FILE_AUDIT_SCHEMA, once=once)
    return bound


def announce_files(pipeline: Pipeline, delta_dir: str, context: RunContext,
                   event_type: str = "DELTA_GENERATED") -> DataFrame:
    """Record an audit row (``DELTA_GENERATED`` or ``DELTA_UPLOADED``) per delta file.

    The counts are taken by Spark from the files themselves (one aggregate
    grouped by file), standing in for the manifest a delta producer supplies.
    """
    text = csv_src.read_csv_text(pipeline.spark, delta_dir, with_file_path=True, recursive=True)
    per_file = text.groupBy(F.col("_file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("row_count"))
    return _announce(pipeline, per_file, context, [event_type])
