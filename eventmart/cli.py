"""Command-line entry for the flows, for ``spark-submit`` or any scheduler.

    spark-submit eventmart/cli.py setup        --warehouse s3a://bucket/warehouse
    spark-submit eventmart/cli.py load-raw     --warehouse … [--source …] [--normalized …]
    spark-submit eventmart/cli.py build-marts  --warehouse …
    spark-submit eventmart/cli.py export       --warehouse … [--exports …] [--run-stamp …]
    spark-submit eventmart/cli.py batch        --warehouse … --delta <csv files or folder>
                                               [--run-id …] [--expected-rows N]
    spark-submit eventmart/cli.py stream       --warehouse … [--delta-dir …] --checkpoint …
                                               [--available-now] [--quarantine]
    spark-submit eventmart/cli.py announce     --warehouse … --manifest <csv: file,row_count>
                                               [--run-id …]
    spark-submit eventmart/cli.py compact      --warehouse … --table monitoring.dq_results

(On a cluster ship the package with ``--py-files``; locally ``python -m eventmart.cli``.)

``--multi-line`` (load-raw, batch, stream) reads line breaks inside quoted fields.

Paths default to the settings (``EVENTMART_*`` environment variables).  The
session comes from the cluster; ``--master`` is for local runs.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a script (spark-submit eventmart/cli.py …)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventmart.config.settings import load_settings
from eventmart.plans.flows import EVENTS_KEY, EVENTS_TABLE, GROUP_STATE, Pipeline, RunContext
from eventmart.session import build_session
from eventmart.sinks.tables import BUCKET_COL, split_buckets
from eventmart.sources import csv as csv_src


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="eventmart")
    p.add_argument("command", choices=["setup", "load-raw", "build-marts", "export", "batch",
                                        "stream", "announce", "compact", "vacuum", "split-buckets"])
    p.add_argument("--warehouse", required=True, help="root of the table store")
    p.add_argument("--master", default=None)
    p.add_argument("--buckets", type=int, default=64, help="hash buckets of keyed tables")
    p.add_argument("--files-per-bucket", type=int, default=1)
    p.add_argument("--source", default=None, help="landing folder (default: settings)")
    p.add_argument("--normalized", default=None, help="folder for normalised copies")
    p.add_argument("--exports", default=None, help="export root (default: settings)")
    p.add_argument("--run-stamp", default=None)
    p.add_argument("--delta", nargs="*", default=[], help="delta CSV files (batch)")
    p.add_argument("--delta-dir", default=None, help="incoming delta folder (stream)")
    p.add_argument("--run-id", default=None)
    p.add_argument("--expected-rows", type=int, default=None)
    p.add_argument("--checkpoint", default=None, help="stream checkpoint folder")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--quarantine", action="store_true")
    p.add_argument("--no-build", action="store_true", help="merge only, no mart refresh")
    p.add_argument("--manifest", default=None, help="announced files: CSV with file,row_count")
    p.add_argument("--multi-line", action="store_true")
    p.add_argument("--table", default=None, help="database.table to compact")
    p.add_argument("--files", type=int, default=1, help="files after compaction")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    settings = load_settings()
    spark = build_session(args.master)
    pipeline = Pipeline(spark, settings, warehouse_root=args.warehouse,
                        event_buckets=args.buckets, files_per_bucket=args.files_per_bucket)
    out: object = None
    if args.command == "setup":
        pipeline.setup()
    elif args.command == "load-raw":
        out = pipeline.load_raw(source_dir=args.source, normalized_dir=args.normalized,
                                multi_line=args.multi_line)
    elif args.command == "build-marts":
        results = pipeline.build_marts()
        out = [r.asDict() for r in results.collect()]  # ≤ 21 test rows
    elif args.command == "export":
        out = pipeline.export(args.run_stamp, args.exports)
    elif args.command == "batch":
        raw_db = settings.catalog.raw_db
        schema = pipeline.store.read(raw_db, EVENTS_TABLE).drop(BUCKET_COL).schema
        stage = csv_src.read_by_name(spark, args.delta, schema, multi_line=args.multi_line)
        ctx = RunContext(run_id=args.run_id) if args.run_id else RunContext()
        out = pipeline.run_batch(stage, ctx, expected_rows=args.expected_rows,
                                 build=not args.no_build, export_root=args.exports)
    elif args.command == "stream":
        from eventmart.streaming.incremental import start_incremental

        if not args.checkpoint:
            raise SystemExit("--checkpoint is required for stream")
        query = start_incremental(
            pipeline, args.delta_dir or settings.storage.incremental_dir, args.checkpoint,
            available_now=args.available_now, build=not args.no_build,
            export_root=args.exports, multi_line=args.multi_line,
            on_failure="quarantine" if args.quarantine else "raise")
        query.awaitTermination()
    elif args.command == "announce":
        from eventmart.streaming.incremental import announce_manifest

        if not args.manifest:
            raise SystemExit("--manifest is required for announce")
        ctx = RunContext(run_id=args.run_id) if args.run_id else RunContext()
        announce_manifest(pipeline, csv_src.read_csv_text(spark, args.manifest), ctx)
        out = args.manifest
    elif args.command == "compact":
        if not args.table or "." not in args.table:
            raise SystemExit("--table database.table is required for compact")
        database, table = args.table.split(".", 1)
        pipeline.store.compact(database, table, args.files)
        out = args.table
    elif args.command == "vacuum":
        out = pipeline.clean_up()
    elif args.command == "split-buckets":
        # Tables with the events' bucket count are split together.
        cat = settings.catalog
        out = {f"{db}.{t}": split_buckets(pipeline.store, db, t, key)
               for db, t, key in ((cat.raw_db, EVENTS_TABLE, EVENTS_KEY),
                                  (cat.analytics_db, "events_enriched", EVENTS_KEY),
                                  (cat.analytics_db, GROUP_STATE, "group_id"),
                                  (cat.analytics_db, "agg_events_by_group", "group_id"))
               if pipeline.store.exists(db, t)}
    print(json.dumps({"command": args.command, "result": out}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
