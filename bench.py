"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up, then ``$BENCH_RUNS`` timed runs (default 5);
the median is reported.  Every run executes the whole plan through the
``noop`` sink (no driver collection).  Prints one JSON line.

``BENCH_QUERIES=a,b`` limits the set; ``BENCH_EVENT_LOG_DIR=<scratch folder>``
writes Spark's event log there (jobs tagged with the query name) for
``tools/stage_times.py``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from eventmart.session import build_session  # noqa: E402
from eventmart.plans import registry  # noqa: E402

HEADLINE = [
    "events_enriched",
    "agg_events_by_city",
    "agg_groups_by_category",
    "agg_groups_by_topic",
    "agg_events_by_group",
    "events_enriched_hot_keys",
    "dq_stage_checks",
    "dq_not_null",
    "merge_events",
    "merge_events_shuffled",
    "csv_load_typed",
    "encoding_detect",
    "incremental_stream",
]


def run_once(spark, name, sf_dir):
    spark.sparkContext.setJobGroup(name, name)
    t0 = time.perf_counter()
    df = registry.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    conf = {"spark.driver.memory": "16g"}
    event_log = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_log:  # stage and task times for tools/stage_times.py
        os.makedirs(event_log, exist_ok=True)
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log,
                     "spark.eventLog.compress": "false"})
    spark = build_session(f"local[{cpus}]", app_name="eventmart-bench",
                          shuffle_partitions=max(2 * cpus, 8), conf=conf)
    timings = {}
    for name in only or HEADLINE:
        run_once(spark, name, sf_dir)  # warm-up
        samples = [run_once(spark, name, sf_dir) for _ in range(runs)]
        timings[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "warmup": 1,
        "statistic": "median",
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
