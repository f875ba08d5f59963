"""Print the final (adaptive) physical plan of registered queries, condensed.

Usage: python tools/show_plans.py [sf_dir] [name ...]
Each query runs once through the ``noop`` sink; then its executed plan is
printed with only the operators that shape cost: scans (with their read
columns and pushed filters), exchanges, joins, aggregates, unions, writes.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventmart.plans import registry  # noqa: E402
from eventmart.session import build_session  # noqa: E402

KEEP = re.compile(r"(Scan|Exchange|Join|Aggregate|Union|TakeOrdered|Window|Sort |"
                  r"AQEShuffleRead|Generate|Expand|InMemory)")


def condensed(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        m = re.search(r"ReadSchema: struct<([^>]*)>", line)
        if "LocalTableScan" in line or "Scan ExistingRDD" in line:
            head = line[:line.index(line.strip())]
            out.append(f"{head}LocalTableScan (small driver-built relation, e.g. a hot-key list)")
            continue
        if "FileScan" in line or "Scan " in line:
            loc = re.search(r"Location: \w+\([^)]*\)\[([^\]]*)\]", line)
            table = os.path.basename(loc.group(1).split(",")[0]) if loc else "?"
            cols = m.group(1).count(":") if m else "?"
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            head = line[:line.index(line.strip())]
            filters = pushed.group(1) if pushed else ""
            out.append(f"{head}Scan {table} cols={cols} pushed=[{filters}]")
            continue
        out.append(line[:160])
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or ["events_enriched", "agg_events_by_city", "agg_groups_by_category",
                             "agg_groups_by_topic", "agg_events_by_group", "dq_stage_checks",
                             "merge_events", "merge_events_shuffled",
                             "events_enriched_shuffled", "events_enriched_hot_keys"]
    spark = build_session("local[8]", shuffle_partitions=16)
    for name in names:
        df = registry.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}")
        for line in condensed(plan):
            print("    " + line)
        print()
    spark.stop()


if __name__ == "__main__":
    main()
