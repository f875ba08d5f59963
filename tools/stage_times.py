"""Summarise stage times from a Spark event log (written by bench.py).

Usage: python tools/stage_times.py <event-log-file-or-folder>
Per query (job group): jobs, stages, tasks, summed stage wall time, shuffle
bytes written and the slowest stages with their task counts — enough to see
which exchange or scan dominates, without the Spark UI.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def events(path):
    """Events of every log file below ``path`` (Spark 4 writes rolling log folders)."""
    files = [path]
    if os.path.isdir(path):
        files = sorted(os.path.join(root, f) for root, _, names in os.walk(path)
                       for f in names if f.startswith("events_") or f.endswith(".json")
                       or not os.path.basename(root).startswith("eventlog"))
    for f in files:
        with open(f, "rb") as fh:
            raw = fh.read()
        if f.endswith((".zst", ".zstd")):
            import io

            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(
                io.BytesIO(raw), read_across_frames=True).read()
        for line in raw.decode("utf-8").splitlines():
            if line.strip():
                yield json.loads(line)


def main():
    path = sys.argv[1]
    job_group, stage_group = {}, {}
    stages = {}
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
            job_group[e["Job ID"]] = group
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            sid = info["Stage ID"]
            took = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
            shuffle = 0
            for acc in info.get("Accumulables", []):
                if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten":
                    shuffle = int(acc.get("Value", 0))
            stages[sid] = (info.get("Stage Name", "")[:60], info.get("Number of Tasks", 0),
                           took, shuffle)
    per = defaultdict(list)
    for sid, st in stages.items():
        per[stage_group.get(sid, "-")].append((sid,) + st)
    for group, sts in sorted(per.items()):
        total = sum(s[3] for s in sts)
        tasks = sum(s[2] for s in sts)
        shuffled = sum(s[4] for s in sts)
        print(f"{group:28s} stages={len(sts):4d} tasks={tasks:6d} stage_s={total:7.2f} "
              f"shuffle_MB={shuffled / 1e6:8.1f}")
        for s in sorted(sts, key=lambda s: -s[3])[:3]:
            print(f"    stage {s[0]:5d} {s[3]:6.2f}s tasks={s[2]:4d} {s[1]}")


if __name__ == "__main__":
    main()
