"""Job and stage time per code location, read from a Spark event log (no UI needed).

Usage: python tools/event_timings.py <event-log dir or file> [top_n]
Write the log with spark.eventLog.enabled=true and spark.eventLog.dir=<scratch folder>
(bench.py does this when BENCH_EVENT_LOG is set).
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) if os.path.isdir(path) else [path]
    if not files and os.path.isdir(path):
        files = sorted(p for p in glob.glob(os.path.join(path, "*")) if os.path.isfile(p))
    for f in files:
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            yield from stream


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    jobs, execs, stages = {}, {}, 0
    for line in _lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None, (e.get("Properties") or {}).get("spark.sql.execution.id")]
        elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            stages += 1
        elif ev.endswith("SQLExecutionStart"):
            det = e.get("details", "").split("\n")
            frame = next((ln.strip() for ln in det if "starloom" in ln or "__spark_entry__" in ln), det[0].strip())
            execs[str(e["executionId"])] = frame[:140]
    by = collections.defaultdict(lambda: [0.0, 0])
    for start, end, ex in jobs.values():
        if end is None:
            continue
        key = execs.get(str(ex), "(no SQL execution)")
        by[key][0] += (end - start) / 1000
        by[key][1] += 1
    total = sum(v[0] for v in by.values())
    print(f"jobs={len(jobs)} stages={stages} job_seconds={total:.1f}")
    for key, (secs, n) in sorted(by.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"{secs:8.2f}s {n:4d} jobs  {key}")


if __name__ == "__main__":
    main()
