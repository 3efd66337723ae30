"""Stage and job time per query key from a Spark event log.

usage: python tools/event_log_report.py <event log folder or file>
The bench tags jobs with their key (job description); this prints, per key,
the number of jobs, summed job and stage time, and the time spent in
single-task stages (a sign of too few input splits or partitions).
"""
from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = [path] if os.path.isfile(path) else sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)
                                                       + glob.glob(os.path.join(path, "**", "app-*"), recursive=True))
    for f in files:
        with open(f, "rb") as fh:
            raw = fh.read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        yield from raw.decode("utf-8").splitlines()


def main() -> None:
    start, desc, stage_key = {}, {}, {}
    jobs, job_ms, stage_ms, one_task_ms = (collections.Counter() for _ in range(4))
    for line in _lines(sys.argv[1]):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            d = (e.get("Properties") or {}).get("spark.job.description") or "(none)"
            start[e["Job ID"]], desc[e["Job ID"]] = e["Submission Time"], d
            jobs[d] += 1
            for sid in e.get("Stage IDs", []):
                stage_key[sid] = d
        elif ev == "SparkListenerJobEnd" and e["Job ID"] in start:
            job_ms[desc[e["Job ID"]]] += e["Completion Time"] - start[e["Job ID"]]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            ms = si.get("Completion Time", 0) - si.get("Submission Time", 0)
            k = stage_key.get(si["Stage ID"], "(none)")
            stage_ms[k] += ms
            if si["Number of Tasks"] == 1:
                one_task_ms[k] += ms
    print(f"{'key':40s} {'jobs':>5s} {'job_ms':>8s} {'stage_ms':>9s} {'1-task_ms':>9s}")
    for k, _ in stage_ms.most_common():
        print(f"{k:40s} {jobs[k]:5d} {job_ms[k]:8d} {stage_ms[k]:9d} {one_task_ms[k]:9d}")


if __name__ == "__main__":
    main()
