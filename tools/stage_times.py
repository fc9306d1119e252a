"""Summarize stage and task times from a Spark event log (no UI, no server).

Usage: python tools/stage_times.py <event log file or folder> [top N]

Prints, per job description, the number of stages and tasks, total stage
wall time, and the slowest stages with task-time skew (max / median task).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
from collections import defaultdict


def read_events(path: str):
    """Events of a log file, or of every file below a folder (rolling logs are folders)."""
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if not f.startswith(("appstatus", ".")))
    for f in files:
        if f.endswith(".zstd"):          # Spark 4 compresses event logs with zstd by default
            import io

            import zstandard
            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True),
                                        encoding="utf-8")
                lines = list(text)
        else:
            with open(f) as fh:
                lines = list(fh)
        for line in lines:
            if line.strip():
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    task_times: dict[tuple[int, int], list[int]] = defaultdict(list)
    stages = {}
    for e in read_events(path):
        ev = e.get("Event")
        if ev == "SparkListenerTaskEnd":
            info = e["Task Info"]
            task_times[(e["Stage ID"], e["Stage Attempt ID"])].append(info["Finish Time"] - info["Launch Time"])
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            dur = (si.get("Completion Time") or 0) - (si.get("Submission Time") or 0)
            stages[(si["Stage ID"], si["Stage Attempt ID"])] = (si["Stage Name"], si["Number of Tasks"], dur)
    total = sum(d for _, _, d in stages.values())
    print(f"stages: {len(stages)}, tasks: {sum(n for _, n, _ in stages.values())}, stage wall time: {total / 1000:.2f}s")
    rows = []
    for key, (name, n, dur) in stages.items():
        t = task_times.get(key, [])
        skew = (max(t) / statistics.median(t)) if t and statistics.median(t) > 0 else 1.0
        rows.append((dur, key[0], n, skew, name))
    print(f"{'ms':>8} {'stage':>6} {'tasks':>6} {'skew':>6}  name")
    for dur, sid, n, skew, name in sorted(rows, reverse=True)[:top]:
        print(f"{dur:8d} {sid:6d} {n:6d} {skew:6.1f}  {name[:70]}")


if __name__ == "__main__":
    main()
