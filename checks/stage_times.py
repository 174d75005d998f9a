"""Stage and SQL-job timings from a Spark event log directory.

    python checks/stage_times.py <event-log-dir> [last_n]

Enable the log on a session with spark.eventLog.enabled=true and
spark.eventLog.dir=<scratch folder>.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    with open(path, "rb") as fh:
        raw = fh.read()
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    return raw.decode("utf-8", "replace").splitlines()


def stage_times(log_dir: str):
    files = sorted(f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(f) and not os.path.basename(f).startswith("appstatus"))
    stages = {}
    for f in files:
        for line in _lines(f):
            try:
                e = json.loads(line)
            except json.JSONDecodeError:
                continue
            if e.get("Event") == "SparkListenerStageCompleted":
                s = e["Stage Info"]
                stages[s["Stage ID"]] = (s.get("Submission Time", 0), s.get("Completion Time", 0),
                                         s["Number of Tasks"], s["Stage Name"])
    return sorted(stages.items(), key=lambda kv: kv[1][0])


def main():
    d = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 40
    items = stage_times(d)
    if not items:
        print("no stages")
        return
    t0 = items[0][1][0]
    for sid, (a, b, tasks, name) in items[-n:]:
        print(f"{sid:5d} start={(a - t0) / 1000:8.2f}s dur={(b - a) / 1000:7.2f}s tasks={tasks:4d} {name[:80]}")


if __name__ == "__main__":
    main()
