"""Longest stages from a Spark event log folder (as written with BENCH_EVENT_LOG).

usage: python scripts/stage_times.py EVENT_LOG_DIR [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def read_events(path: str):
    with open(path, "rb") as fh:
        data = fh.read()
    if path.endswith(".zstd"):
        import zstandard
        import io
        data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    for line in data.decode("utf-8", "ignore").splitlines():
        try:
            e = json.loads(line)
        except ValueError:
            continue
        if isinstance(e, dict):
            yield e


def main(argv):
    folder, top = argv[0], int(argv[1]) if len(argv) > 1 else 15
    stages = []
    for f in glob.glob(os.path.join(folder, "**", "events_*"), recursive=True):
        for e in read_events(f):
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if "Completion Time" in si and "Submission Time" in si:
                    stages.append((si["Completion Time"] - si["Submission Time"],
                                   si["Number of Tasks"], si["Stage Name"]))
    stages.sort(reverse=True)
    print(f"{len(stages)} stages, {sum(s[0] for s in stages)} ms in total")
    for ms, tasks, name in stages[:top]:
        print(f"{ms:7d} ms  {tasks:5d} tasks  {name[:90]}")


if __name__ == "__main__":
    main(sys.argv[1:])
