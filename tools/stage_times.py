"""Stage times from a Spark event log (the UI stays off).

usage: python tools/stage_times.py <event-log dir>   (as set by AUTOPULSE_EVENT_LOG)
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(path: str):
    if path.endswith((".zstd", ".zst")):  # Spark 4 compresses event logs with zstd by default
        import io

        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def events(root: str):
    files = [f for f in glob.glob(os.path.join(root, "**", "*"), recursive=True) if os.path.isfile(f)]
    for path in sorted(files):
        for line in _lines(path):
            if line.strip():
                yield json.loads(line)


def main():
    root = sys.argv[1]
    total = 0.0
    for e in events(root):
        if e.get("Event") != "SparkListenerStageCompleted":
            continue
        info = e["Stage Info"]
        secs = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
        total += secs
        print(f"stage {info['Stage ID']:5d}  tasks {info['Number of Tasks']:5d}  {secs:7.3f}s  {info['Stage Name'][:70]}")
    print(f"total stage time {total:.2f}s")


if __name__ == "__main__":
    main()
