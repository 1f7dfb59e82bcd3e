"""Summarise stage times from a Spark event log folder (no UI needed).

    python tools/stage_times.py EVENT_LOG_DIR [top_n]

Prints the slowest stages: id, tasks, seconds, shuffle read/write MB, name.
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    elif not path.endswith((".lz4", ".snappy", ".lzf")):
        with open(path, encoding="utf-8") as fh:
            yield from fh


def stages(folder: str):
    for path in glob.glob(os.path.join(folder, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        for line in _lines(path):
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerStageCompleted":
                continue
            info = ev["Stage Info"]
            if "Completion Time" not in info or "Submission Time" not in info:
                continue
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            yield {
                "id": info["Stage ID"],
                "tasks": info["Number of Tasks"],
                "sec": (info["Completion Time"] - info["Submission Time"]) / 1000,
                "shuffle_read_mb": int(acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0)
                                       + acc.get("internal.metrics.shuffle.read.localBytesRead", 0)) / 2**20,
                "shuffle_write_mb": int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0)) / 2**20,
                "name": info["Stage Name"][:60],
            }


def main(argv):
    folder = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 15
    rows = sorted(stages(folder), key=lambda r: -r["sec"])
    print(f"{len(rows)} stages, {sum(r['sec'] for r in rows):.1f} s in total")
    for r in rows[:top]:
        print(f"{r['id']:6d} {r['tasks']:6d} {r['sec']:7.2f}s "
              f"rd {r['shuffle_read_mb']:8.2f}MB wr {r['shuffle_write_mb']:8.2f}MB  {r['name']}")


if __name__ == "__main__":
    main(sys.argv)
