"""Per-query job, stage and shuffle totals from a Spark event log.

    D=$(mktemp -d /tmp/run-XXXXXX)
    BENCH_EVENTLOG_DIR=$D BENCH_SF_DIR=/root/testdata/sf0.1 python bench.py
    python scripts/shuffle_report.py $D

Jobs are attributed to queries by the job group bench.py sets per query.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of one event-log file (Spark 4 writes zstd-compressed rolling logs)."""
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


def main() -> None:
    folder = sys.argv[1]
    logs = [os.path.join(d, f) for d, _, files in os.walk(folder) for f in files
            if f.startswith(("events_", "local-", "app-")) and not f.endswith(".crc")]
    stage_query: dict[int, str] = {}
    totals = defaultdict(lambda: {"jobs": 0, "stages": 0, "shuffle_write": 0, "shuffle_read": 0, "input": 0})
    for path in sorted(logs):
        if True:
            for line in _lines(path):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
                    totals[group]["jobs"] += 1
                    for sid in ev.get("Stage IDs", []):
                        stage_query[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    q = stage_query.get(info["Stage ID"], "-")
                    totals[q]["stages"] += 1
                    for acc in info.get("Accumulables", []):
                        name, value = acc.get("Name", ""), acc.get("Value", 0)
                        try:
                            value = int(value)
                        except (TypeError, ValueError):
                            continue
                        if name == "internal.metrics.shuffle.write.bytesWritten":
                            totals[q]["shuffle_write"] += value
                        elif name == "internal.metrics.shuffle.read.remoteBytesRead" or name == "internal.metrics.shuffle.read.localBytesRead":
                            totals[q]["shuffle_read"] += value
                        elif name == "internal.metrics.input.bytesRead":
                            totals[q]["input"] += value
    print("| Query | Jobs | Stages | Input MB | Shuffle write MB | Shuffle read MB |")
    print("| --- | --- | --- | --- | --- | --- |")
    for q, t in sorted(totals.items()):
        mb = lambda b: f"{b / 1e6:.2f}"
        print(f"| `{q}` | {t['jobs']} | {t['stages']} | {mb(t['input'])} | {mb(t['shuffle_write'])} | {mb(t['shuffle_read'])} |")


if __name__ == "__main__":
    main()
