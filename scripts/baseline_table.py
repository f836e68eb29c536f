"""Markdown table of our own timings: one row per registered query.

    python scripts/baseline_table.py /root/testdata/sf0.1 8

Seconds cover the whole query (its writes included) with the result executed
by the ``noop`` sink; rows out is a separate count of the same result.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablewright.plans.registry import QUERIES  # noqa: E402
from tablewright.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cores = sys.argv[2] if len(sys.argv) > 2 else "8"
    spark = local_session(cores=cores, shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("scan_parquet", "load_job", "merge_upsert", "write_dynamic_partition"):  # warm-up, not timed
        QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print(f"| Query | Seconds | Rows out | Cores | Shuffle partitions |")
    print("| --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        t0 = time.perf_counter()
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        secs = time.perf_counter() - t0
        print(f"| `{name}` | {secs:.2f} | {df.count()} | {cores} | {cores} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
