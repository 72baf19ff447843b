"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` picks the tables, ``BENCH_CPUS`` the cores. Each query runs twice, the better time counts;
results go to Spark's no-op sink, except that stored targets and streams write their own files.
"""

from __future__ import annotations

import json
import os
import time

from check import session
from tidemark.queries import QUERIES

HEADLINE = [
    "r04_decode_rows", "r05_schema_changes", "r07_snapshot_plus_log", "f07_route_fanout", "s01_day_bucket", "s09_metadata_columns",
    "s16_typed_cast", "w13_current_state", "w13_current_state_by_day", "w01_upsert_batches", "w02_fanout_write",
    "w07_partition_move", "t02_stream_drain", "d01_missing_days",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
