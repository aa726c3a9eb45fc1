"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each query to completion (``noop`` sink: the whole plan executes, nothing
is collected) and prints ONE JSON line with per-query seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sieveflow.plans.catalog import QUERIES  # noqa: E402
from sieveflow.session import local_session  # noqa: E402

HEADLINE = [
    "ingest_status",          # J5 over events: 5 rounds of the parallel fold
    "ingest_documents",       # J5 over documents: one round
    "ingest_with_state",      # J5 with state from an earlier run
    "classify_against_state",  # J3
    "filter_against_state",   # J4
    "channel_stats",          # A1 (+ J5 on events and documents)
    "tracker_statistics",     # A3
    "duplicates_by_reason",   # D16
    "latest_per_key",         # W1
    "latest_n_per_channel",   # L1
    "message_batches",        # D9 (sliced ordered scan)
    "rapid_reposts",          # D3
    "burst_summary",          # D4 + D5
    "cumulative_daily",       # D8
    "route_messages",         # D10
    "stream_ingest",          # S1
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="sieveflow-bench")
    only = [q for q in sys.argv[1:] if q in QUERIES]
    names = only or HEADLINE
    # warm-up of the JVM (JIT, codegen) on the smallest tables, not timed
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.exists(f"{warm_dir}/events.parquet"):
        for q in ("ingest_status", "classify_against_state", "burst_summary"):
            QUERIES[q](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus) if str(cpus).isdigit() else cpus,
        "events_rows": rows,
        "ingest_events_rows_per_sec": round(rows / times["ingest_status"], 1)
        if "ingest_status" in times else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
