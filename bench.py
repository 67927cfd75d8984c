"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line. Median of BENCH_RUNS after a warm-up."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "decode_messages", "latest_snapshot", "snapshot_ticks", "all_diffs", "daily_avg", "daily_reading_stats",
    "compile_rules", "bind_variables", "arithmetic", "rollup_sum", "cross_device", "chained_rules", "derive_points",
    "encode_envelope", "asof_history", "asof_history_full", "apply_changes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))  # one machine
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from pointloom.plans.queries import ALL

    names = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        seen = []
        for i in range(runs + 1):
            start = time.perf_counter()
            ALL[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seen.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seen[1:]), 3)
        print(name, [round(s, 2) for s in seen], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
