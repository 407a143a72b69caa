"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs once to warm up (class loading, code generation), then the best of two timed runs
counts. Results go to the no-op sink, so every row is computed and nothing reaches the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tickloom.queries import QUERIES  # noqa: E402
from tickloom.session import local_session  # noqa: E402

HEADLINE = (
    "bars_hourly",
    "bars_features_target",
    "user_features_full",
    "blocked_window_features",
    "validate_summary",
    "dedup_any",
    "upsert_null_keys",
    "column_summary",
    "drift_metrics_long",
    "mutual_info",
    "corr_pairs",
    "performance_recent",
    "health_metrics",
    "gate_decision",
    "job_quality_metrics",
    "temporal_split",
    "fair_eval",
    "alerts_eval",
)


def run(spark, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf)
        seconds[name] = round(min(run(spark, name, sf) for _ in range(2)), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf).name}))
    spark.stop()


if __name__ == "__main__":
    main()
