"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query runs end to end into the ``noop`` sink (the
whole plan executes, nothing is collected). One untimed warm-up pass over all
queries, then ``$BENCH_REPEAT`` timed runs per query; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldreports.plans.catalog import QUERIES  # noqa: E402
from fieldreports.session import build_session  # noqa: E402

HEADLINE = (
    "enrich",
    "worker_payments",
    "super_payments",
    "pick_needed_calls",
    "queue_refresh",
    "reconcile_survey",
    "event_upsert",
    "directory_upsert",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="fieldreports-bench",
        shuffle_partitions=int(cpus) * 2,
        extra_conf={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: one untimed run of every query (JVM JIT, code generation, file cache)
    for name in HEADLINE:
        run(QUERIES[name](spark, sf_dir))
    times = {}
    for name in HEADLINE:
        samples = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum of median query seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": int(cpus),
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
