"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (the whole plan executes, nothing
is collected to the driver). One warm-up run, then the median of $BENCH_RUNS timed runs.
Prints one JSON line: {"metric", "value" (sum of medians), "unit", "queries", "build", "sf"};
"build" is the part of each time that went into building the plan.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_QUERIES (comma list, default all), BENCH_PIPELINE (default 1:
also time the whole bronze -> silver -> marts -> export run as "pipeline_end_to_end").
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    selected = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from lastmile.registry import build, query_names
    from lastmile.session import get_session

    spark = get_session(
        app="lastmile-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    names = selected or query_names()
    medians: dict[str, float] = {}
    builds: dict[str, float] = {}
    for name in names:
        times, built = [], []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            df = build(name, spark, sf_dir)
            t1 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            if i > 0:
                times.append(time.perf_counter() - t0)
                built.append(t1 - t0)
        medians[name] = round(statistics.median(times), 3)
        builds[name] = round(statistics.median(built), 3)
        print(f"{name}: {medians[name]} (built in {builds[name]})", file=sys.stderr)
    if os.environ.get("BENCH_PIPELINE", "1") != "0" and not selected:
        # The whole medallion run (bronze -> silver -> marts -> CSV export, every layer
        # written and read back): the only figure the reference publishes is for this.
        from lastmile.plans.pipeline import run_pipeline
        from lastmile.session import ensure_checkpoint_dir

        base = ensure_checkpoint_dir(spark).rstrip("/")
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            run_pipeline(spark, sf_dir, f"{base}/bench-pipeline-{i}")
            if i > 0:
                times.append(time.perf_counter() - t0)
        medians["pipeline_end_to_end"] = round(statistics.median(times), 3)
        print(f"pipeline_end_to_end: {medians['pipeline_end_to_end']}", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_query_median_sec",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "build": builds,
        "sf": float(m.group(1)) if m else sf_dir,
        "runs": runs,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
