"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and fully executed into Spark's `noop` sink (every row is
produced, nothing is collected to the driver).  A warm-up query runs first, untimed.
Each query runs $BENCH_RUNS times (default 3): `queries` holds the best run,
`first_run` the first (cold: includes code generation for that query's plan).
`--all` times every registered query instead of the headline set.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "event_flags", "hourly_events", "vehicle_scores", "weekday_weekend", "daily_events",
    "nav_speed_histogram", "voice_rpm_stats", "iqr_outliers", "word_count", "latest_state",
    "overspeed_alert", "brake_window", "event_count",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    from autopulse.plans.catalog import QUERIES
    from autopulse.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="autopulse-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    names = list(QUERIES) if "--all" in sys.argv else HEADLINE

    def run(name):
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    run("daily_events")  # warm-up: JVM start-up and code generation
    all_runs, errors = {}, {}
    for name in names:
        try:
            all_runs[name] = [run(name) for _ in range(runs)]
        except Exception as exc:  # noqa: BLE001 - one failing query must not hide the others
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    times = {name: round(min(r), 3) for name, r in all_runs.items()}
    first = {name: round(r[0], 3) for name, r in all_runs.items()}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf_dir,
                      "cpus": int(cpus), "sink": "noop", "stat": f"best of {runs}",
                      "first_run": first, "first_run_total": round(sum(first.values()), 3),
                      **({"errors": errors} if errors else {})}))
    spark.stop()


if __name__ == "__main__":
    main()
