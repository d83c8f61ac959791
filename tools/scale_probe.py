"""Scaling probe: run queries on sf0.1 and on a k-times larger events table that Spark
derives from it (ids and times shifted per copy), and print the time ratio.

usage: python tools/scale_probe.py [k] [query ...]
The larger table goes to a fresh folder under the shared scratch root.
"""

from __future__ import annotations

import sys
import time
from functools import reduce

from pyspark.sql import functions as F

sys.path.insert(0, ".")
from autopulse.plans.catalog import QUERIES  # noqa: E402
from autopulse.session import local_session, scratch_dir  # noqa: E402

SRC = "/root/testdata/sf0.1"
DEFAULT = ["overspeed_alert", "driving_duration", "brake_window", "event_count", "latest_state", "iqr_outliers"]


def main():
    k = int(sys.argv[1]) if len(sys.argv) > 1 else 20
    names = sys.argv[2:] or DEFAULT
    spark = local_session(cores=8, shuffle_partitions=32)
    ev = spark.read.parquet(f"{SRC}/events.parquet")
    copies = [ev.select((F.col("event_id") + i * 10_000_000).alias("event_id"),
                        (F.col("ts") + F.expr(f"INTERVAL {31 * i} DAYS")).alias("ts"),
                        "user_id", "event_type", "value", "props") for i in range(k)]
    big = scratch_dir(spark, f"events-x{k}")
    reduce(lambda a, b: a.unionByName(b), copies).repartition(16, "event_id").write.parquet(f"{big}/events.parquet")

    def best(name, sf):
        runs = []
        for _ in range(2):
            t = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        return min(runs)

    for name in names:
        a, b = best(name, SRC), best(name, big)
        print(f"{name:20s} sf0.1 {a:6.2f}s   x{k} {b:6.2f}s   ratio {b / a:4.1f}")


if __name__ == "__main__":
    main()
