"""A keyed table on files for micro-batches: the last row of each key, written as deltas.

A batch appends the rows of its own keys as one run; a lookup folds the runs, newest last.
Runs are merged by size: a new run takes in its predecessors while they hold at most twice its
rows, so there are at most about log2(keys) of them and a row is rewritten about that often in
its life.  What a batch writes follows the batch, not the number of keys ever seen.

Large runs are dealt into hash buckets (one folder each), and a lookup reads only the buckets
that its keys fall into.  Which runs are live stands in a manifest numbered by batch: batch n
reads the state that batch n - 1 committed, so a batch that runs again after a crash reads the
same state and replaces its own run.  Runs that the last two states don't name are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from autopulse.sinks.manifest import Manifest

BUCKET_ROWS = 1 << 20
MAX_BUCKETS = 4096


class KeyedTable:
    """``schema`` is DDL of the key columns and the values; a NULL key is a key of its own."""

    def __init__(self, spark: SparkSession, base: str, schema: str, keys: Sequence[str],
                 bucket_rows: int = BUCKET_ROWS) -> None:
        self.spark, self.base, self.keys, self.bucket_rows = spark, base.rstrip("/"), list(keys), bucket_rows
        self.schema = spark.createDataFrame([], schema).schema
        self.columns = self.schema.names
        self.manifest = Manifest(spark, base)

    def _runs(self, before: int | None) -> list[dict]:
        state = self.manifest.latest(before)
        if state is None:
            if before:
                raise FileNotFoundError(f"{self.base} has no state before batch {before}")
            return []
        return state["runs"]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")  # a NULL key has a hash, too

    def _read(self, runs: Sequence[dict], buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows of the runs with `_age`, higher in newer runs; only the given of ``MAX_BUCKETS`` buckets."""
        parts = [self.spark.createDataFrame([], self.schema).withColumn("_age", F.lit(0))]
        for age, run in enumerate(runs, 1):
            reader = self.spark.read.schema(self.schema)
            root = f"{self.base}/{run['name']}"
            if buckets is not None and run["buckets"] > 1:
                wanted = sorted({b % run["buckets"] for b in buckets} & set(run["used"]))
                if not wanted:
                    continue
                part = reader.parquet(*[f"{root}/_b={b}" for b in wanted])
            else:
                part = reader.parquet(root)
            parts.append(part.select(*self.columns).withColumn("_age", F.lit(age)))
        return reduce(DataFrame.unionByName, parts)

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in self.columns if c not in self.keys]
        last = F.max_by(F.struct(*values), "_age")
        return rows.groupBy(*self.keys).agg(last.alias("_v")).select(*self.keys, *[F.col(f"_v.{c}").alias(c) for c in values])

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """The rows of the given keys as they were before batch ``before`` (now, if None)."""
        runs = self._runs(before)
        wanted = keys.select(*self.keys).distinct()
        buckets = None
        if any(r["buckets"] > 1 for r in runs):
            buckets = [r[0] for r in wanted.select(self._bucket(MAX_BUCKETS)).distinct().collect()]  # at most MAX_BUCKETS
        renamed = wanted.toDF(*[f"_wanted_{i}" for i in range(len(self.keys))])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_wanted_{i}")) for i, k in enumerate(self.keys)])
        return self._newest(self._read(runs, buckets).join(renamed, same, "left_semi"))

    def all(self, before: int | None = None) -> DataFrame:
        """The last row of every key."""
        return self._newest(self._read(self._runs(before)))

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Commit ``rows`` (one per key, the batch's own keys) as the state after batch ``batch_id``."""
        runs = self._runs(batch_id)
        delta = self._write(rows.select(*self.columns), f"delta-{batch_id}")  # the caller's work runs once
        first, total = len(runs), delta["rows"]
        while first > 0 and runs[first - 1]["rows"] <= 2 * total:
            first -= 1
            total += runs[first]["rows"]
        if first < len(runs) and delta["rows"]:
            merged = self._newest(self._read([*runs[first:], delta]))
            runs = [*runs[:first], self._write(merged, f"run-{batch_id}", total)]
        elif delta["rows"]:
            runs = [*runs, delta]
        self.manifest.commit(batch_id, [r["name"] for r in runs], runs=runs)
        if delta not in runs:
            self.manifest.folder.delete(delta["name"])

    def _write(self, rows: DataFrame, name: str, expected: int = 0) -> dict:
        buckets = 1
        while buckets < MAX_BUCKETS and buckets * self.bucket_rows < expected:
            buckets *= 2
        path = f"{self.base}/{name}"
        if buckets == 1:
            rows.write.mode("overwrite").parquet(path)
            used = [0]
        else:
            dealt = rows.withColumn("_b", self._bucket(buckets)).repartition(buckets, "_b")
            dealt.write.mode("overwrite").partitionBy("_b").parquet(path)
            used = [int(n[3:]) for n in self.manifest.folder.names(name) if n.startswith("_b=")]
        written = self.spark.read.schema(self.schema).parquet(path).count()
        return {"name": name, "rows": written, "buckets": buckets, "used": used}


def upsert_batches(base: str, schema: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """foreachBatch body for update-mode streams: each batch's rows replace those of their keys."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        KeyedTable(batch.sparkSession, base, schema, keys).put(batch, batch_id)
    return fn


def read_upserts(spark: SparkSession, base: str, schema: str, keys: Sequence[str]) -> DataFrame:
    """The last row of every key that ``upsert_batches`` has committed."""
    return KeyedTable(spark, base, schema, keys).all()
