"""Shared helpers: table access, lineage cuts in the shared scratch folder, Arrow text buffers."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from autopulse.session import scratch_dir

MIN_LONG = -(1 << 63)
RELEASE_LEAST = 64 << 20  # bytes of shuffle files that are worth collecting the driver's garbage


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back.

    Cuts the lineage in a way that survives a lost executor and fixes values that would
    change when a task is run again.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stored(df, name))


def stored(df: DataFrame, name: str) -> str:
    """``materialise``'s folder, for steps that delete it by ``release`` before the driver ends."""
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return path


def release(spark: SparkSession, *paths: str, shuffled: int = 0) -> None:
    """Delete folders of ``stored``; of ``shuffled`` bytes, also the shuffle files of frames no longer referred to.

    Spark drops those when the driver collects its garbage, by itself after half an hour.
    """
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:  # a Spark Connect client
        return
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    if shuffled >= RELEASE_LEAST:
        spark.range(1).collect()  # the listeners hold the last query that ended
        gc.collect()
        time.sleep(1.2)  # the driver's JVM learns once a second which frames Python has dropped
        jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per context, for clusters that don't have it installed."""
    context = spark.sparkContext
    if getattr(context, "_autopulse_sent", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="autopulse-"), "autopulse.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    context._autopulse_sent = True


def map_batches(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def id_crc32(column: str | Column) -> Column:
    """crc32 of the identifier's decimal text (a null id counts as empty text)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def held_out(column: str | Column, mod: int, remainder: int) -> Column:
    return id_crc32(column) % mod == remainder


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n + 1 offsets of its rows (null: empty)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes, at least one row each."""
    if not batch.num_rows:
        return
    _, offsets = text_buffer(batch.column(text))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = max(start + 1, min(end, batch.num_rows))
        yield batch.slice(start, end - start)
        start = end


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + sizes[i] - 1 of all i, one after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def splitmix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_keys(seed: int) -> np.ndarray:
    """A random odd 64-bit value for each byte value, fixed by ``seed``."""
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Powers:
    """R^i and R^-i modulo 2^64, grown as needed: any substring's polynomial hash from prefix sums."""

    R = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n <= len(self.up):
            return
        n = max(n, 2 * len(self.up))
        inverse = pow(self.R, -1, 1 << 64)
        for name, base in (("up", self.R), ("down", inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums P with P[j] - P[i] = sum of values[k] R^k for i <= k < j."""
        self.reach(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def span(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of values[start:end], the same wherever the span stands."""
        return (prefix[end] - prefix[start]) * self.down[start]


SLOTS = 1 << 20


def slot(column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SLOTS)).cast("int")


def only_slots(rows: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose hash slot holds some key: a superset of the matching rows, found without a shuffle.

    At most ``SLOTS`` integers are broadcast whatever the number of keys; with more keys
    the filter lets more rows through, and the join behind it decides.
    """
    taken = keys.select(slot(F.col(key)).alias("_slot")).distinct()
    return rows.withColumn("_slot", slot(F.col(column))).join(F.broadcast(taken), "_slot", "left_semi").drop("_slot")
