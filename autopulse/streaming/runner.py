"""Starting streams: triggers, checkpoints and idempotent sinks (K6-K9, ST7, ST8).

Every sink is exactly-once across restarts: the Parquet file sink commits through
its log, and ``foreachBatch`` sinks overwrite a path keyed by the batch id, so a
re-run batch replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from autopulse.sinks.manifest import Manifest

DEFAULT_TRIGGER = "5 seconds"


def _trigger(writer, available_now: bool, processing_time: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time or DEFAULT_TRIGGER)


def start_parquet_append(df: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                         processing_time: str | None = DEFAULT_TRIGGER) -> StreamingQuery:
    """K6: append to a Parquet directory with a checkpoint (exactly once)."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    return _trigger(writer, available_now, processing_time).start()


def start_console(df: DataFrame, output_mode: str = "append", num_rows: int = 20, truncate: bool = False,
                  available_now: bool = False, processing_time: str | None = DEFAULT_TRIGGER,
                  checkpoint: str | None = None) -> StreamingQuery:
    """Print up to ``num_rows`` rows of each micro-batch, untruncated (a bounded preview;
    the console sink brings only those rows to the driver)."""
    writer = (df.writeStream.format("console").outputMode(output_mode)
              .option("numRows", num_rows).option("truncate", str(truncate).lower()))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now, processing_time).start()


def start_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                        output_mode: str = "append", available_now: bool = False,
                        processing_time: str | None = DEFAULT_TRIGGER) -> StreamingQuery:
    """ST8: a callback per micro-batch (batch frame, batch id)."""
    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    return _trigger(writer, available_now, processing_time).start()


def overwrite_batch(base: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to ``<base>/batch_id=<id>``; a re-run batch replaces its own output."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}")
    return fn


def overwrite_snapshot(path: str, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """K8 complete mode: each batch carries the whole result and becomes the live snapshot once it is written.

    The last ``keep`` snapshots stay, older ones are deleted.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        name = f"snapshot-{batch_id}"
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
        Manifest(batch.sparkSession, path, keep).commit(batch_id, [name], snapshot=name)
    return fn


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The complete-mode result of the last committed batch."""
    live = Manifest(spark, path).latest()
    if live is None:
        raise FileNotFoundError(f"{path} holds no committed snapshot")
    return spark.read.parquet(f"{path.rstrip('/')}/{live['snapshot']}")


def read_latest_updates(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """Fold update-mode batches of ``overwrite_batch``: for each key the row of the highest batch id.

    Reads every update ever written; `autopulse.streaming.keyed` keeps the folded table instead.
    """
    df = spark.read.parquet(base)
    values = [c for c in df.columns if c not in set(keys) | {"batch_id"}]
    latest = F.max_by(F.struct(*values), "batch_id")
    return df.groupBy(*keys).agg(latest.alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an availableNow query and surface its failure."""
    query.awaitTermination()
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"stream {query.name or query.id} failed: {err}")
