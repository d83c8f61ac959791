"""Per-micro-batch line jobs (P19, A11, K9) and the event-time brake window stream (ST6).

The reference collects each batch to the driver and writes one local file; here each
batch is written by the executors to a directory keyed by the batch id (idempotent on
re-run), with the batch time inside the records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from autopulse.functions import batch_time_text, format_record, to_utc_wall_clock, utc_instant
from autopulse.operators.lines import (
    BRAKE_METRIC, BRAKE_THRESHOLD, below_threshold, parse_numeric_tokens, word_count,
)
from autopulse.operators.scan import DEFAULT_CHUNK, ordered_scan
from autopulse.operators.windows import (
    SLIDE_SECONDS, WINDOW_SECONDS, brake_windows, pane_counts, windows_of_panes,
)
from autopulse.session import scratch_table
from autopulse.streaming.keyed import KeyedTable


def write_batch_text(records: DataFrame, out_dir: str, prefix: str, batch_id: int, single_file: bool = False) -> str:
    """K9: a batch's formatted records as text under ``<out_dir>/<prefix>_<batch id>``; empty batch writes nothing."""
    path = f"{out_dir.rstrip('/')}/{prefix}_{batch_id:09d}"
    if records.isEmpty():
        return ""
    (records.coalesce(1) if single_file else records).write.mode("overwrite").text(path)
    return path


def _batch_time():
    return batch_time_text(to_utc_wall_clock(F.current_timestamp()))


def number_records(batch: DataFrame, seq: str, value: str = "value", by=(), chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """record_no 1..n in ``seq`` order, per micro-batch, or per value of ``by`` in batch form.

    A chunked scan (no single-task sort of a whole batch).
    """
    by = list(by)
    scanned = ordered_scan(batch.select(*by, seq, value), by, seq, chunk_size=chunk_size)
    return scanned.select(*by, seq, F.col("_pos").alias("record_no"), F.col(value).alias("raw_data"))


def write_batch(result: DataFrame, out_dir: str, batch_id: int) -> DataFrame:
    """Write one micro-batch's result under ``<out_dir>/batch_id=<id>`` and return the written copy.

    Later outputs of the batch (text records, emptiness checks) read that copy, so the
    batch's work runs once and every output shows the same batch time.
    """
    path = f"{out_dir.rstrip('/')}/batch_id={batch_id}"
    result.write.mode("overwrite").parquet(path)
    return read_batch(result.sparkSession, out_dir, batch_id)


def read_batch(spark: SparkSession, out_dir: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")


def raw_lines_batch(out_dir: str, seq: str, text_dir: str | None = None,
                    chunk_size: int = DEFAULT_CHUNK) -> Callable[[DataFrame, int], None]:
    """foreachBatch body of the raw-line job: numbered records as Parquet (+ K9 text files)."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        numbered = number_records(batch, seq, chunk_size=chunk_size).withColumn("batch_time", _batch_time())
        written = write_batch(numbered, out_dir, batch_id)
        if text_dir:
            write_batch_text(written.orderBy("record_no").select(format_record("batch_time", "record_no", "raw_data")),
                             text_dir, "raw_stream", batch_id)
    return fn


def word_count_batch(out_dir: str, text_dir: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch body of A11: counts of this batch only (not cumulative)."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        counts = word_count(batch.select("value")).withColumn("batch_time", _batch_time())
        written = write_batch(counts, out_dir, batch_id)
        if text_dir:
            write_batch_text(written.orderBy("word").select(format_record("batch_time", "word", "count")),
                             text_dir, "wordcount", batch_id)
    return fn


def _brake_events(lines: DataFrame, time_col: str, threshold: float, watermark: str | None) -> DataFrame:
    """Tokens below the threshold with their time `_t` as an instant: NTZ times are read as UTC, whatever the session zone."""
    ntz = isinstance(lines.schema[time_col].dataType, TimestampNTZType)
    t = utc_instant(time_col) if ntz else F.col(time_col).cast("timestamp")
    brakes = below_threshold(parse_numeric_tokens(lines.select(t.alias("_t"), "value")), threshold)
    return brakes.withWatermark("_t", watermark) if watermark else brakes


def brake_pane_stream(lines: DataFrame, time_col: str = "ts", threshold: float = BRAKE_THRESHOLD,
                      slide_seconds: int = SLIDE_SECONDS, watermark: str | None = None,
                      start_offset_seconds: int = 0) -> DataFrame:
    """ST6 on a stream, first half: brakes per pane of ``slide_seconds`` (pane_start TIMESTAMP, count).

    By default no event is late and every pane's state is kept, as in the reference, which has
    no rule for late data.  A ``watermark`` bounds the state and silently drops events that come
    later than it allows: the caller's decision.
    """
    return pane_counts(_brake_events(lines, time_col, threshold, watermark), "_t", slide_seconds, start_offset_seconds)


PANES = "pane_start timestamp, count bigint"


def _report(panes: DataFrame, threshold: float, window_seconds: int, slide_seconds: int) -> DataFrame:
    found = brake_windows(panes, threshold, window_seconds, slide_seconds)
    return found.withColumns({c: to_utc_wall_clock(c) for c in ("window_start", "window_end")})


def brake_pane_batch(out_dir: str, panes_dir: str, threshold: float = BRAKE_THRESHOLD,
                     window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS,
                     text_dir: str | None = None) -> Callable[[DataFrame, int], None]:
    """ST6, second half: foreachBatch body for ``brake_pane_stream`` in update mode.

    The changed panes go into a keyed table; the windows that hold one of them are built from their
    panes there and written as the batch's result (and as `k=v` text with ``text_dir``).
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        table = KeyedTable(batch.sparkSession, panes_dir, PANES, ["pane_start"])
        changed = scratch_table(batch, "changed-panes")
        table.put(changed, batch_id)
        touched = windows_of_panes(changed, window_seconds, slide_seconds).select("window_start")
        steps = F.sequence(F.lit(0), F.lit(window_seconds // slide_seconds - 1))
        needed = touched.select(F.explode(F.transform(steps, lambda i: F.col("window_start") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), i * slide_seconds))).alias("pane_start"))
        panes = table.lookup(needed, batch_id + 1)
        result = _report(panes, threshold, window_seconds, slide_seconds).join(
            touched.select(to_utc_wall_clock("window_start").alias("window_start")), "window_start", "left_semi")
        written = write_batch(result.withColumn("batch_time", _batch_time()), out_dir, batch_id)
        if text_dir:
            write_batch_text(written.orderBy("window_start").select(format_record(*BRAKE_RECORD)), text_dir,
                             "brake_window", batch_id)
    return fn


def read_brake_windows(spark: SparkSession, panes_dir: str, threshold: float = BRAKE_THRESHOLD,
                       window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS) -> DataFrame:
    """All windows of the panes committed so far (times as UTC wall clocks)."""
    return _report(KeyedTable(spark, panes_dir, PANES, ["pane_start"]).all(), threshold, window_seconds, slide_seconds)


def brake_window_stream(lines: DataFrame, time_col: str = "ts", threshold: float = BRAKE_THRESHOLD,
                        window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS,
                        watermark: str | None = None, start_offset_seconds: int = 0) -> DataFrame:
    """ST6 as one streaming frame of windows, for sinks that take a frame (console, Parquet, complete mode).

    Each brake enters window / slide groups here, as a stream can't aggregate its panes again;
    ``brake_pane_stream`` counts each once.  Late events as there.
    """
    brakes = _brake_events(lines, time_col, threshold, watermark)
    w = F.window("_t", f"{window_seconds} seconds", f"{slide_seconds} seconds",
                 f"{start_offset_seconds % slide_seconds} seconds")
    return brakes.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("count")).select(
        to_utc_wall_clock("w.start").alias("window_start"), to_utc_wall_clock("w.end").alias("window_end"),
        F.lit(BRAKE_METRIC).alias("metric"), "count", F.lit(window_seconds).alias("window_seconds"),
        F.lit(slide_seconds).alias("slide_seconds"), F.lit(float(threshold)).alias("threshold"))


def sorted_records_batch(out_dir: str, names, prefix: str) -> Callable[[DataFrame, int], None]:
    """Per micro-batch, the rows formatted as `k=v` records, sorted, written as text.

    The reference collected each batch and printed it sorted; here the executors sort
    (range-partitioned) and write one directory per batch id.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        records = batch.select(format_record(*names).alias("value")).orderBy("value")
        write_batch_text(records, out_dir, prefix, batch_id)
    return fn


BRAKE_RECORD = ["batch_time", "window_start", "window_end", "metric", "count", "window_seconds", "slide_seconds",
                "threshold"]
