"""The reference's jobs as functions over the library's operators.

Batch jobs take input paths and an output base and return what they wrote;
streaming jobs return the started ``StreamingQuery``.  Each step is lazy until its
write; one-row values (mean, fence, counts) are Spark scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autopulse.operators import cabin, clean, joins, lines, state, windows
from autopulse.plans.flagship import run_flagship
from autopulse.session import scratch_table
from autopulse.sinks.files import publish, publish_if_any, write_csv
from autopulse.sources.files import read_cabin_events_json, read_sensor_csv, read_status_parquet, read_telemetry_csv
from autopulse.streaming import batches, carried, runner


# --- batch jobs -----------------------------------------------------------------------------

def flagship_job(spark: SparkSession, input_path: str, output_path: str, **thresholds) -> dict[str, str]:
    """Telemetry CSV -> flags -> hourly / vehicle / weekday-weekend / daily results (CSV + Parquet)."""
    return run_flagship(spark, read_telemetry_csv(spark, input_path), output_path, **thresholds)


def cleaning_report(df: DataFrame) -> DataFrame:
    """Profile plus fence of one sensor frame, as one row."""
    names = ["q1", "q3", "iqr", "lower_bound", "upper_bound"]
    fence = clean.iqr_bounds(df).select(F.struct(*names)).scalar()   # one subquery for all five
    return clean.quality_profile(df).select("*", *[fence.getField(c).alias(c) for c in names])


def cleaning_job(spark: SparkSession, sensors_path: str, output_path: str) -> dict[str, object]:
    """Profile and IQR outliers of the raw and the cleaned sensors; publish outliers (if any) and
    the cleaned data.  Returns the two profile rows' frames and the written paths.

    The CSV is scanned and typed once, into a columnar copy that every step reads; the cleaned
    steps read the published cleaned data.
    """
    raw = scratch_table(read_sensor_csv(spark, sensors_path), "raw-sensors")
    written: dict[str, str] = publish(clean.clean_sensors(raw), output_path, "cleaned_sensors",
                                      parquet_name="cleaned_sensors_parquet")
    cleaned = spark.read.schema(raw.schema).parquet(written["cleaned_sensors:parquet"])
    result: dict[str, object] = {"written": written}
    for name, frame in (("raw", raw), ("cleaned", cleaned)):
        outliers = clean.iqr_outliers(frame)
        prefix = "original" if name == "raw" else name
        written.update(publish_if_any(outliers, output_path, f"{prefix}_outliers_iqr"))
        result |= {f"{name}_profile": cleaning_report(frame), f"{name}_describe": clean.describe(frame),
                   f"{name}_outliers_preview": joins.preview(outliers, 10)}
    return result


def multisource_job(spark: SparkSession, events_path: str, status_path: str, output_path: str) -> dict[str, object]:
    """Cabin events (JSON) joined with vehicle status (Parquet) on the timestamp; row count and preview.

    The published join has every column that some line has, as columns: that takes the inference scan.
    """
    ev, st = read_cabin_events_json(spark, events_path), read_status_parquet(spark, status_path)
    joined = joins.join_events_status(ev, st)
    written = publish(joined, output_path, "joined_events_status")
    return {"written": written, "row_count": joins.join_row_count(ev, st), "preview": joins.preview_join(ev, st, 20)}


def navigation_speed_job(spark: SparkSession, events_path: str, status_path: str, output_path: str) -> str:
    """Speed distribution at navigation starts, written as CSV."""
    hist = joins.navigation_speed_histogram(read_cabin_events_json(spark, events_path, columns={}),
                                            read_status_parquet(spark, status_path))
    return write_csv(hist, f"{output_path.rstrip('/')}/navigation_speed_distribution")


def voice_rpm_job(spark: SparkSession, events_path: str, status_path: str, output_path: str) -> str:
    """Engine-speed statistics at voice commands, written as CSV."""
    stats = joins.voice_rpm_stats(read_cabin_events_json(spark, events_path, columns={}), read_status_parquet(spark, status_path))
    return write_csv(stats, f"{output_path.rstrip('/')}/voice_rpm_analysis")


# --- streaming jobs (records: a Kafka or Kafka-replay stream; lines: a stream with `value`) --

def kafka_raw_job(records: DataFrame, output_path: str, checkpoint: str, **trigger):
    return runner.start_parquet_append(cabin.kafka_envelope(records), output_path, checkpoint, **trigger)


def kafka_json_job(records: DataFrame, output_path: str, checkpoint: str, **trigger):
    return runner.start_parquet_append(cabin.parse_cabin_json(cabin.kafka_values(records)), output_path,
                                       checkpoint, **trigger)


def cabin_etl_job(records: DataFrame, output_path: str, checkpoint: str, **trigger):
    """Kafka cabin messages -> clean rows -> Parquet (5 s trigger by default)."""
    return runner.start_parquet_append(cabin.cabin_etl(records), output_path, checkpoint, **trigger)


def event_count_job(records: DataFrame, output_path: str, checkpoint: str, **trigger):
    """Running count per event type, complete mode; each batch's full table under batch_id=<n>."""
    return runner.start_foreach_batch(cabin.ordered_event_counts(cabin.event_counts(records)), runner.overwrite_snapshot(output_path),
                                      checkpoint, "complete", **trigger)


def raw_lines_job(lines_df: DataFrame, seq: str, output_path: str, text_dir: str, checkpoint: str, **trigger):
    return runner.start_foreach_batch(lines_df, batches.raw_lines_batch(output_path, seq, text_dir), checkpoint,
                                      **trigger)


def word_count_job(lines_df: DataFrame, output_path: str, text_dir: str, checkpoint: str, **trigger):
    return runner.start_foreach_batch(lines_df.select("value"), batches.word_count_batch(output_path, text_dir),
                                      checkpoint, **trigger)


def brake_window_job(lines_df: DataFrame, output_path: str, checkpoint: str, time_col: str | None = "ts",
                     watermark: str | None = None, text_dir: str | None = None,
                     threshold: float = lines.BRAKE_THRESHOLD, window_seconds: int = windows.WINDOW_SECONDS,
                     slide_seconds: int = windows.SLIDE_SECONDS, start_offset_seconds: int = 0, **trigger):
    """Sliding brake counts.  ``time_col=None`` windows by arrival time (the micro-batch's
    processing time), as the reference's DStream job does for plain text lines.  Each
    batch writes its (updated) windows under ``batch_id=<n>``, plus `k=v` text records
    when ``text_dir`` is given; the pane counts live beside the checkpoint."""
    if time_col is None:
        lines_df, time_col = lines_df.withColumn("arrival_time", F.current_timestamp()), "arrival_time"
    panes = batches.brake_pane_stream(lines_df, time_col, threshold, slide_seconds, watermark, start_offset_seconds)
    body = batches.brake_pane_batch(output_path, checkpoint.rstrip("/") + "-panes", threshold, window_seconds,
                                    slide_seconds, text_dir)
    return runner.start_foreach_batch(panes, body, checkpoint, "update", **trigger)


def _carried_job(records: DataFrame, body, output_path: str, checkpoint: str, dump: tuple[str, list[str], str] | None,
                 **trigger):
    """Run a carried-state body per micro-batch; its numbers live beside the checkpoint.  ``dump`` writes K10 text."""
    step = body(output_path, checkpoint.rstrip("/") + "-carry")
    text = batches.sorted_records_batch(*dump) if dump else None

    def fn(batch: DataFrame, batch_id: int) -> None:
        step(batch, batch_id)
        if text:  # the dump reads the written copy: the batch's scan runs once
            text(batches.read_batch(batch.sparkSession, output_path, batch_id), batch_id)
    return runner.start_foreach_batch(records, fn, checkpoint, **trigger)


def latest_state_job(lines_df: DataFrame, seq: str, output_path: str, checkpoint: str, text_dir: str | None = None,
                     **trigger):
    """Per record: vehicle and its latest status (the record's own status, no state needed)."""
    frame = state.latest_state_per_record(lines.parse_status_lines(lines_df), seq)
    if not text_dir:
        return runner.start_parquet_append(frame, output_path, checkpoint, **trigger)
    dump = batches.sorted_records_batch(text_dir, ["vehicle_id", "latest_state"], "latest_state")

    def fn(batch: DataFrame, batch_id: int) -> None:
        dump(batches.write_batch(batch, output_path, batch_id), batch_id)
    return runner.start_foreach_batch(frame, fn, checkpoint, **trigger)


def driving_duration_job(lines_df: DataFrame, seq: str, output_path: str, checkpoint: str,
                         text_dir: str | None = None, **trigger):
    """Per record: the vehicle's driving seconds so far, carried over batches and restarts."""
    names = ["vehicle_id", "latest_status", "total_driving_seconds"]
    return _carried_job(lines.parse_status_lines(lines_df),
                        lambda out, carry: carried.driving_duration_batch(out, carry, seq), output_path, checkpoint,
                        (text_dir, names, "driving_duration") if text_dir else None, **trigger)


def overspeed_run_job(lines_df: DataFrame, seq: str, output_path: str, checkpoint: str,
                      text_dir: str | None = None, threshold: float = state.OVERSPEED_THRESHOLD, **trigger):
    """Per record: how many records in a row were above the threshold."""
    names = ["vehicle_id", "speed", "consecutive_overspeed_count"]
    return _carried_job(lines.parse_speed_lines(lines_df),
                        lambda out, carry: carried.overspeed_run_batch(out, carry, seq, threshold), output_path,
                        checkpoint, (text_dir, names, "overspeed_count") if text_dir else None, **trigger)


def overspeed_alert_job(lines_df: DataFrame, seq: str, output_path: str, checkpoint: str,
                        text_dir: str | None = None, threshold: float = state.OVERSPEED_THRESHOLD,
                        alert_count: int = state.ALERT_COUNT, **trigger):
    """Per record: the run as above, and whether it is long enough for an alert."""
    names = ["vehicle_id", "speed", "consecutive_overspeed_count", "alert"]
    return _carried_job(lines.parse_speed_lines(lines_df),
                        lambda out, carry: carried.overspeed_run_batch(out, carry, seq, threshold, alert_count),
                        output_path, checkpoint, (text_dir, names, "overspeed_alert") if text_dir else None, **trigger)
