"""Command line entry to the jobs: ``python -m autopulse <job> [args]`` (or via spark-submit).

The session comes from ``SparkSession.builder.getOrCreate()``, so master, memory and
the shared checkpoint folder are whatever the launcher configured.  Streaming jobs
read Kafka (``--kafka``), log files of Kafka records with offsets (``--log``), a Parquet replay
of such records (``--replay``) or text files of lines (``--lines``) and run until stopped, or once over what is available with ``--available-now``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from autopulse.operators import cabin
from autopulse.operators.events import ACCEL_THRESHOLD, DECEL_THRESHOLD, LATERAL_THRESHOLD
from autopulse.operators.lines import BRAKE_THRESHOLD
from autopulse.operators.windows import SLIDE_SECONDS, WINDOW_SECONDS
from autopulse.operators.state import ALERT_COUNT, OVERSPEED_THRESHOLD
from autopulse.plans import jobs
from autopulse.sources.logs import read_kafka_log, read_line_log
from autopulse.streaming import runner
from autopulse.streaming.sources import kafka_lines, read_kafka_replay, read_kafka_stream, read_line_stream

BATCH = {
    "flagship": ("input", "output"),
    "cleaning": ("sensors", "output"),
    "multisource": ("events", "status", "output"),
    "navigation-speed": ("events", "status", "output"),
    "voice-rpm": ("events", "status", "output"),
}
STREAM = ("kafka-raw", "kafka-json", "cabin-etl", "event-count", "latest-state", "driving-duration",
          "overspeed-count", "overspeed-alert", "raw-lines", "word-count", "brake-window")
LINE_JOBS = STREAM[4:]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="autopulse")
    sub = p.add_subparsers(dest="job", required=True)
    for name, positional in BATCH.items():
        sp = sub.add_parser(name)
        for arg in positional:
            sp.add_argument(arg)
        if name == "flagship":
            sp.add_argument("accel", nargs="?", type=float, default=ACCEL_THRESHOLD)
            sp.add_argument("decel", nargs="?", type=float, default=DECEL_THRESHOLD)
            sp.add_argument("lateral", nargs="?", type=float, default=LATERAL_THRESHOLD)
    for name in STREAM:
        sp = sub.add_parser(name)
        src = sp.add_mutually_exclusive_group(required=True)
        src.add_argument("--kafka", help="bootstrap servers")
        src.add_argument("--log", help="directory of Kafka-shaped log files, partition=<n>/*.parquet")
        src.add_argument("--replay", help="Parquet directory of Kafka-shaped records")
        src.add_argument("--lines", help="directory of text files, one message per line, in the order of their paths")
        sp.add_argument("--topic", default="cabin")
        sp.add_argument("--starting-offsets", default="latest")
        sp.add_argument("--output", help="output directory (not needed with --console)")
        sp.add_argument("--console", action="store_true",
                        help="print 20 untruncated rows per batch instead (kafka-raw, kafka-json, event-count)")
        sp.add_argument("--checkpoint", required=True)
        sp.add_argument("--text-dir", help="per-batch sorted record dumps (state jobs)")
        sp.add_argument("--trigger", default=runner.DEFAULT_TRIGGER)
        sp.add_argument("--available-now", action="store_true")
        sp.add_argument("--threshold", type=float, default=OVERSPEED_THRESHOLD)
        sp.add_argument("--alert-count", type=int, default=ALERT_COUNT)
        sp.add_argument("--brake-threshold", type=float, default=BRAKE_THRESHOLD)
        sp.add_argument("--window-seconds", type=int, default=WINDOW_SECONDS)
        sp.add_argument("--slide-seconds", type=int, default=SLIDE_SECONDS)
    return p


def _records(spark, a):
    if a.replay:
        return read_kafka_replay(spark, a.replay)
    if a.log:
        return read_kafka_log(spark, a.log, a.starting_offsets)
    return read_kafka_stream(spark, a.kafka, a.topic, a.starting_offsets)


def main(argv=None, spark: SparkSession | None = None) -> object:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"autopulse-{a.job}").getOrCreate()
    if a.job in BATCH:
        if a.job == "flagship":
            return jobs.flagship_job(spark, a.input, a.output, accel_threshold=a.accel,
                                     decel_threshold=a.decel, lateral_threshold=a.lateral)
        if a.job == "cleaning":
            return jobs.cleaning_job(spark, a.sensors, a.output)["written"]
        fn = {"multisource": jobs.multisource_job, "navigation-speed": jobs.navigation_speed_job,
              "voice-rpm": jobs.voice_rpm_job}[a.job]
        out = fn(spark, a.events, a.status, a.output)
        return out["written"] if isinstance(out, dict) else out
    trig = {"available_now": True} if a.available_now else {"processing_time": a.trigger}
    if a.lines:
        if a.job not in LINE_JOBS or a.console:
            raise SystemExit(f"--lines is for {sorted(LINE_JOBS)}")
        unordered = a.job in ("word-count", "brake-window")
        rec, lines_df = None, read_line_stream(spark, a.lines) if unordered else read_line_log(spark, a.lines)
    else:
        rec = _records(spark, a)
        lines_df = kafka_lines(rec)
    if a.console:
        frames = {"kafka-raw": lambda: cabin.kafka_envelope(rec),
                  "kafka-json": lambda: cabin.parse_cabin_json(cabin.kafka_values(rec)),
                  "event-count": lambda: cabin.ordered_event_counts(cabin.event_counts(rec))}
        if a.job not in frames:
            raise SystemExit(f"--console is for {sorted(frames)}")
        mode = "complete" if a.job == "event-count" else "append"
        runner.run_to_end(runner.start_console(frames[a.job](), mode, checkpoint=a.checkpoint, **trig))
        return {"console": a.job}
    if not a.output:
        raise SystemExit("--output is required")
    state_kw = {"text_dir": a.text_dir, **trig}
    lines_kw = {"text_dir": a.text_dir or a.output.rstrip("/") + "-text", **trig}
    start = {
        "kafka-raw": lambda: jobs.kafka_raw_job(rec, a.output, a.checkpoint, **trig),
        "kafka-json": lambda: jobs.kafka_json_job(rec, a.output, a.checkpoint, **trig),
        "cabin-etl": lambda: jobs.cabin_etl_job(rec, a.output, a.checkpoint, **trig),
        "event-count": lambda: jobs.event_count_job(rec, a.output, a.checkpoint, **trig),
        "latest-state": lambda: jobs.latest_state_job(lines_df, "seq", a.output, a.checkpoint, **state_kw),
        "driving-duration": lambda: jobs.driving_duration_job(lines_df, "seq", a.output, a.checkpoint,
                                                              **state_kw),
        "overspeed-count": lambda: jobs.overspeed_run_job(lines_df, "seq", a.output, a.checkpoint,
                                                          threshold=a.threshold, **state_kw),
        "overspeed-alert": lambda: jobs.overspeed_alert_job(lines_df, "seq", a.output, a.checkpoint,
                                                            threshold=a.threshold, alert_count=a.alert_count,
                                                            **state_kw),
        "raw-lines": lambda: jobs.raw_lines_job(lines_df.select("seq", "value"), "seq", a.output,
                                                lines_kw.pop("text_dir"), a.checkpoint, **lines_kw),
        "word-count": lambda: jobs.word_count_job(lines_df, a.output, lines_kw.pop("text_dir"),
                                                  a.checkpoint, **lines_kw),
        "brake-window": lambda: jobs.brake_window_job(lines_df, a.output, a.checkpoint, time_col=None,
                                                      text_dir=a.text_dir, threshold=a.brake_threshold,
                                                      window_seconds=a.window_seconds,
                                                      slide_seconds=a.slide_seconds, **trig),
    }[a.job]
    runner.run_to_end(start())
    return {"output": a.output}


if __name__ == "__main__":
    print(json.dumps(main(), default=str))
    sys.exit(0)
