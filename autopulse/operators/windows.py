"""Sliding-window counts (ST6) on event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autopulse.operators.lines import BRAKE_METRIC, BRAKE_THRESHOLD, below_threshold, parse_numeric_tokens

# Default window length and slide of the brake-count job.
WINDOW_SECONDS = 60
SLIDE_SECONDS = 10


def pane_counts(df: DataFrame, time_col: str, slide_seconds: int = SLIDE_SECONDS,
                start_offset_seconds: int = 0) -> DataFrame:
    """Rows per pane [pane_start, pane_start + slide): (pane_start, count), batch and streaming frames alike.

    A row is in one pane, so the aggregate sees each row once and a stream's state is one row per pane.
    """
    pane = F.window(time_col, f"{slide_seconds} seconds", f"{slide_seconds} seconds",
                    f"{start_offset_seconds % slide_seconds} seconds")
    return df.groupBy(pane.alias("w")).agg(F.count(F.lit(1)).alias("count")).select(F.col("w.start").alias("pane_start"), "count")


def windows_of_panes(panes: DataFrame, window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS,
                     metric: str = BRAKE_METRIC) -> DataFrame:
    """Counts per sliding window from counts per pane: each pane is in window / slide windows."""
    if window_seconds % slide_seconds:
        raise ValueError("window_seconds must be a multiple of slide_seconds")
    starts = F.transform(F.sequence(F.lit(0), F.lit(window_seconds // slide_seconds - 1)),
                         lambda i: F.col("pane_start") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), i * slide_seconds))
    return (panes.select(F.explode(starts).alias("window_start"), "count")
            .groupBy("window_start").agg(F.sum("count").cast("bigint").alias("count"))
            .select("window_start",
                    (F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(window_seconds))).alias("window_end"),
                    F.lit(metric).alias("metric"), "count",
                    F.lit(window_seconds).alias("window_seconds"), F.lit(slide_seconds).alias("slide_seconds")))


def window_counts(df: DataFrame, time_col: str, window_seconds: int = WINDOW_SECONDS,
                  slide_seconds: int = SLIDE_SECONDS, metric: str = BRAKE_METRIC,
                  start_offset_seconds: int = 0) -> DataFrame:
    """Count rows per sliding window [start, start + window); windows with no row are absent.

    Rows are counted per pane first; only the pane counts are repeated for their windows.
    Tumbling when slide == window.  Windows are aligned to the epoch plus
    ``start_offset_seconds`` (the reference's DStream windows align to the stream's start
    instead).
    """
    return windows_of_panes(pane_counts(df, time_col, slide_seconds, start_offset_seconds), window_seconds,
                            slide_seconds, metric)


def brake_panes(lines: DataFrame, time_col: str = "ts", threshold: float = BRAKE_THRESHOLD,
                slide_seconds: int = SLIDE_SECONDS, start_offset_seconds: int = 0) -> DataFrame:
    """Numeric tokens of each line below the threshold, counted per pane."""
    brakes = below_threshold(parse_numeric_tokens(lines.select(time_col, "value")), threshold)
    return pane_counts(brakes, time_col, slide_seconds, start_offset_seconds)


def brake_windows(panes: DataFrame, threshold: float = BRAKE_THRESHOLD, window_seconds: int = WINDOW_SECONDS,
                  slide_seconds: int = SLIDE_SECONDS) -> DataFrame:
    """Pane counts of brakes as rows of the brake report."""
    return windows_of_panes(panes, window_seconds, slide_seconds).withColumn("threshold", F.lit(float(threshold)))


def brake_window_counts(lines: DataFrame, time_col: str = "ts", threshold: float = BRAKE_THRESHOLD,
                        window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS,
                        start_offset_seconds: int = 0) -> DataFrame:
    """ST6: numeric tokens of each line below the threshold, counted per sliding window."""
    return brake_windows(brake_panes(lines, time_col, threshold, slide_seconds, start_offset_seconds), threshold,
                         window_seconds, slide_seconds)
