"""Per-vehicle state over ordered records, batch form (ST1-ST4).

The reference keeps one scalar per vehicle in DStream state and emits one row per
record.  In batch the same values are ordered scans per vehicle (see
``autopulse.operators.scan``); the order key ``seq`` replaces arrival order (T16).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autopulse.operators.scan import DEFAULT_CHUNK, ordered_scan

# Defaults of the state jobs.
OVERSPEED_THRESHOLD = 120.0
ALERT_COUNT = 3
DRIVING_STATUS = "driving"
DRIVING_UNIT_SECONDS = 5
ALERT_ON = "TRIGGERED"
ALERT_OFF = "WAITING"


def _cols(seq) -> list[str]:
    return [seq] if isinstance(seq, str) else list(seq)


def is_overspeed(speed: Column, threshold: float) -> Column:
    """JVM compare: NaN is never above the threshold (T4); a missing speed counts as 0."""
    return F.coalesce((speed > threshold) & ~F.isnan(speed), F.lit(False))


def latest_state(status: DataFrame, seq: str = "seq") -> DataFrame:
    """ST1 final state: the status of each vehicle's last record (partial max_by, skew-safe)."""
    order = _cols(seq)
    key = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return status.groupBy("vehicle_id").agg(F.max_by("status", key).alias("latest_state"))


def latest_state_per_record(status: DataFrame, seq: str = "seq") -> DataFrame:
    """ST1 per record: with no timeout the emitted state is the record's own status."""
    return status.select("vehicle_id", *_cols(seq), F.col("status").alias("latest_state"))


def driving_duration(status: DataFrame, seq: str = "seq", unit_seconds: int = DRIVING_UNIT_SECONDS,
                     chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """ST2: running total of `unit_seconds` per `driving` record, one row per record."""
    step = F.when(F.col("status") == DRIVING_STATUS, F.lit(unit_seconds)).otherwise(F.lit(0)).cast("bigint")
    scanned = ordered_scan(status, ["vehicle_id"], seq, sum_of=step, chunk_size=chunk_size)
    return scanned.select("vehicle_id", *_cols(seq), F.col("status").alias("latest_status"),
                          F.col("_sum").cast("bigint").alias("total_driving_seconds"))


def overspeed_run(speeds: DataFrame, seq: str = "seq", threshold: float = OVERSPEED_THRESHOLD,
                  chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """ST3: consecutive records above the threshold ending at each record (0 when not above)."""
    over = is_overspeed(F.col("speed"), threshold)
    scanned = ordered_scan(speeds, ["vehicle_id"], seq, reset_when=~over, chunk_size=chunk_size)
    return scanned.select("vehicle_id", *_cols(seq), "speed",
                          F.col("_run").cast("int").alias("consecutive_overspeed_count"))


def with_alert(runs: DataFrame, alert_count: int = ALERT_COUNT) -> DataFrame:
    """ST4: TRIGGERED while the run is at least ``alert_count`` long, else WAITING."""
    return runs.withColumn("alert", F.when(F.col("consecutive_overspeed_count") >= alert_count, ALERT_ON)
                           .otherwise(ALERT_OFF))


def overspeed_alert(speeds: DataFrame, seq: str = "seq", threshold: float = OVERSPEED_THRESHOLD,
                    alert_count: int = ALERT_COUNT, chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    return with_alert(overspeed_run(speeds, seq, threshold, chunk_size), alert_count)
