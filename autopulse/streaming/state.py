"""Per-vehicle state on streams (ST1-ST5).

Final-state views stay native aggregates (JVM, partial aggregation).  Per-record
outputs whose value depends on the previous state (running driving time, run
length of overspeed records) use ``applyInPandasWithState`` with one number of
state per vehicle.  Within a micro-batch the records of a vehicle are ordered by the
``seq`` column (arrival order is not kept by the shuffle, T16); across batches the
input is assumed to arrive in ``seq`` order.  No timeout: state lives as long as the
checkpoint (ST5), and a restart on the same checkpoint resumes it (T18).
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from autopulse.operators.state import (
    ALERT_COUNT, DRIVING_STATUS, DRIVING_UNIT_SECONDS, OVERSPEED_THRESHOLD, with_alert,
)

# PySpark's own state serializer concatenates empty frames (a FutureWarning per batch).
warnings.filterwarnings("ignore", category=FutureWarning, message=".*DataFrame concatenation with empty.*")

# Ship the state functions by value: executors then need numpy and pandas only, not this
# package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def latest_state_snapshot(status: DataFrame, seq: str = "seq") -> DataFrame:
    """ST1 final state per vehicle as a streaming aggregate (complete or update mode)."""
    return status.groupBy("vehicle_id").agg(F.max_by("status", seq).alias("latest_state"))


def driving_time_snapshot(status: DataFrame, unit_seconds: int = DRIVING_UNIT_SECONDS) -> DataFrame:
    """ST2 final totals per vehicle as a streaming aggregate."""
    step = F.when(F.col("status") == DRIVING_STATUS, F.lit(unit_seconds)).otherwise(F.lit(0))
    return status.groupBy("vehicle_id").agg(F.sum(step).cast("bigint").alias("total_driving_seconds"))


def _ordered(frames: Iterator[pd.DataFrame], seq: str) -> pd.DataFrame:
    warnings.filterwarnings("ignore", category=FutureWarning, message=".*DataFrame concatenation with empty.*")
    return pd.concat(list(frames), ignore_index=True).sort_values(seq, kind="stable")


def run_lengths(over: np.ndarray, carried: int) -> np.ndarray:
    """Length of the run of True ending at each position, continuing a run of ``carried``."""
    idx = np.arange(len(over))
    last_false = np.maximum.accumulate(np.where(over, -1, idx))
    counts = np.where(last_false >= 0, idx - last_false, carried + idx + 1)
    return np.where(over, counts, 0)


def _overspeed_fn(seq: str, threshold: float):
    def fn(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = _ordered(frames, seq)
        speed = pdf["speed"].to_numpy(dtype="float64")
        over = np.nan_to_num(speed, nan=-np.inf) > threshold  # NaN never counts (T4)
        counts = run_lengths(over, state.get[0] if state.exists else 0)
        state.update((int(counts[-1]),))
        yield pd.DataFrame({"vehicle_id": pdf["vehicle_id"], seq: pdf[seq], "speed": speed,
                            "consecutive_overspeed_count": counts.astype("int32")})
    return fn


def overspeed_run_stream(speeds: DataFrame, seq: str = "seq", threshold: float = OVERSPEED_THRESHOLD) -> DataFrame:
    """ST3 per record on a stream (append mode)."""
    seq_type = speeds.schema[seq].dataType.simpleString()
    out = f"vehicle_id string, {seq} {seq_type}, speed double, consecutive_overspeed_count int"
    return (speeds.select("vehicle_id", seq, "speed").groupBy("vehicle_id")
            .applyInPandasWithState(_overspeed_fn(seq, threshold), out, "count int", "append",
                                    GroupStateTimeout.NoTimeout))


def overspeed_alert_stream(speeds: DataFrame, seq: str = "seq", threshold: float = OVERSPEED_THRESHOLD,
                           alert_count: int = ALERT_COUNT) -> DataFrame:
    """ST4 per record on a stream: ST3 plus TRIGGERED / WAITING."""
    return with_alert(overspeed_run_stream(speeds, seq, threshold), alert_count)


def _driving_fn(seq: str, unit_seconds: int):
    def fn(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = _ordered(frames, seq)
        steps = np.where(pdf["status"].to_numpy() == DRIVING_STATUS, unit_seconds, 0).astype("int64")
        totals = (state.get[0] if state.exists else 0) + np.cumsum(steps)
        state.update((int(totals[-1]),))
        yield pd.DataFrame({"vehicle_id": pdf["vehicle_id"], seq: pdf[seq], "latest_status": pdf["status"],
                            "total_driving_seconds": totals})
    return fn


def driving_duration_stream(status: DataFrame, seq: str = "seq",
                            unit_seconds: int = DRIVING_UNIT_SECONDS) -> DataFrame:
    """ST2 per record on a stream (append mode)."""
    seq_type = status.schema[seq].dataType.simpleString()
    out = f"vehicle_id string, {seq} {seq_type}, latest_status string, total_driving_seconds bigint"
    return (status.select("vehicle_id", seq, "status").groupBy("vehicle_id")
            .applyInPandasWithState(_driving_fn(seq, unit_seconds), out, "total bigint", "append",
                                    GroupStateTimeout.NoTimeout))
