"""Per-record state of vehicles on streams without one task per vehicle (ST2-ST5).

Each micro-batch is one ordered scan (`autopulse.operators.scan`), so a vehicle with many
records in a batch is split over tasks.  What a vehicle carries into the next batch is one
number in a keyed table (`autopulse.streaming.keyed`): the batch looks up its own vehicles,
puts each one's number in front of its records as a row without order value, and commits
the new numbers as a delta under its batch id.  Vehicles that a batch does not name are
neither read (beyond the buckets they share) nor written.  A batch that is run again reads
the same state and replaces its own output: exactly once, also after a restart from the
checkpoint.  No timeout: a vehicle's number stays until its next record.

Records must reach the batches in ``seq`` order; within a batch any order will do.  A NULL
vehicle is a vehicle of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autopulse.operators.scan import DEFAULT_CHUNK, ordered_scan
from autopulse.operators.state import (
    DRIVING_STATUS, DRIVING_UNIT_SECONDS, OVERSPEED_THRESHOLD, is_overspeed, with_alert,
)
from autopulse.session import scratch_table
from autopulse.streaming.batches import write_batch
from autopulse.streaming.keyed import KeyedTable

BatchFn = Callable[[DataFrame, int], None]


CARRY = "vehicle_id string, _carry bigint"


def _carried_batch(records: DataFrame, batch_id: int, out_dir: str, carry_dir: str, seq: str, value: str,
                   scan: Callable[[DataFrame], DataFrame], finish: Callable[[DataFrame], DataFrame]) -> None:
    """One batch: carry rows before the records, ``scan`` adds ``value`` to each row, then output and new carry."""
    spark = records.sparkSession
    carries = KeyedTable(spark, carry_dir, CARRY, ["vehicle_id"])
    records = scratch_table(records, "batch-records")
    known = carries.lookup(records, batch_id)
    rows = (records.withColumns({"_carry": F.lit(0).cast("bigint"), "_real": F.lit(True)})
            .unionByName(known.withColumn("_real", F.lit(False)), allowMissingColumns=True))
    written = write_batch(finish(scan(rows).where("_real").select(*records.columns, value)), out_dir, batch_id)
    last = F.coalesce(F.max_by(value, seq), F.max(value)).cast("bigint")
    carries.put(written.groupBy("vehicle_id").agg(last.alias("_carry")), batch_id)


def _when_real(real: Column, carried: Column) -> Column:
    return F.when(F.col("_real"), real).otherwise(carried)


def overspeed_run_batch(out_dir: str, carry_dir: str, seq: str = "seq", threshold: float = OVERSPEED_THRESHOLD,
                        alert_count: int | None = None, chunk_size: int = DEFAULT_CHUNK) -> BatchFn:
    """foreachBatch body of ST3 on records (vehicle_id, ``seq``, speed); with ``alert_count`` of ST4."""
    count = "consecutive_overspeed_count"

    def scan(rows: DataFrame) -> DataFrame:
        reset = F.col("_real") & ~is_overspeed(F.col("speed"), threshold)
        # the carry row itself counts as one record of a run that reaches back to it
        before = _when_real(F.lit(0).cast("bigint"), F.col("_carry") - 1)
        out = ordered_scan(rows, ["vehicle_id"], [seq, "_real"], sum_of=before, reset_when=reset,
                           chunk_size=chunk_size)
        unbroken = F.col("_run") == F.col("_pos")
        return out.withColumn(count, (F.col("_run") + F.when(unbroken, F.col("_sum")).otherwise(0)).cast("int"))

    def fn(batch: DataFrame, batch_id: int) -> None:
        _carried_batch(batch.select("vehicle_id", seq, "speed"), batch_id, out_dir, carry_dir, seq, count, scan,
                       lambda d: with_alert(d, alert_count) if alert_count else d)
    return fn


def driving_duration_batch(out_dir: str, carry_dir: str, seq: str = "seq", unit_seconds: int = DRIVING_UNIT_SECONDS,
                           chunk_size: int = DEFAULT_CHUNK) -> BatchFn:
    """foreachBatch body of ST2 on records (vehicle_id, ``seq``, status)."""
    total = "total_driving_seconds"

    def scan(rows: DataFrame) -> DataFrame:
        unit = F.when(F.col("status") == DRIVING_STATUS, F.lit(unit_seconds)).otherwise(F.lit(0)).cast("bigint")
        out = ordered_scan(rows, ["vehicle_id"], [seq, "_real"], sum_of=_when_real(unit, F.col("_carry")),
                           chunk_size=chunk_size)
        return out.withColumn(total, F.col("_sum").cast("bigint"))

    def fn(batch: DataFrame, batch_id: int) -> None:
        _carried_batch(batch.select("vehicle_id", seq, "status"), batch_id, out_dir, carry_dir, seq, total, scan,
                       lambda d: d.withColumnRenamed("status", "latest_status"))
    return fn
