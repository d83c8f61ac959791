"""Flagship aggregates over flagged telemetry (A1-A4).

Each is one hash aggregate with map-side partial aggregation, so a hot vehicle or
hour collapses to one partial row per input partition before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Weekday names by dayofweek number (1 = Sunday ... 7 = Saturday).
WEEKDAY_NAMES = ["周日", "周一", "周二", "周三", "周四", "周五", "周六"]

FLAG_SUMS = {
    "hard_accel_count": "is_hard_accel",
    "hard_decel_count": "is_hard_decel",
    "hard_turn_count": "is_hard_turn",
}


def _flag_sums(names=FLAG_SUMS):
    return [F.sum(src).cast("bigint").alias(dst) for dst, src in names.items()]


def hourly_events(df: DataFrame) -> DataFrame:
    """Flag sums and row count by hour of day; a NULL timestamp is its own (first) group."""
    return (df.groupBy(F.hour("timestamp").alias("hour"))
            .agg(*_flag_sums(), F.count(F.lit(1)).alias("total_records"))
            .orderBy("hour"))


# score = 100 * exp(-(0.02 accel + 0.03 decel + 0.015 turn)), 2 decimals, floor 0;
# rates are events per 1000 rows, 2 decimals.
SCORE_EXPR = "100 * exp(- (accel_count * 0.02 + decel_count * 0.03 + turn_count * 0.015))"


def vehicle_scores(df: DataFrame) -> DataFrame:
    """Flag sums per vehicle and risk_score = max(round(100*exp(-(.02a+.03d+.015t)), 2), 0).

    100 is the safest score.  Sorted by score descending, vehicle_id as tie-break.
    """
    sums = _flag_sums({"accel_count": "is_hard_accel", "decel_count": "is_hard_decel",
                       "turn_count": "is_hard_turn"})
    return (df.groupBy("vehicle_id").agg(*sums)
            .withColumn("risk_score", F.round(F.expr(SCORE_EXPR), 2))
            .withColumn("risk_score", F.greatest(F.col("risk_score"), F.lit(0)).cast("double"))
            .orderBy(F.desc("risk_score"), F.asc("vehicle_id")))


def _day_type():
    # NULL weekday makes `between` NULL, so such rows count as weekend.
    return F.when(F.dayofweek("timestamp").between(2, 6), "weekday").otherwise("weekend")


def weekday_weekend_events(df: DataFrame) -> DataFrame:
    """Weekday (Mon-Fri) vs weekend: flag sums, row count and events per 1000 rows (2 decimals)."""
    total = F.count(F.lit(1))
    rates = [F.round(F.sum(src) * 1000 / total, 2).alias(name)
             for name, src in (("accel_rate_per_1000", "is_hard_accel"),
                               ("decel_rate_per_1000", "is_hard_decel"),
                               ("turn_rate_per_1000", "is_hard_turn"))]
    return (df.groupBy(_day_type().alias("day_type"))
            .agg(*_flag_sums(), total.alias("total_records"), *rates)
            .orderBy("day_type"))


def weekday_name(num_col):
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.when(num_col.between(1, 7), F.element_at(names, num_col))


def daily_events(df: DataFrame) -> DataFrame:
    """Flag sums per day of week (number 1=Sunday and name)."""
    num = F.dayofweek("timestamp")
    return (df.groupBy(num.alias("weekday_num"), weekday_name(num).alias("weekday_name"))
            .agg(*_flag_sums())
            .orderBy("weekday_num"))
