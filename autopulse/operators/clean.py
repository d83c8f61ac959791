"""Sensor cleaning (P2-P5) and profiling.

The column mean enters the row-level plan as a scalar subquery: computed once by Spark,
substituted as a value, no cross join.  Quantiles are found round by round when they are
asked for, so a fence is a pair of plain values in the plan that uses it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from autopulse.session import scratch_table

# The speed cap of the cleaning step and the IQR fence factor.
MAX_SPEED = 200
IQR_FACTOR = 1.5


def filter_max_speed(df: DataFrame, max_speed: int = MAX_SPEED, column: str = "speed") -> DataFrame:
    """Keep `speed < max_speed` (strict; NULL speed dropped)."""
    return df.filter(F.col(column) < max_speed)


def fill_mean(df: DataFrame, column: str = "temp") -> DataFrame:
    """Replace NULL and NaN with the column mean over non-NULL values (0.0 if none).

    One NaN makes the mean NaN, which then fills the gaps (T9).
    """
    mean = df.select(F.avg(column)).scalar()
    filled = F.coalesce(F.nanvl(F.col(column), F.lit(None).cast("double")), mean, F.lit(0.0))
    return df.withColumn(column, filled.cast(df.schema[column].dataType))


def clean_sensors(df: DataFrame, max_speed: int = MAX_SPEED) -> DataFrame:
    """Mean fill first (the mean includes rows the speed cap drops), then the speed cap."""
    return df.transform(fill_mean).transform(filter_max_speed, max_speed)


#: At most so many values are gathered for one quantile; more are narrowed down first.
HELD = 10_000


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], names: Sequence[str] | None = None,
                    buckets: int = 2000, held: int = HELD) -> DataFrame:
    """Exact quantiles as one row: for each p the value of rank max(1, ceil(p * n)); NULL/NaN ignored.

    Equal to ``approxQuantile(column, probs, 0.0)`` without gathering the values in one place.  The
    column is written once to the shared scratch folder, so its source runs once; then, for all p
    together, the range that holds the wanted rank is narrowed round by round:

    1. a mergeable sketch names two values about ``1 / buckets`` of the range's rows below and
       above the rank;
    2. exact counts of the rows below, at, between and above them tell where the rank lies: at one
       of the two (done), or in a part that leaves both out;
    3. a range of at most ``held`` rows is gathered and its value of that rank picked.

    Each round is two aggregates and keeps about ``2 / buckets`` of the rows, which are written apart
    for the next one; the sketch only steers, so its error costs rounds, never the result.
    Returns NULLs on empty input.
    """
    names = list(names or [f"q{i}" for i in range(len(probs))])
    v = F.col("v")
    values = scratch_table(df.select(F.col(column).cast("double").alias("v")).where(v.isNotNull() & ~F.isnan("v")),
                           "quantile-values")
    n = values.count()
    found: dict[int, float | None] = {i: None for i in range(len(probs))}
    # per wanted value: exclusive bounds (None: open), rank inside them, rows inside them
    ranges = {i: (None, None, max(1, math.ceil(p * n)), n) for i, p in enumerate(probs)} if n else {}

    def inside(i: int):
        low, high = ranges[i][:2]
        return (F.lit(True) if low is None else v > low) & (F.lit(True) if high is None else v < high)

    def any_inside():
        return reduce(Column.__or__, [inside(i) for i in ranges])

    while ranges:
        small = [i for i in ranges if ranges[i][3] <= held]
        for i in small:
            found[i] = sorted(r[0] for r in values.where(inside(i)).collect())[ranges[i][2] - 1]
            del ranges[i]
        if not ranges:
            break
        cuts = values.agg(*[F.percentile_approx(
            F.when(inside(i), v), [max(0.0, k / m - 1 / buckets), min(1.0, k / m + 1 / buckets)], 10 * buckets).alias(f"c{i}")
            for i, (_, _, k, m) in ranges.items()]).first()
        counts = []
        for i in ranges:
            a, b = cuts[f"c{i}"]
            counts += [F.count_if(inside(i) & c).alias(f"n{i}_{j}") for j, c in enumerate(
                [v < a, v == a, (v > a) & (v < b), (v == b) & (F.lit(b) > a)])]
        row = values.agg(*counts).first()
        for i, (low, high, k, m) in list(ranges.items()):
            a, b = cuts[f"c{i}"]
            parts = [row[f"n{i}_{j}"] for j in range(4)]
            parts.append(m - sum(parts))
            j = 0
            while k > parts[j]:
                k -= parts[j]
                j += 1
            if j in (1, 3):
                found[i] = a if j == 1 else b
                del ranges[i]
            else:
                ranges[i] = (*{0: (low, a), 2: (a, b), 4: (b, high)}[j], k, parts[j])
        if any(m > held for *_, m in ranges.values()):
            values = scratch_table(values.where(any_inside()), "quantile-range")
    schema = ", ".join(f"{name} double" for name in names)
    return df.sparkSession.createDataFrame([tuple(found[i] for i in range(len(names)))], schema)


def iqr_bounds(df: DataFrame, column: str = "speed", k: float = IQR_FACTOR) -> DataFrame:
    """One row q1, q3, iqr, lower_bound, upper_bound (DOUBLE) from exact quartiles."""
    q = exact_quantiles(df, column, [0.25, 0.75], ["q1", "q3"])
    iqr = F.col("q3") - F.col("q1")
    return q.select("q1", "q3", iqr.alias("iqr"), (F.col("q1") - k * iqr).alias("lower_bound"),
                    (F.col("q3") + k * iqr).alias("upper_bound"))


def iqr_outliers(df: DataFrame, column: str = "speed", k: float = IQR_FACTOR) -> DataFrame:
    """P5: rows outside [q1 - k*iqr, q3 + k*iqr]; NULL values and an all-NULL column give no rows."""
    fence = iqr_bounds(df, column, k).first()
    c = F.col(column)  # plain values: the comparison reaches the scan
    return df.filter((c < F.lit(fence["lower_bound"])) | (c > F.lit(fence["upper_bound"])))


def quality_profile(df: DataFrame, temp: str = "temp", speed: str = "speed", max_speed: int = MAX_SPEED) -> DataFrame:
    """Row count, NULL-temp count and `speed > max_speed` count in one pass."""
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.count_if(F.col(temp).isNull()).alias("temp_null_count"),
                  F.count_if(F.col(speed) > max_speed).alias("speed_over_max_count"))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A7, typed long form: one row per numeric column with count, mean, sample stddev, min, max.

    One aggregate pass over all columns, then a local unpivot of the single result row.
    """
    cols = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)])
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{s}").alias(s)
                                                for s in ("count", "mean", "stddev", "min", "max")])
            for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def describe(df: DataFrame) -> DataFrame:
    """A7 parity form: Spark's own ``describe()`` (string summary table)."""
    return df.describe()
