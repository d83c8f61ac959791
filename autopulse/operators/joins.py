"""Cabin events x vehicle status on equal timestamps (J1) and the analyses over it.

The reference joins USING(timestamp) with no vehicle key: a many-to-many join whose
output per timestamp is (#events x #status rows).  Where only an aggregate of the
join is needed, both sides are first reduced to one row per timestamp (and bucket),
so the join never materialises those pairs and a hot timestamp costs one row per
side instead of n x m: count(join) = sum over t of n_events(t) * n_status(t).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from autopulse.functions import bucket, safe_timestamp
from autopulse.operators.events import NAVIGATION_START, VOICE_COMMAND

# Speed histogram edges and labels.
SPEED_EDGES = [30, 60, 90]
SPEED_LABELS = ["0-30km/h", "30-60km/h", "60-90km/h", "90km/h+"]


def as_instants(events: DataFrame, status: DataFrame, key: str = "timestamp") -> bool:
    """Whether the sides meet as instants: one of them has a zoned TIMESTAMP.  Else as wall clocks."""
    return any(isinstance(df.schema[key].dataType, TimestampType) for df in (events, status))


def normalise_key(df: DataFrame, key: str = "timestamp", instants: bool = False) -> DataFrame:
    """The key as TIMESTAMP_NTZ, or as TIMESTAMP with ``instants``; text that is no time becomes NULL.

    Instants stay what they are: in an hour that the session zone's clocks show twice, two of them
    share a wall clock and must not meet.  Wall clocks and texts without a zone are read in the
    session zone where the other side has instants.
    """
    dt = df.schema[key].dataType
    if isinstance(dt, StringType):
        return df.withColumn(key, F.col(key).try_cast("timestamp") if instants else safe_timestamp(key))
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return df.withColumn(key, F.col(key).cast("timestamp" if instants else "timestamp_ntz"))
    raise TypeError(f"join key {key} must be a timestamp or text, got {dt}")


def normalise_keys(events: DataFrame, status: DataFrame, key: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    instants = as_instants(events, status, key)
    return normalise_key(events, key, instants), normalise_key(status, key, instants)


def _check_ambiguous(events: DataFrame, status: DataFrame, key: str) -> None:
    shared = (set(events.columns) & set(status.columns)) - {key}
    if shared:
        raise ValueError(f"columns on both sides besides {key!r}: {sorted(shared)}; rename one side first (T14)")


def join_events_status(events: DataFrame, status: DataFrame, key: str = "timestamp") -> DataFrame:
    """Inner equi-join on the timestamp; NULL keys drop; the key appears once.

    The join strategy (broadcast / sort-merge, skew splits) is left to Catalyst + AQE.
    """
    _check_ambiguous(events, status, key)
    e, s = normalise_keys(events, status, key)
    return e.join(s, [key], "inner")


def _event_counts(events: DataFrame, event_type: str, key: str, instants: bool) -> DataFrame:
    return (normalise_key(events.filter(F.col("event_type") == event_type).select(key), key, instants)
            .where(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias("n_events")))


def joined_event_rows(events: DataFrame, status: DataFrame, event_type: str, columns, key: str = "timestamp") -> DataFrame:
    """The join filtered to one event type and projected to status columns.

    Events are pre-counted per timestamp, so the join has one row per key on that side;
    each status row is then repeated once per matching event (the multiset the
    reference produces), without a many-to-many join.
    """
    instants = as_instants(events, status, key)
    counts = _event_counts(events, event_type, key, instants)
    cols = [c for c in columns if c != key]
    s = normalise_key(status.select(key, *cols), key, instants)
    return repeat_rows(s.join(counts, [key], "inner"), "n_events").select(key, *cols)


def repeat_rows(df: DataFrame, times: str, block: int = 4096) -> DataFrame:
    """Each row ``times`` times, generated in two levels so no array exceeds ``block`` (+ n/block) elements."""
    n = F.col(times)
    block_ids = F.when(n > 0, F.sequence(F.lit(0), F.ceil(n / block).cast("long") - 1))
    blocks = df.select("*", F.explode(block_ids).alias("_blk"))
    size = F.least(F.lit(block), n - F.col("_blk") * block).cast("int")
    return blocks.select("*", F.explode(F.array_repeat(F.lit(0), size)).alias("_rep")).drop("_blk", "_rep")


def navigation_events(events: DataFrame, status: DataFrame) -> DataFrame:
    """(timestamp, speed) of status rows joined to NavigationStart events."""
    return joined_event_rows(events, status, NAVIGATION_START, ["timestamp", "speed"])


def voice_events(events: DataFrame, status: DataFrame) -> DataFrame:
    """(timestamp, rpm) of status rows joined to VoiceCommand events."""
    return joined_event_rows(events, status, VOICE_COMMAND, ["timestamp", "rpm"])


def navigation_speed_histogram(events: DataFrame, status: DataFrame, key: str = "timestamp") -> DataFrame:
    """A5: joined NavigationStart rows counted per speed bucket; empty buckets absent; NULL/NaN speed -> last bucket."""
    instants = as_instants(events, status, key)
    counts = _event_counts(events, NAVIGATION_START, key, instants)
    per_bucket = (normalise_key(status.select(key, "speed"), key, instants)
                  .groupBy(key, bucket("speed", SPEED_EDGES, SPEED_LABELS).alias("speed_range"))
                  .agg(F.count(F.lit(1)).alias("n_status")))
    return (per_bucket.join(counts, [key], "inner")
            .groupBy("speed_range").agg(F.sum(F.col("n_status") * F.col("n_events")).alias("count"))
            .orderBy("speed_range"))


def voice_rpm_stats(events: DataFrame, status: DataFrame, key: str = "timestamp") -> DataFrame:
    """Max / min / avg rpm and row count over the joined VoiceCommand rows; one row even when empty."""
    instants = as_instants(events, status, key)
    counts = _event_counts(events, VOICE_COMMAND, key, instants)
    per_ts = (normalise_key(status.select(key, "rpm"), key, instants)
              .groupBy(key).agg(F.max("rpm").alias("mx"), F.min("rpm").alias("mn"),
                                F.sum("rpm").alias("s"), F.count("rpm").alias("c"),
                                F.count(F.lit(1)).alias("n_status")))
    j = per_ts.join(counts, [key], "inner")
    return j.agg(F.max("mx").alias("max_rpm"), F.min("mn").alias("min_rpm"),
                 F.try_divide(F.sum(F.col("s") * F.col("n_events")), F.sum(F.col("c") * F.col("n_events")))
                 .alias("avg_rpm"),
                 F.coalesce(F.sum(F.col("n_status") * F.col("n_events")), F.lit(0)).cast("bigint").alias("voice_count"))


def join_row_count(events: DataFrame, status: DataFrame, key: str = "timestamp") -> DataFrame:
    """Rows of the full join, from per-timestamp counts of both sides."""
    e, s = normalise_keys(events.select(key), status.select(key), key)
    e = e.groupBy(key).agg(F.count(F.lit(1)).alias("ne"))
    s = s.groupBy(key).agg(F.count(F.lit(1)).alias("ns"))
    return (e.join(s, [key], "inner")
            .agg(F.coalesce(F.sum(F.col("ne") * F.col("ns")), F.lit(0)).cast("bigint").alias("row_count")))


def preview(df: DataFrame, n: int = 20, order_by=None) -> DataFrame:
    """The first n rows in a total order (all columns by default); a top-n, not a full sort."""
    keys = list(order_by or df.columns)
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)


def preview_join(events: DataFrame, status: DataFrame, n: int = 20, key: str = "timestamp") -> DataFrame:
    """O4 over J1 without computing the whole join.

    In the total order the first n joined rows lie within the n smallest timestamps
    present on both sides (each contributes at least one row).  Those come from the
    per-timestamp distinct keys (a bounded top-n); only rows at or before the largest
    of them are joined and sorted.
    """
    e, s = normalise_keys(events, status, key)
    common = (e.select(key).distinct().join(s.select(key).distinct(), [key], "inner")
              .orderBy(key).limit(n))
    cutoff = common.agg(F.max(key)).scalar()

    def first_rows(side: DataFrame) -> DataFrame:
        """The first n rows of each timestamp: the n first pairs need no others."""
        rest = [F.col(c).asc_nulls_first() for c in side.columns if c != key] or [F.col(key)]
        rank = F.row_number().over(Window.partitionBy(key).orderBy(*rest))
        return side.filter(F.col(key) <= cutoff).withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")

    return preview(join_events_status(first_rows(e), first_rows(s), key), n)
