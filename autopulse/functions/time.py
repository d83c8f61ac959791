"""Time helpers: safe parsing, hour / weekday, and the batch-time texts of the per-batch file sink."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from autopulse.functions._cols import to_col

# Zone and patterns of the batch-time texts.
BATCH_ZONE = "Asia/Shanghai"
BATCH_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
BATCH_FILE_PATTERN = "yyyyMMdd_HHmmss_SSS"
ZONE_SUFFIX = r"\d:\d\S*\s*(Z|[+-]\d{1,2}(:?\d{2}){0,2}|[A-Za-z]+([+/-]\S+)?)\s*$"


def safe_timestamp(c) -> Column:
    """Text -> TIMESTAMP_NTZ; NULL for unparsable text instead of an ANSI error.

    A time with a zone is that instant's wall clock in the session zone; one without is itself.
    """
    text = to_col(c)
    zoned = F.coalesce(text.cast("string").rlike(ZONE_SUFFIX), F.lit(False))
    return F.when(zoned, text.try_cast("timestamp").cast("timestamp_ntz")).otherwise(text.try_cast("timestamp_ntz"))


def to_utc_wall_clock(c) -> Column:
    """A TIMESTAMP (instant) as its UTC wall clock (TIMESTAMP_NTZ), independent of the session zone.

    Computed from the instant's microseconds: in an hour that a zone's clocks show twice, two
    instants share a local wall clock but not this one.
    """
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(to_col(c)) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"))


def wall_clock_micros(c) -> Column:
    """A TIMESTAMP_NTZ's own fields as microseconds since 1970-01-01 00:00: no zone is asked."""
    c = to_col(c)
    day = F.datediff(c, F.lit("1970-01-01").cast("date")).cast("bigint")
    second = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return ((day * 24 + F.hour(c)) * 60 + F.minute(c)) * 60_000_000 + second


def utc_instant(c) -> Column:
    """A TIMESTAMP_NTZ read as UTC: the instant (TIMESTAMP) that ``to_utc_wall_clock`` gives back."""
    return F.timestamp_micros(wall_clock_micros(c))


def hour_of_day(c) -> Column:
    return F.hour(to_col(c))


def day_of_week(c) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(to_col(c))


def batch_time_text(utc_wall_clock) -> Column:
    """`yyyy-MM-dd HH:mm:ss` in Asia/Shanghai of a UTC wall-clock TIMESTAMP_NTZ."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(BATCH_ZONE), to_col(utc_wall_clock))
    return F.date_format(local, BATCH_TIME_PATTERN)


def batch_file_name(prefix: str, utc_wall_clock) -> Column:
    """`<prefix>_yyyyMMdd_HHmmss_SSS.txt` in Asia/Shanghai."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(BATCH_ZONE), to_col(utc_wall_clock))
    return F.concat(F.lit(prefix + "_"), F.date_format(local, BATCH_FILE_PATTERN), F.lit(".txt"))
