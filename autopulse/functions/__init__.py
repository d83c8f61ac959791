"""Scalar helpers: native Column expressions only."""

from autopulse.functions.format import bucket, format_record
from autopulse.functions.plan import compute_once
from autopulse.functions.text import (
    JAVA_WHITESPACE, jvm_split_fields, jvm_trim, legacy_int, non_blank, numeric_tokens,
    safe_double, words,
)
from autopulse.functions.time import (
    batch_file_name, batch_time_text, day_of_week, hour_of_day, safe_timestamp, to_utc_wall_clock,
    utc_instant, wall_clock_micros,
)

__all__ = [
    "JAVA_WHITESPACE", "batch_file_name", "compute_once", "batch_time_text", "bucket", "day_of_week",
    "format_record", "hour_of_day", "jvm_split_fields", "jvm_trim", "legacy_int", "non_blank",
    "numeric_tokens", "safe_double", "safe_timestamp", "to_utc_wall_clock", "utc_instant", "wall_clock_micros",
    "words",
]
