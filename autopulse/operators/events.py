"""Event flags (P1) and cabin-event selections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default thresholds of the reference's configuration.
ACCEL_THRESHOLD = 3.0
DECEL_THRESHOLD = -3.0
LATERAL_THRESHOLD = 4.0

# Cabin event types the analyses select.
NAVIGATION_START = "NavigationStart"
VOICE_COMMAND = "VoiceCommand"


def add_event_flags(df: DataFrame, accel_threshold: float = ACCEL_THRESHOLD,
                    decel_threshold: float = DECEL_THRESHOLD,
                    lateral_threshold: float = LATERAL_THRESHOLD) -> DataFrame:
    """Add INT 0/1 columns is_hard_accel / is_hard_decel / is_hard_turn (strict compares, NULL -> 0).

    Plain SQL comparison, so NaN counts as above every threshold (T4).
    """
    def flag(cond):
        return F.when(cond, 1).otherwise(0)

    return df.withColumns({
        "is_hard_accel": flag(F.col("acceleration") > accel_threshold),
        "is_hard_decel": flag(F.col("acceleration") < decel_threshold),
        "is_hard_turn": flag(F.col("lateral_acceleration") > lateral_threshold),
    })


def select_event_type(df: DataFrame, event_type: str, *columns: str) -> DataFrame:
    """`event_type = <value>` then project."""
    out = df.filter(F.col("event_type") == event_type)
    return out.select(*columns) if columns else out
