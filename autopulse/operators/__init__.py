"""DataFrame -> DataFrame operators, usable with ``DataFrame.transform``."""

from autopulse.operators.aggregate import daily_events, hourly_events, vehicle_scores, weekday_weekend_events
from autopulse.operators.cabin import (
    cabin_etl, event_counts, kafka_envelope, kafka_values, ordered_event_counts, parse_cabin_json,
    valid_cabin_records,
)
from autopulse.operators.clean import (
    clean_sensors, describe, describe_numeric, exact_quantiles, fill_mean, filter_max_speed, iqr_bounds,
    iqr_outliers, quality_profile,
)
from autopulse.operators.events import add_event_flags, select_event_type
from autopulse.operators.joins import (
    join_events_status, join_row_count, navigation_events, navigation_speed_histogram, preview, preview_join,
    repeat_rows, voice_events, voice_rpm_stats,
)
from autopulse.operators.lines import (
    below_threshold, explode_words, format_records, parse_numeric_tokens, parse_speed_lines, parse_status_lines,
    word_count,
)
from autopulse.operators.scan import ordered_scan
from autopulse.operators.state import (
    driving_duration, latest_state, latest_state_per_record, overspeed_alert, overspeed_run, with_alert,
)
from autopulse.operators.windows import brake_window_counts, window_counts

__all__ = [
    "add_event_flags", "below_threshold", "brake_window_counts", "cabin_etl", "clean_sensors", "daily_events",
    "describe", "describe_numeric", "driving_duration", "event_counts", "exact_quantiles", "explode_words",
    "fill_mean", "filter_max_speed", "format_records", "hourly_events", "iqr_bounds", "iqr_outliers",
    "join_events_status", "join_row_count", "kafka_envelope", "kafka_values", "latest_state",
    "latest_state_per_record", "navigation_events", "navigation_speed_histogram", "ordered_event_counts",
    "ordered_scan", "overspeed_alert", "overspeed_run", "parse_cabin_json", "parse_numeric_tokens",
    "parse_speed_lines", "parse_status_lines", "preview", "preview_join", "quality_profile", "repeat_rows",
    "select_event_type", "valid_cabin_records", "vehicle_scores", "voice_events", "voice_rpm_stats",
    "weekday_weekend_events", "window_counts", "with_alert", "word_count",
]
