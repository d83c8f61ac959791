"""Sources: typed file readers; test-table adapters in ``testbed``."""

from autopulse.sources.files import read_cabin_events_json, read_sensor_csv, read_status_parquet, read_telemetry_csv

__all__ = ["read_cabin_events_json", "read_sensor_csv", "read_status_parquet", "read_telemetry_csv"]
