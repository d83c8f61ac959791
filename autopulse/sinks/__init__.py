"""Sinks; streaming sinks live in ``autopulse.streaming.runner``."""

from autopulse.sinks.files import publish, publish_if_any, write_csv, write_parquet

__all__ = ["publish", "publish_if_any", "write_csv", "write_parquet"]
