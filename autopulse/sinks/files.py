"""Batch file sinks (K1-K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from autopulse.sinks.manifest import Folder


def _check_flat(df: DataFrame) -> None:
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (StructType, ArrayType, MapType))]
    if nested:
        raise ValueError(f"CSV cannot hold nested columns: {nested}")


# Microsecond timestamp texts (the CSV writer's defaults stop at milliseconds).
CSV_TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """K1/K3: header CSV, overwrite.  ``single_file`` funnels the write through one task (opt-in).

    Timestamps keep their microseconds.
    """
    _check_flat(df)
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", CSV_TIMESTAMP_NTZ_FORMAT).option("timestampFormat", CSV_TIMESTAMP_FORMAT)
     .csv(path))
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    """K2: Parquet, overwrite, natural partitioning."""
    df.write.mode("overwrite").parquet(path)
    return path


def publish(df: DataFrame, base: str, name: str, formats=("csv", "parquet"), parquet_name: str | None = None,
            single_file_csv: bool = False, order_by=None) -> dict[str, str]:
    """K4: write one result as CSV under ``<base>/<name>`` and Parquet under ``<base>/<name>_parquet``.

    A multi-file CSV is written from the Parquet copy, so the result is computed once.
    A single-file CSV (small, possibly sorted results) is written from the frame itself
    to keep its order; ``order_by`` sorts a multi-file CSV again, which the Parquet copy
    read back does not promise.
    """
    base = base.rstrip("/")
    written = {}
    source = df
    if "parquet" in formats:
        written[f"{name}:parquet"] = write_parquet(df, f"{base}/{parquet_name or name + '_parquet'}")
        if not single_file_csv:
            source = df.sparkSession.read.parquet(written[f"{name}:parquet"])
            if order_by:
                source = source.orderBy(*order_by)
    if "csv" in formats:
        written[f"{name}:csv"] = write_csv(source, f"{base}/{name}", single_file=single_file_csv)
    return written


def publish_if_any(df: DataFrame, base: str, name: str, formats=("csv", "parquet"), parquet_name: str | None = None,
                   **kwargs) -> dict[str, str]:
    """K5: publish only when the frame has a row; nothing appears under ``base`` otherwise.

    The frame is written once, under a hidden name, and its rows are counted by that write; the copy
    then takes its place by a rename, and a CSV is written from it.
    """
    base = base.rstrip("/")
    spark, draft = df.sparkSession, f"_{name}.draft"
    rows = Observation()
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{base}/{draft}")
    folder = Folder(spark, base)
    if not rows.get["n"]:
        folder.delete(draft)
        if not folder.names():
            folder.delete()
        return {}
    place = parquet_name or f"{name}_parquet"
    written = {}
    if "parquet" in formats:
        folder.delete(place)
        folder.rename(draft, place)
        written[f"{name}:parquet"] = f"{base}/{place}"
    if "csv" in formats:
        copy = spark.read.schema(df.schema).parquet(f"{base}/{place if 'parquet' in formats else draft}")
        written.update(publish(copy, base, name, formats=("csv",), **kwargs))
    if "parquet" not in formats:
        folder.delete(draft)
    return written
