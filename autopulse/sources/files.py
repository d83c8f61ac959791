"""File sources (S1-S4): typed readers with the reference's casts, ANSI-safe."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from autopulse.functions import compute_once, legacy_int, safe_timestamp


def read_telemetry_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column text; timestamp -> TIMESTAMP_NTZ, 3 numerics -> DOUBLE, bad -> NULL.

    Other columns pass through as STRING.  Caching is the caller's choice.
    """
    raw = spark.read.option("header", True).csv(path)
    return raw.withColumns({
        "timestamp": safe_timestamp("timestamp"),
        "speed": F.col("speed").try_cast("double"),
        "acceleration": F.col("acceleration").try_cast("double"),
        "lateral_acceleration": F.col("lateral_acceleration").try_cast("double"),
    })


def read_sensor_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV; temp/humidity/pressure -> DOUBLE, speed -> INT with non-ANSI cast rules."""
    raw = spark.read.option("header", True).csv(path)
    return raw.withColumns({
        "temp": F.col("temp").try_cast("double"),
        "speed": legacy_int("speed"),
        "humidity": F.col("humidity").try_cast("double"),
        "pressure": F.col("pressure").try_cast("double"),
    })


def read_cabin_events_json(spark: SparkSession, path: str, schema: StructType | None = None,
                           infer: bool = False, columns: Mapping[str, str] | None = None) -> DataFrame:
    """S3: JSON lines in permissive mode.

    With ``columns`` (name -> type; may be empty) there is one scan and no inference: each line
    becomes a VARIANT, `timestamp` and `event_type` are taken from it as text, the named columns
    typed, bad values NULL, and ``record`` keeps everything else.  A line that is no JSON gives NULLs.
    One that repeats a key has no VARIANT; its columns take the last value, as Spark's JSON reader does.

    Without them the reader finds all columns itself, which costs one more scan; a ``schema`` given
    instead reads only its columns.
    """
    if columns is None:
        reader = spark.read.option("mode", "PERMISSIVE")
        return (reader.schema(schema) if schema is not None and not infer else reader).json(path)
    lines = compute_once(spark.read.text(path).where(F.trim("value") != ""), ["value"], record=F.try_parse_json("value"))

    def member(name: str, kind: str) -> Column:
        quote = "'" if '"' in name else '"'  # a path has no escapes
        typed = F.try_variant_get("record", f"$[{quote}{name}{quote}]", kind)
        again = F.from_json("value", StructType.fromDDL(f"`{name}` {kind}")).getField(name)
        return F.coalesce(typed, F.when(F.col("record").isNull(), again)).alias(name)

    wanted = {"timestamp": "string", "event_type": "string", **columns}
    return lines.select(*[member(n, k) for n, k in wanted.items()], "record")


def read_status_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (pushdown and pruning by Catalyst)."""
    return spark.read.parquet(path)
