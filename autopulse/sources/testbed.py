"""Adapters that derive the telemetry shapes (FIXTURES.md §3) from the given test tables.

Every adapter is a projection of one table (no row subset), so the work of each
query grows with the tables.  The same expressions are written in DuckDB SQL in
``autopulse.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autopulse.functions import compute_once

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over one test table, which is a single file or a folder of part files.

    The path's last letter stands in brackets: a file stream takes no single-file path, but it takes
    a pattern, and a folder that fits a pattern is listed like a file.
    """
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")


def _k():
    return F.get_json_object("props", "$.k").try_cast("int")


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """timestamp, vehicle_id, speed, acceleration, lateral_acceleration (+ event_id as order key)."""
    return events.select(
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("vehicle_id"),
        F.col("value").alias("speed"),
        ((_k() - 50) / F.lit(10.0)).alias("acceleration"),
        (((F.col("event_id") * 7) % 60) / F.lit(10.0)).alias("lateral_acceleration"),
        F.col("event_id"),
    )


def sensors_from_events(events: DataFrame, *more: str) -> DataFrame:
    """temp (NULL every tenth k), speed INT, humidity, pressure (+ event_id and ``more`` event columns)."""
    k = _k()
    return events.select(
        F.col("event_id"),
        F.when(k % 10 == 0, F.lit(None).cast("double")).otherwise(k / F.lit(2.0)).alias("temp"),
        F.floor("value").cast("int").alias("speed"),
        ((F.col("event_id") % 100) * F.lit(1.0)).alias("humidity"),
        (F.lit(1000.0) + (F.col("event_id") % 50)).alias("pressure"),
        *more,
    )


def _order_stamp(order_key: str):
    """One stamp for every two orders: the rows per stamp don't grow with the tables."""
    return F.expr(f"TIMESTAMP_NTZ'1995-01-01 00:00:00' + make_dt_interval(0, 0, 0, {order_key} div 2)")


def cabin_events_from_orders(orders: DataFrame, *more) -> DataFrame:
    """timestamp, event_type (1-URGENT -> NavigationStart, 2-HIGH -> VoiceCommand, else the priority), and ``more``."""
    p = F.col("o_orderpriority")
    return orders.select(
        _order_stamp("o_orderkey").alias("timestamp"),
        F.when(p == "1-URGENT", "NavigationStart").when(p == "2-HIGH", "VoiceCommand")
        .otherwise(p).alias("event_type"),
        *more,
    )


def status_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """timestamp, speed = 2 * quantity, rpm = 100 * quantity."""
    return lineitem.select(
        _order_stamp("l_orderkey").alias("timestamp"),
        (F.col("l_quantity") * 2).alias("speed"),
        (F.col("l_quantity") * 100).alias("rpm"),
    )


def ts_text(c):
    """Microsecond timestamp text (JSON and CSV writers would cut NTZ values to milliseconds)."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def kafka_records_from_events(events: DataFrame, topic: str = "cabin") -> DataFrame:
    """Kafka-shaped records (key, value, topic, partition, offset, timestamp, timestampType).

    Works on batch and streaming frames alike.  Every 25th k has a blank event, every
    20th k (k % 20 = 1) no speed, so the ETL filters have work to do.
    """
    events = compute_once(events, events.columns, _k=_k())  # one look into `props` a row
    k = F.col("_k")
    message = F.to_json(F.struct(
        F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("vehicle_id"),
        F.when(k % 25 == 0, F.lit(" ")).otherwise(F.col("event_type")).alias("event"),
        F.when(k % 20 == 1, F.lit(None).cast("double")).otherwise(F.col("value")).alias("speed"),
        ((k - 50) / F.lit(10.0)).alias("acceleration"),
        ts_text(F.col("ts")).alias("ts"),
    ))
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        message.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def word_lines_from_documents(documents: DataFrame) -> DataFrame:
    """value = text; `source` is the batch key, doc_id the order key."""
    return documents.select("doc_id", "source", F.col("text").alias("value"))


def numeric_lines_from_events(events: DataFrame) -> DataFrame:
    """`<acceleration> <event_type>`: one numeric token and one word per line."""
    acc = (_k() - 50) / F.lit(10.0)
    return events.select("event_id", "ts",
                         F.concat_ws(" ", acc.cast("string"), F.col("event_type")).alias("value"))


def speed_lines_from_events(events: DataFrame) -> DataFrame:
    """F8: `vehicle,speed`; `bad` as speed when event_id % 7 = 0; `,,` appended when event_id % 5 = 0."""
    speed = F.when(F.col("event_id") % 7 == 0, F.lit("bad")).otherwise(F.col("value").cast("string"))
    line = F.concat(F.col("user_id").cast("string"), F.lit(","), speed,
                    F.when(F.col("event_id") % 5 == 0, F.lit(",,")).otherwise(F.lit("")))
    return events.select("event_id", "ts", line.alias("value"))


def status_lines_from_events(events: DataFrame) -> DataFrame:
    """`vehicle,status`; status `driving` for view events, else the event type."""
    status = F.when(F.col("event_type") == "view", F.lit("driving")).otherwise(F.col("event_type"))
    return events.select("event_id", "ts",
                         F.concat(F.col("user_id").cast("string"), F.lit(","), status).alias("value"))
