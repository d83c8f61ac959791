"""Stream sources.

The Kafka builder is the production source; replay sources read the same record
shape from files, so every operator is exercised without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from autopulse import schemas


def read_kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str = "cabin",
                      starting_offsets: str = "latest", **options) -> DataFrame:
    """Subscribe to one topic (needs the Kafka connector on the classpath)."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def read_kafka_replay(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S5 replay: Parquet files holding Kafka-shaped records (same 7 columns)."""
    reader = spark.readStream.schema(schemas.KAFKA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text lines appended as files to a directory (one `value` column)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def kafka_lines(records: DataFrame) -> DataFrame:
    """Kafka records as text lines with an order key: `value` (message text), `seq` (offset), `partition`.

    The per-vehicle state jobs need an order within each micro-batch (T16); with messages
    keyed by vehicle, one vehicle's messages share a partition and the offset orders them.
    Plain text-file streams carry no such key (Structured Streaming has no row ids), so
    their lines must embed one.
    """
    return records.selectExpr("CAST(value AS STRING) AS value", "offset AS seq", "partition")
