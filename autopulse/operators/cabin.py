"""Kafka cabin-message operators (P8-P12, A10); batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autopulse.functions import compute_once, non_blank


def kafka_envelope(records: DataFrame) -> DataFrame:
    """key/value/timestamp as text, renamed; topic, partition, offset kept."""
    return records.selectExpr("CAST(key AS STRING) AS message_key", "CAST(value AS STRING) AS raw_value",
                              "topic", "partition", "offset", "CAST(timestamp AS STRING) AS kafka_time")


def kafka_values(records: DataFrame) -> DataFrame:
    """P10: the message payload as text."""
    return records.selectExpr("CAST(value AS STRING) AS value")


CABIN_FIELDS = ("vehicle_id", "event", "speed", "acceleration", "ts")


def parse_cabin_json(values: DataFrame, with_processing_time: bool = True) -> DataFrame:
    """Five top-level JSON fields; speed/acceleration to DOUBLE (bad text -> NULL); event_time stays text.

    A message is parsed once, into a map of its members, for all five fields and whatever filters
    follow.  Of a repeated key the first value counts (`json_tuple` would take the last).
    """
    members = F.from_json("value", "map<string,string>", {"allowNonNumericNumbers": "false"})
    # NULL members give way to a later one of the same key; of the others a lookup finds the first
    parsed = compute_once(values, [], _m=F.map_filter(members, lambda _, v: v.isNotNull()))
    fields = parsed.select(*[F.try_element_at("_m", F.lit(name)).alias(name) for name in CABIN_FIELDS])
    cols = [F.col("vehicle_id"), F.col("event"), F.col("speed").try_cast("double").alias("speed"),
            F.col("acceleration").try_cast("double").alias("acceleration"), F.col("ts").alias("event_time")]
    if with_processing_time:
        cols.append(F.current_timestamp().alias("processing_time"))
    return fields.select(*cols)


def valid_cabin_records(parsed: DataFrame, with_processing_time: bool = True) -> DataFrame:
    """Non-blank vehicle_id and event, non-NULL speed and acceleration (values not trimmed)."""
    out = parsed.filter(non_blank("vehicle_id") & non_blank("event")
                        & F.col("speed").isNotNull() & F.col("acceleration").isNotNull())
    if with_processing_time and "processing_time" not in out.columns:
        out = out.withColumn("processing_time", F.current_timestamp())
    return out


def cabin_etl(records: DataFrame, with_processing_time: bool = True) -> DataFrame:
    """P10 -> P9 -> P11: Kafka records to clean cabin rows."""
    parsed = parse_cabin_json(kafka_values(records), with_processing_time=False)
    return valid_cabin_records(parsed, with_processing_time)


def event_counts(records: DataFrame) -> DataFrame:
    """A10: running count per non-blank event (P12); no watermark, one state row per distinct event."""
    events = compute_once(kafka_values(records), [], event=F.get_json_object("value", "$.event"))
    return events.filter(non_blank("event")).groupBy("event").agg(F.count(F.lit(1)).alias("count"))


def ordered_event_counts(counts: DataFrame) -> DataFrame:
    """O3: count descending, then event ascending (allowed on complete-mode output)."""
    return counts.orderBy(F.col("count").desc(), F.col("event").asc())
