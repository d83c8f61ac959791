"""Schemas of the inputs the operators read (FIXTURES.md §1) and of the Kafka envelope."""

from pyspark.sql import types as T

# telemetry CSV after the reader's casts; extra columns pass through as STRING.
TELEMETRY = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("acceleration", T.DoubleType()),
    T.StructField("lateral_acceleration", T.DoubleType()),
])

# sensor CSV after the reader's casts (speed is INT).
SENSORS = T.StructType([
    T.StructField("temp", T.DoubleType()),
    T.StructField("speed", T.IntegerType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("pressure", T.DoubleType()),
])

# cabin events as JSON lines; the timestamp arrives as text.
CABIN_EVENTS = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_type", T.StringType()),
])

# the fixed record schema of a Kafka source.
KAFKA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

# Line streams carry one text column.
LINES = T.StructType([T.StructField("value", T.StringType())])
