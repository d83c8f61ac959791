"""Text-line operators (P14-P20, A11): parsers with JVM split/trim/parse semantics, word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autopulse.functions import JAVA_WHITESPACE, compute_once, format_record, jvm_split_fields, jvm_trim, safe_double

# Defaults of the line-stream jobs.
BRAKE_THRESHOLD = -5.0
BRAKE_METRIC = "hard_brake"


def _fields(lines: DataFrame, value: str) -> DataFrame:
    rest = [c for c in lines.columns if c != value]
    parts = compute_once(lines, rest, _p=jvm_split_fields(value))
    return parts.where(F.size("_p") == 2), rest


def parse_speed_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """`vehicle_id,speed` -> (vehicle_id, speed DOUBLE); other lines are dropped.

    Exactly two fields after the JVM split (trailing empty fields ignored), a non-empty
    id and a Java double (NaN kept).  Other input columns pass through.
    """
    parts, rest = _fields(lines, value)
    first, second = F.try_element_at("_p", F.lit(1)), F.try_element_at("_p", F.lit(2))
    return (parts.where(first != "")
            .select(*rest, first.alias("vehicle_id"), safe_double(second).alias("speed"))
            .where(F.col("speed").isNotNull()))


def parse_status_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """`vehicle_id,status` -> (vehicle_id, status lower-cased); both fields non-empty."""
    parts, rest = _fields(lines, value)
    first, second = F.try_element_at("_p", F.lit(1)), F.try_element_at("_p", F.lit(2))
    return (parts.where((first != "") & (second != ""))
            .select(*rest, first.alias("vehicle_id"), F.lower(second).alias("status")))


def parse_numeric_tokens(lines: DataFrame, value: str = "value", out: str = "number") -> DataFrame:
    """One row per whitespace token that parses as a Java double (flat-map)."""
    rest = [c for c in lines.columns if c != value]
    tokens = explode_words(lines, value, rest, out="_tok")
    return tokens.select(*rest, safe_double("_tok").alias(out)).where(F.col(out).isNotNull())


def below_threshold(df: DataFrame, threshold: float = BRAKE_THRESHOLD, column: str = "number") -> DataFrame:
    """`value < threshold`, strict."""
    return df.filter(F.col(column) < threshold)


def explode_words(lines: DataFrame, value: str = "value", keep: Sequence[str] = (), out: str = "word") -> DataFrame:
    """One row per non-empty whitespace-separated word (`trim.split("\\s+").filter(_.nonEmpty)`)."""
    exploded = lines.select(*keep, F.explode(F.split(jvm_trim(value), JAVA_WHITESPACE, -1)).alias(out))
    return exploded.where(F.col(out) != "")


def word_count(lines: DataFrame, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """(by..., word, count) with map-side partial counts; sorted by batch key and word."""
    by = list(by)
    return (explode_words(lines, value, by).groupBy(*by, "word").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(*by, "word"))


def format_records(df: DataFrame, names: Sequence[str], out: str = "record") -> DataFrame:
    """P20: one `k=v<TAB>k=v` text column from the named columns."""
    return df.select(format_record(*names).alias(out))
