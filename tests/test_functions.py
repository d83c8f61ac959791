import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from autopulse.functions import (
    batch_file_name, batch_time_text, bucket, format_record, jvm_split_fields, jvm_trim, legacy_int, non_blank,
    numeric_tokens, safe_double, safe_timestamp, words,
)


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_jvm_trim_strips_control_chars(spark):
    assert one_col(spark, ["\x01 a b\t\n", "  x  ", "", None], jvm_trim) == ["a b", "x", "", None]


def test_jvm_split_drops_trailing_empty_fields_before_trim(spark):
    got = one_col(spark, ["v1,120,,", "v1,", ",5", "v1,120, ", "", ",,,", " v1 , 130 ", ",\n"], jvm_split_fields)
    assert got == [["v1", "120"], ["v1"], ["", "5"], ["v1", "120", ""], [""], [], ["v1", "130"], ["", ""]]


def test_safe_double_follows_the_java_parser(spark):
    got = one_col(spark, ["1.5", "NaN", "-Infinity", "inf", "nan", "Infinity", "1e3", "abc", "", None], safe_double)
    assert got[0] == 1.5 and math.isnan(got[1]) and got[2] == float("-inf")
    assert got[3] is None and got[4] is None
    assert got[5] == float("inf") and got[6] == 1000.0
    assert got[7:] == [None, None, None]


def test_legacy_int_matches_non_ansi_cast(spark):
    got = one_col(spark, ["12.7", "-0.9", "1e2", "99999999999", "NaN", " 42 ", "", "+7", "abc", None, ".", "5.",
                          "-2147483648", "2147483648", "\x7f12\x01", "+", "1.x"], legacy_int)
    assert got == [12, 0, None, None, None, 42, None, 7, None, None, 0, 5, -2147483648, None, 12, None, None]


def legacy_to_int(s):
    """Model of the non-ANSI string -> int parse: trim, sign, digits, optional '.' + digits (truncated)."""
    def ctl(ch):
        return ch <= " " or ch == "\x7f"
    i, j = 0, len(s)
    while i < j and ctl(s[i]):
        i += 1
    while j > i and ctl(s[j - 1]):
        j -= 1
    t = s[i:j]
    m = re.fullmatch(r"([+-]?)([0-9]*)(\.[0-9]*)?", t)
    if not t or t in "+-" or not m:
        return None
    v = int(m.group(2) or "0") * (-1 if m.group(1) == "-" else 1)
    return v if -2**31 <= v < 2**31 else None


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(alphabet=st.sampled_from(list("0123456789.+- e\x7f\t")), max_size=12),
                       min_size=1, max_size=30))
def test_legacy_int_property(spark, values):
    assert one_col(spark, values, legacy_int) == [legacy_to_int(v) for v in values]


def test_words_and_numeric_tokens(spark):
    assert one_col(spark, ["  spark  spark\twindow \n", "", "\x0bx\x0cy"], words) == [
        ["spark", "spark", "window"], [], ["x", "y"]]
    got = one_col(spark, ["-1.2 -5.1 abc 0.4", "view"], numeric_tokens)
    assert got == [[-1.2, -5.1, 0.4], []]


def test_non_blank(spark):
    assert one_col(spark, [" ", "", None, " a"], non_blank) == [False, False, False, True]


def test_safe_timestamp_never_raises(spark):
    got = one_col(spark, ["2024-01-01 10:00:00", "bad", None], safe_timestamp)
    assert got[0].hour == 10 and got[1] is None and got[2] is None


def test_batch_time_texts_are_in_shanghai(spark):
    df = spark.createDataFrame([(1,)], "x int").select(F.lit("2024-01-01 23:30:00.123456").cast("timestamp_ntz").alias("t"))
    r = df.select(batch_time_text("t"), batch_file_name("raw_stream", "t")).first()
    assert r[0] == "2024-01-02 07:30:00"
    assert r[1] == "raw_stream_20240102_073000_123.txt"


def test_bucket_and_format_record(spark):
    b = one_col(spark, [-5.0, 29.9, 30.0, 89.9, 90.0, float("nan"), None],
                lambda c: bucket(c, [30, 60, 90], ["a", "b", "c", "d"]), "double")
    assert b == ["a", "a", "b", "c", "d", "d", "d"]
    df = spark.createDataFrame([("v1", 130.0, None)], "vehicle_id string, speed double, n int")
    assert df.select(format_record("vehicle_id", "speed", "n")).first()[0] == "vehicle_id=v1\tspeed=130.0\tn=null"


# --- property tests against Python models of the JVM string methods ---------------------


def java_trim(s):
    i, j = 0, len(s)
    while i < j and s[i] <= " ":
        i += 1
    while j > i and s[j - 1] <= " ":
        j -= 1
    return s[i:j]


def java_split(s, sep=","):
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


line_st = st.text(alphabet=st.sampled_from(list("ab,1 .\t\x01\x0b") + ["\n", "é"]), max_size=14)


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(line_st, min_size=1, max_size=25))
def test_split_and_words_match_jvm_models(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(jvm_split_fields("v"), words("v"), jvm_trim("v")).collect()
    for v, (fields, ws, trimmed) in zip(values, got):
        assert fields == [java_trim(p) for p in java_split(v)], repr(v)
        assert ws == [w for w in re.split(r"[ \t\n\x0b\f\r]+", java_trim(v)) if w], repr(v)
        assert trimmed == java_trim(v), repr(v)


JAVA_DOUBLE = re.compile(r"^[+-]?(NaN|Infinity|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)"
                         r"|(0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?))$")
DOUBLE_EDGES = [" 1.5 ", "1.5d", "1e3", ".5", "5.", "0x1p3", "0x1.8p1", "1_000", "١٢", "+.5", "-", "", "1e",
                "e3", "NaN", "-NaN", "+Infinity", "infinity", "INF", "1.5f ", "\t1\n", "\x011\x01", "1 2", "0x10",
                "1e+5", "1E-5D", "+-1", "00.1", ".", "1.2.3", "Infinityd", "NaNf"]


def test_safe_double_accepts_exactly_the_java_grammar(spark):
    got = one_col(spark, DOUBLE_EDGES, safe_double)
    for s, d in zip(DOUBLE_EDGES, got):
        assert (d is not None) == bool(JAVA_DOUBLE.match(java_trim(s))), repr(s)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(alphabet=st.sampled_from(list("0123456789.eE+-dfxXpP NaIity")), max_size=8),
                       min_size=1, max_size=30))
def test_safe_double_property(spark, values):
    got = one_col(spark, values, safe_double)
    for s, d in zip(values, got):
        ok = bool(JAVA_DOUBLE.match(java_trim(s)))
        assert (d is not None) == ok, repr(s)
        if ok and "x" not in s.lower() and "N" not in s and "I" not in s:
            assert d == float(java_trim(s).rstrip("dDfF")), repr(s)


def test_to_utc_wall_clock_ignores_the_session_zone(spark):
    from autopulse.functions import to_utc_wall_clock
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = []
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.range(1).select(F.timestamp_seconds(F.lit(1704067200)).alias("t"))   # 2024-01-01 00:00 UTC
            got.append(df.select(to_utc_wall_clock("t"), batch_time_text(to_utc_wall_clock("t"))).first())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {tuple(r) for r in got} == {(got[0][0], "2024-01-01 08:00:00")}
    assert got[0][0].hour == 0


def test_safe_timestamp_reads_a_zone_in_the_text(spark):
    from pyspark.sql import functions as F

    from autopulse.functions import safe_timestamp

    texts = ["2024-01-01T00:00:00+08:00", "2024-01-01 00:00:00", "2024-01-01 00:00:00Z", "2024-01-01", "bad", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(F.date_format(safe_timestamp("t"), "yyyy-MM-dd HH:mm")).collect()]
    assert got == ["2023-12-31 16:00", "2024-01-01 00:00", "2024-01-01 00:00", "2024-01-01 00:00", None, None]
