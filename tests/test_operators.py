import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from autopulse.operators import aggregate, clean, events, joins
from conftest import rows

TEL = "timestamp timestamp_ntz, vehicle_id string, speed double, acceleration double, lateral_acceleration double"


@pytest.fixture
def telemetry(spark):
    sat = dt.datetime(2024, 1, 6, 10)   # Saturday
    sun = dt.datetime(2024, 1, 7, 11)   # Sunday
    mon = dt.datetime(2024, 1, 8, 10)
    data = [
        (mon, "a", 50.0, 3.0, 4.0),            # exactly at thresholds: no flags
        (mon, "a", 50.0, 3.1, 4.1),            # accel + turn
        (sat, "b", 50.0, -3.1, 0.0),           # decel, weekend
        (sun, "b", 50.0, None, None),          # NULL -> no flag
        (None, "c", 50.0, float("nan"), 0.0),  # NaN counts as above (SQL); NULL time -> weekend
    ]
    return events.add_event_flags(spark.createDataFrame(data, TEL))


def test_event_flags_edges(telemetry):
    got = rows(telemetry, "vehicle_id", "is_hard_accel", "is_hard_decel", "is_hard_turn")
    assert got == sorted([("a", 0, 0, 0), ("a", 1, 0, 1), ("b", 0, 1, 0), ("b", 0, 0, 0), ("c", 1, 0, 0)], key=repr)


def test_hourly_has_null_hour_group(telemetry):
    got = {r["hour"]: r["total_records"] for r in aggregate.hourly_events(telemetry).collect()}
    assert got == {None: 1, 10: 3, 11: 1}


def test_weekday_weekend_null_counts_as_weekend(telemetry):
    got = {r["day_type"]: (r["total_records"], r["accel_rate_per_1000"]) for r in
           aggregate.weekday_weekend_events(telemetry).collect()}
    assert got == {"weekday": (2, 500.0), "weekend": (3, 333.33)}


def test_daily_names(telemetry):
    got = {(r["weekday_num"], r["weekday_name"]) for r in aggregate.daily_events(telemetry).collect()}
    assert got == {(None, None), (1, "周日"), (2, "周一"), (7, "周六")}


def test_vehicle_scores(telemetry):
    got = {r["vehicle_id"]: r["risk_score"] for r in aggregate.vehicle_scores(telemetry).collect()}
    assert got["a"] == round(100 * math.exp(-(0.02 + 0.015)), 2)
    assert got["b"] == round(100 * math.exp(-0.03), 2)
    assert list(aggregate.vehicle_scores(telemetry).toPandas()["vehicle_id"]) == ["c", "b", "a"]


SENS = "temp double, speed int, humidity double, pressure double"


def test_fill_mean_and_clean(spark):
    df = spark.createDataFrame([(10.0, 199, 1.0, 1.0), (None, 200, 1.0, 1.0), (20.0, 201, 1.0, 1.0),
                                (None, None, 1.0, 1.0)], SENS)
    assert rows(clean.fill_mean(df), "temp") == [(10.0,), (15.0,), (15.0,), (20.0,)]
    assert rows(clean.clean_sensors(df), "temp", "speed") == [(10.0, 199)]
    prof = clean.quality_profile(df).first()
    assert tuple(prof) == (4, 2, 1)   # speed = 200 not counted (T8)


def test_fill_mean_all_null_and_nan(spark):
    df = spark.createDataFrame([(None, 1, 1.0, 1.0), (None, 2, 1.0, 1.0)], SENS)
    assert rows(clean.fill_mean(df), "temp") == [(0.0,), (0.0,)]
    nan = spark.createDataFrame([(float("nan"), 1, 1.0, 1.0), (None, 2, 1.0, 1.0), (1.0, 3, 1.0, 1.0)], SENS)
    assert all(math.isnan(r[0]) for r in clean.fill_mean(nan).select("temp").collect()[:2])


def reference_quantile(values, p):
    vals = sorted(v for v in values if v is not None and not math.isnan(v))
    if not vals:
        return None
    return vals[max(1, math.ceil(p * len(vals))) - 1]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 10, 97, 1000])
def test_exact_quantiles_match_rank_rule(spark, n):
    rnd = random.Random(n)
    vals = [float(rnd.randint(0, 50)) for _ in range(n)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = clean.exact_quantiles(df, "x", [0.25, 0.5, 0.75], buckets=8).first()
    assert tuple(got) == tuple(reference_quantile(vals, p) for p in (0.25, 0.5, 0.75))


def test_exact_quantiles_high_cardinality(spark):
    vals = list(np.random.default_rng(3).normal(size=5000))
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = clean.exact_quantiles(df, "x", [0.25, 0.75], buckets=16).first()
    assert tuple(got) == (reference_quantile(vals, 0.25), reference_quantile(vals, 0.75))


def test_iqr_all_null_gives_no_outliers(spark):
    df = spark.createDataFrame([(1.0, None, 1.0, 1.0)] * 3, SENS)
    assert clean.iqr_outliers(df).count() == 0
    assert tuple(clean.iqr_bounds(df).first()) == (None,) * 5


def test_iqr_outliers(spark):
    speeds = list(range(1, 21)) + [100, -50, None]
    df = spark.createDataFrame([(1.0, s, 1.0, 1.0) for s in speeds], SENS)
    assert sorted(r[0] for r in clean.iqr_outliers(df).select("speed").collect()) == [-50, 100]


def test_describe_numeric(spark):
    df = spark.createDataFrame([(1.0, 1, 1.0, 1.0), (3.0, 3, 1.0, 1.0), (None, 5, 1.0, 1.0)], SENS)
    got = {r["column"]: r for r in clean.describe_numeric(df).collect()}
    assert got["temp"]["count"] == 2 and got["temp"]["mean"] == 2.0 and got["speed"]["max"] == 5.0
    assert got["speed"]["stddev"] == 2.0


def naive_join(ev, st):
    return [(t, e, s, r) for (t, e) in ev for (t2, s, r) in st if t is not None and t == t2]


def test_join_aggregates_equal_naive_join_with_hot_key(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    ev = [(t0, "NavigationStart")] * 30 + [(t0, "VoiceCommand")] * 7 + [(t1, "NavigationStart"), (None, "VoiceCommand")]
    st = [(t0, float(s), float(s * 100)) for s in (10, 40, 70, 95)] * 5 + [(t1, None, None), (None, 5.0, 1.0)]
    e = spark.createDataFrame(ev, "timestamp timestamp_ntz, event_type string")
    s = spark.createDataFrame(st, "timestamp timestamp_ntz, speed double, rpm double")
    full = naive_join(ev, st)
    assert joins.join_row_count(e, s).first()[0] == len(full)
    assert joins.join_events_status(e, s).count() == len(full)
    nav = [(t, sp) for (t, et, sp, _) in full if et == "NavigationStart"]
    assert rows(joins.navigation_events(e, s)) == sorted(nav, key=repr)
    hist = {r[0]: r[1] for r in joins.navigation_speed_histogram(e, s).collect()}
    assert hist == {"0-30km/h": 30 * 5, "30-60km/h": 150, "60-90km/h": 150, "90km/h+": 150 + 1}
    voice = [r for (t, et, _, r) in full if et == "VoiceCommand"]
    stats = joins.voice_rpm_stats(e, s).first()
    assert (stats["max_rpm"], stats["min_rpm"], stats["voice_count"]) == (max(voice), min(voice), len(voice))
    assert stats["avg_rpm"] == pytest.approx(sum(voice) / len(voice))


def test_voice_stats_on_empty_input(spark):
    e = spark.createDataFrame([], "timestamp timestamp_ntz, event_type string")
    s = spark.createDataFrame([], "timestamp timestamp_ntz, speed double, rpm double")
    assert tuple(joins.voice_rpm_stats(e, s).first()) == (None, None, None, 0)


def test_join_normalises_text_keys_and_rejects_ambiguity(spark):
    e = spark.createDataFrame([("2024-01-01 00:00:00", "x"), ("bad", "y")], "timestamp string, event_type string")
    s = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0, 2.0)], "timestamp timestamp_ntz, speed double, rpm double")
    assert joins.join_events_status(e, s).count() == 1
    with pytest.raises(ValueError):
        joins.join_events_status(e.withColumn("speed", F.lit(1.0)), s)


def test_preview_is_total_order_top_n(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(100)], "a int, b int")
    assert [tuple(r) for r in joins.preview(df, 3).collect()] == [(0, 0), (0, 7), (0, 14)]


def test_repeat_rows_in_blocks(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 5), ("d", 10)], "k string, n long")
    got = joins.repeat_rows(df, "n", block=3).groupBy("k").count()
    assert dict(rows(got)) == {"b": 1, "c": 5, "d": 10}


def test_preview_join_equals_preview_of_full_join(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    ev = [(base + dt.timedelta(seconds=i % 5), t) for i, t in enumerate(["A", "B", "C"] * 7)] + [(None, "A")]
    st = [(base + dt.timedelta(seconds=i % 7), float(i), float(i * 10)) for i in range(30)]
    e = spark.createDataFrame(ev, "timestamp timestamp_ntz, event_type string")
    s = spark.createDataFrame(st, "timestamp timestamp_ntz, speed double, rpm double")
    for n in (1, 5, 20, 200):
        want = [tuple(r) for r in joins.preview(joins.join_events_status(e, s), n).collect()]
        assert [tuple(r) for r in joins.preview_join(e, s, n).collect()] == want


def test_publish_if_any_writes_nothing_when_empty(spark):
    import os
    from autopulse.session import scratch_dir
    from autopulse.sinks.files import publish_if_any
    base = scratch_dir(spark, "pia")
    empty = spark.createDataFrame([], "a int")
    assert publish_if_any(empty, base, "x") == {}
    assert not os.path.exists(base)
    written = publish_if_any(spark.createDataFrame([(1,), (2,)], "a int"), base, "x")
    assert sorted(r[0] for r in spark.read.parquet(written["x:parquet"]).collect()) == [1, 2]
    assert spark.read.option("header", True).csv(written["x:csv"]).count() == 2


def test_csv_rejects_nested_columns(spark):
    from autopulse.session import scratch_dir
    from autopulse.sinks.files import write_csv
    df = spark.createDataFrame([(1, "a")], "k int, v string").select("k", F.struct("v").alias("nested"))
    with pytest.raises(ValueError):
        write_csv(df, scratch_dir(spark, "nested-csv"))


def test_latest_state_per_record_is_the_records_own_status(spark):
    from autopulse.operators import state
    df = spark.createDataFrame([(1, "v1", "driving"), (2, "v1", "idle")], "seq long, vehicle_id string, status string")
    assert rows(state.latest_state_per_record(df)) == [("v1", 1, "driving"), ("v1", 2, "idle")]


def test_csv_keeps_microseconds(spark):
    import datetime as dt
    from autopulse.session import scratch_dir
    from autopulse.sinks.files import write_csv
    t = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(t, t)], "ntz timestamp_ntz, ltz timestamp")
    path = write_csv(df, scratch_dir(spark, "csv-us"))
    back = spark.read.option("header", True).schema(df.schema).csv(path).first()
    assert back["ntz"] == t and back["ltz"] == t


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.just(float("nan")), st.integers(-5, 5).map(float),
                                 st.floats(-1e6, 1e6, allow_nan=False)), min_size=0, max_size=60),
       buckets=st.sampled_from([2, 3, 16, 256]),
       probs=st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]), min_size=1, max_size=3))
def test_exact_quantiles_property(spark, values, buckets, probs):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = clean.exact_quantiles(df, "x", probs, buckets=buckets).first()
    assert tuple(got) == tuple(reference_quantile(values, p) for p in probs)


def test_small_helpers(spark):
    from autopulse.operators import cabin as cab
    from autopulse.operators import lines as ln
    df = spark.createDataFrame([("NavigationStart", 1.0), ("VoiceCommand", 2.0)], "event_type string, speed double")
    assert rows(events.select_event_type(df, "VoiceCommand", "speed")) == [(2.0,)]
    recs = ln.format_records(spark.createDataFrame([("v1", 3)], "vehicle_id string, n int"), ["vehicle_id", "n"])
    assert recs.first()[0] == "vehicle_id=v1\tn=3"
    summary = {r["summary"]: r for r in clean.describe(spark.createDataFrame([(1.0,), (3.0,)], "x double")).collect()}
    assert summary["count"]["x"] == "2" and float(summary["mean"]["x"]) == 2.0
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "event string, count long")
    assert [r["event"] for r in cab.ordered_event_counts(counts).collect()] == ["c", "a", "b"]


def test_cabin_json_parse_and_etl_edges(spark):
    from autopulse.operators import cabin as cab
    msgs = ['{"vehicle_id":"v1","event":"brake","speed":"12.5","acceleration":-3.1,"ts":"t1"}',
            '{bad json',
            '{"vehicle_id":" ","event":"brake","speed":10,"acceleration":1,"ts":"t2"}',
            '{"vehicle_id":"v2","event":"","speed":10,"acceleration":1,"ts":"t3"}',
            '{"vehicle_id":"v3","event":"x","speed":"abc","acceleration":1,"ts":"t4"}',
            '{"vehicle_id":"v4","event":" go ","speed":null,"acceleration":1,"ts":"t5"}',
            '{"vehicle_id":"v5","event":" go ","speed":7,"acceleration":2.5,"ts":"t6"}']
    recs = spark.createDataFrame([(bytearray(m.encode()),) for m in msgs], "value binary")
    parsed = cab.parse_cabin_json(cab.kafka_values(recs), with_processing_time=False)
    assert parsed.count() == 7 and parsed.filter(F.col("vehicle_id").isNull()).count() == 1   # bad JSON -> NULLs
    assert parsed.filter(F.col("vehicle_id") == "v3").first()["speed"] is None                # 'abc' -> NULL
    etl = cab.valid_cabin_records(parsed, with_processing_time=False)
    assert sorted((r["vehicle_id"], r["event"], r["speed"]) for r in etl.collect()) == [
        ("v1", "brake", 12.5), ("v5", " go ", 7.0)]                                           # values not trimmed


def test_kafka_envelope_columns_and_null_key(spark):
    import datetime as dt
    from autopulse import schemas
    from autopulse.operators import cabin as cab
    recs = spark.createDataFrame([(None, bytearray(b'{"event":"x"}'), "cabin", 2, 7, dt.datetime(2024, 1, 1, 0, 0, 1), 0)],
                                 schemas.KAFKA)
    row = cab.kafka_envelope(recs).first()
    assert row.asDict() == {"message_key": None, "raw_value": '{"event":"x"}', "topic": "cabin", "partition": 2,
                            "offset": 7, "kafka_time": row["kafka_time"]}
    assert row["kafka_time"].startswith("2024-01-01") or row["kafka_time"].startswith("2023-12-31")


def test_cabin_json_takes_the_first_of_a_repeated_key(spark):
    from autopulse.operators import cabin

    values = spark.createDataFrame([('{"vehicle_id":"a","vehicle_id":"b","event":"x","speed":1}',)], "value string")
    assert cabin.parse_cabin_json(values, False).first()["vehicle_id"] == "a"


def test_json_events_keep_every_column(spark, tmp_path):
    from autopulse.sources.files import read_cabin_events_json

    (tmp_path / "e.json").write_text('{"timestamp":"2024-01-01 00:00:00","event_type":"x","screen":"map"}\n')
    assert set(read_cabin_events_json(spark, str(tmp_path)).columns) == {"timestamp", "event_type", "screen"}


def test_json_events_as_variant_in_one_scan(spark, tmp_path):
    from autopulse.sources.files import read_cabin_events_json

    lines_ = ['{"timestamp":"2024-01-01 00:00:00","event_type":"x","it\'s":7,"meta":{"src":"hud","n":[1,2]}}',
              '{"timestamp":"a","timestamp":"b","event_type":"dup","it\'s":8}', "no json", "", '{"event_type":5,"it\'s":"bad"}', "[1]"]
    (tmp_path / "e.json").write_text("\n".join(lines_) + "\n")
    got = read_cabin_events_json(spark, str(tmp_path), columns={"it's": "int", "meta": "struct<src:string,n:array<int>>"})
    assert got.columns == ["timestamp", "event_type", "it's", "meta", "record"]
    rows_ = [tuple(r)[:4] for r in got.collect()]
    assert rows_ == [("2024-01-01 00:00:00", "x", 7, ("hud", [1, 2])), ("b", "dup", 8, None), (None,) * 4,
                     (None, "5", None, None), (None,) * 4]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("parse_json") + plan.count("parseJson") <= 1


@pytest.mark.parametrize("kind", ["distinct", "skewed", "outliers", "two_values"])
def test_exact_quantiles_narrow_the_range_in_rounds(spark, monkeypatch, kind):
    rng = np.random.default_rng(8)
    vals = {"distinct": rng.normal(size=20_000), "skewed": np.where(rng.random(20_000) < 0.6, 5.0, rng.normal(size=20_000) * 9),
            "outliers": np.append(rng.integers(0, 300, 20_000) * 1.0, [1e300, -1e300, np.inf, -np.inf]),
            "two_values": np.repeat([1.0, 2.0], 10_000)}[kind]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(3)
    most = []
    from pyspark.sql.classic.dataframe import DataFrame as Frame
    gather = Frame.collect

    def watched(self):
        out = gather(self)
        most.append(len(out))
        return out
    monkeypatch.setattr(Frame, "collect", watched)
    probs = [0.0, 0.25, 0.5, 0.50005, 0.75, 1.0]
    got = tuple(clean.exact_quantiles(df, "x", probs, buckets=50, held=100).first())
    assert got == tuple(reference_quantile([float(v) for v in vals], p) for p in probs)
    assert max(most, default=0) <= 100


def test_iqr_fence_reaches_the_scan(spark):
    from autopulse.session import scratch_dir
    path = scratch_dir(spark, "fence")
    spark.range(1000).selectExpr("cast(id as double) AS speed").write.parquet(path)
    plan = clean.iqr_outliers(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(speed," in plan and "GreaterThan(speed," in plan


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_windows_are_counted_by_pane(spark, zone):
    """Against a loop over rows; the batch and the stream form, in a zone whose clocks go back in between."""
    import datetime as dt
    from collections import Counter

    from autopulse.operators import windows
    from autopulse.session import scratch_dir
    from autopulse.streaming import batches, runner

    t0 = dt.datetime(2024, 11, 3, 0, 59, 55)   # the hour from 01:00 comes twice in Los Angeles
    rnd = random.Random(2)
    recs = [(t0 + dt.timedelta(seconds=rnd.uniform(0, 7500)), f"{rnd.choice([-9, -5, 1])} x -6") for _ in range(300)]
    want = Counter()
    for t, text in recs:
        n = sum(1 for w in text.split() if w.lstrip("-").isdigit() and int(w) < -5)
        last = int((t - dt.datetime(1970, 1, 1)).total_seconds()) // 10 * 10
        for k in range(6):
            want[dt.datetime(1970, 1, 1) + dt.timedelta(seconds=last - 10 * k)] += n
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(recs, "ts timestamp_ntz, value string")
        batch = windows.brake_window_counts(df)
        assert {r["window_start"]: r["count"] for r in batch.collect()} == want
        plan = batch._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Generate explode(transform") < plan.rindex("partial_count(1)")   # panes first (plans print top-down)
        path, base = scratch_dir(spark, "pane-in"), scratch_dir(spark, "pane-out")
        df.repartition(3).write.parquet(path)
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
        runner.run_to_end(runner.start_foreach_batch(
            batches.brake_pane_stream(stream), batches.brake_pane_batch(base + "/out", base + "/panes"), base + "/ck",
            "update", available_now=True))
        got = batches.read_brake_windows(spark, base + "/panes")
        assert {r["window_start"]: r["count"] for r in got.collect()} == want
        # what the batches wrote, folded, is the same report
        folded = runner.read_latest_updates(spark, base + "/out", ["window_start", "window_end"])
        assert {r["window_start"]: r["count"] for r in folded.collect()} == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_message_is_parsed_once(spark):
    from autopulse.operators import cabin
    rows_ = [('{"event":null,"event":"b","vehicle_id":"v","speed":1.50,"acceleration":"2","ts":{"a": 1}}',), ("bad",),
             ('{"event":"a","event":"z","speed":NaN}',), ('{"event":"a","vehicle_id":"w","speed":1,"acceleration":0}',), (None,)]
    raw = spark.createDataFrame(rows_, "value string")
    parsed = cabin.parse_cabin_json(raw, with_processing_time=False)
    want = [tuple(r) for r in raw.selectExpr(
        "get_json_object(value, '$.vehicle_id')", "get_json_object(value, '$.event')",
        "try_cast(get_json_object(value, '$.speed') AS DOUBLE)", "try_cast(get_json_object(value, '$.acceleration') AS DOUBLE)",
        "get_json_object(value, '$.ts')").collect()]
    assert [tuple(r) for r in parsed.collect()] == want
    records = raw.selectExpr("cast(value AS binary) AS value")
    plan = cabin.cabin_etl(records)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    plan = cabin.event_counts(records)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("get_json_object") == 1


def test_join_meets_instants_in_a_repeated_hour(spark):
    """01:30 comes twice in Los Angeles on 2024-11-03; TIMESTAMP keys are the instants, texts may name a zone."""
    import datetime as dt

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        first, second = 1730622600, 1730626200   # 01:30 PDT and 01:30 PST
        st = spark.createDataFrame([(first, 10.0, 1.0), (second, 20.0, 2.0)], "t long, speed double, rpm double").select(
            F.timestamp_seconds("t").alias("timestamp"), "speed", "rpm")
        ev = spark.createDataFrame([(second, "NavigationStart"), (second, "VoiceCommand")], "t long, event_type string").select(
            F.timestamp_seconds("t").alias("timestamp"), "event_type")
        text = spark.createDataFrame([("2024-11-03T09:30:00Z", "NavigationStart"), ("2024-11-03 01:30:00-08:00", "VoiceCommand"),
                                      ("bad", "VoiceCommand")], "timestamp string, event_type string")
        for events_ in (ev, text):
            joined = joins.join_events_status(events_, st)
            assert sorted((r["event_type"], r["speed"]) for r in joined.collect()) == [("NavigationStart", 20.0), ("VoiceCommand", 20.0)]
            assert joins.join_row_count(events_, st).first()[0] == 2
            assert [r["speed"] for r in joins.navigation_events(events_, st).collect()] == [20.0]
            assert rows(joins.navigation_speed_histogram(events_, st)) == [("0-30km/h", 1)]
            assert joins.voice_rpm_stats(events_, st).first()["max_rpm"] == 2.0
            assert joins.preview_join(events_, st, 5).count() == 2
        wall = spark.createDataFrame([(dt.datetime(2024, 11, 3, 1, 30), 5.0, 9.0)], "timestamp timestamp_ntz, speed double, rpm double")
        plain = spark.createDataFrame([("2024-11-03 01:30:00", "NavigationStart")], "timestamp string, event_type string")
        assert joins.join_row_count(plain, wall).first()[0] == 1   # wall clocks on both sides
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
