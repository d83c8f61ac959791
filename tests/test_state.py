import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from autopulse.operators import lines, state
from autopulse.operators.scan import ordered_scan
from autopulse.streaming.state import run_lengths
from conftest import rows


def loop_runs(records, threshold):
    """The reference's update function as a plain loop (records in seq order)."""
    count, out = {}, []
    for seq, vid, speed in sorted(records):
        prev = count.get(vid, 0)
        new = prev + 1 if (speed is not None and speed > threshold) else 0   # NaN > t is False in Python
        count[vid] = new
        out.append((vid, seq, speed, new))
    return out


speed_st = st.one_of(st.floats(0, 200, allow_nan=False), st.just(float("nan")))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.sampled_from(["a", "b", "hot"]), speed_st), min_size=1, max_size=60),
       chunk=st.sampled_from([1, 3, 7, 1000]))
def test_overspeed_run_matches_loop(spark, data, chunk):
    records = [(i, v, s) for i, (v, s) in enumerate(data)]
    df = spark.createDataFrame(records, "seq long, vehicle_id string, speed double")
    got = rows(state.overspeed_run(df, threshold=100.0, chunk_size=chunk))
    want = loop_runs(records, 100.0)
    assert [(g[0], g[1], g[3]) for g in got] == sorted([(w[0], w[1], w[3]) for w in want], key=repr)


def test_run_lengths_vectorised():
    rnd = random.Random(1)
    for _ in range(50):
        over = [rnd.random() < 0.6 for _ in range(rnd.randint(1, 30))]
        carried = rnd.randint(0, 5)
        c, want = carried, []
        for o in over:
            c = c + 1 if o else 0
            want.append(c)
        import numpy as np
        assert list(run_lengths(np.array(over), carried)) == want


def test_driving_duration_and_latest_state(spark):
    recs = [(1, "v1", "driving"), (2, "v1", "parked"), (3, "v2", "driving"), (4, "v1", "driving"),
            (5, "v2", "driving"), (6, "v1", "idle")]
    df = spark.createDataFrame(recs, "seq long, vehicle_id string, status string")
    for chunk in (1, 2, 100):
        got = rows(state.driving_duration(df, chunk_size=chunk), "seq", "total_driving_seconds")
        assert got == [(1, 5), (2, 5), (3, 5), (4, 10), (5, 10), (6, 10)]
    assert dict(rows(state.latest_state(df))) == {"v1": "idle", "v2": "driving"}


def test_alert_keeps_firing(spark):
    recs = [(i, "v1", float(s)) for i, s in enumerate([130, 130, 130, 130, 90, 130])]
    df = spark.createDataFrame(recs, "seq long, vehicle_id string, speed double")
    got = [r["alert"] for r in state.overspeed_alert(df).orderBy("seq").collect()]
    assert got == ["WAITING", "WAITING", "TRIGGERED", "TRIGGERED", "WAITING", "WAITING"]


def test_record_positions_without_keys(spark):
    df = spark.createDataFrame([(i * 3, str(i)) for i in range(50)], "seq long, value string")
    got = ordered_scan(df, [], "seq", chunk_size=8).select("seq", "_pos").orderBy("seq").collect()
    assert [r[1] for r in got] == list(range(1, 51))


def test_null_keys_and_orders_are_scanned(spark):
    recs = [(3, None), (1, None), (None, None), (2, "a"), (None, "a"), (5, "a")]
    df = spark.createDataFrame(recs, "seq long, vehicle_id string")
    got = rows(ordered_scan(df, ["vehicle_id"], "seq", chunk_size=1), "vehicle_id", "seq", "_pos")
    assert got == sorted([(None, None, 1), (None, 1, 2), (None, 3, 3), ("a", None, 1), ("a", 2, 2), ("a", 5, 3)],
                         key=repr)


def test_chunks_follow_the_rows_of_a_key(spark):
    """A fleet of small vehicles takes one chunk each; only the hot one is cut."""
    from autopulse.operators.scan import with_chunks

    hot, fleet, per = 20_000, 5_000, 4
    df = spark.range(hot + fleet * per).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id") % 9973).alias("k"))
    n = df.count()
    sizes = with_chunks(df, ["k"], "seq", 1000).groupBy("k", "_chunk").count()
    keys, carry, most = df.select("k").distinct().count(), sizes.count(), sizes.agg(F.max("count")).first()[0]
    assert carry <= keys + n / 1000 and most <= 1001
    assert sizes.where("k = -1").count() == 20


def test_carried_batches_equal_batch(spark):
    """State over micro-batches, one of them run twice, equals the batch form; a vehicle is missing in between."""
    import tempfile

    from autopulse.streaming import carried

    speeds = [130, 130, 90, 130, 130, 130, 130, 50, 130, 130, 130, 130]
    recs = [(i, "v1" if i % 3 else None, float(s)) for i, s in enumerate(speeds)]
    recs += [(100 + i, "v2", 130.0) for i in range(2)] + [(110 + i, "v1", 130.0) for i in range(5)]
    df = spark.createDataFrame(recs, "seq long, vehicle_id string, speed double")
    status = df.select("seq", "vehicle_id", F.when(F.col("speed") > 100, "driving").otherwise("idle").alias("status"))
    base = tempfile.mkdtemp()
    alerts = carried.overspeed_run_batch(base + "/a", base + "/ac", alert_count=3, chunk_size=2)
    drives = carried.driving_duration_batch(base + "/d", base + "/dc", chunk_size=2)
    for batch_id, (lo, hi) in enumerate([(0, 5), (5, 101), (101, 105), (105, 200)]):
        for _ in range(2 if batch_id == 1 else 1):
            alerts(df.where(f"seq >= {lo} AND seq < {hi}"), batch_id)
            drives(status.where(f"seq >= {lo} AND seq < {hi}"), batch_id)
    cols = ["vehicle_id", "seq", "speed", "consecutive_overspeed_count", "alert"]
    assert rows(spark.read.parquet(base + "/a"), *cols) == rows(state.overspeed_alert(df), *cols)
    cols = ["vehicle_id", "seq", "latest_status", "total_driving_seconds"]
    assert rows(spark.read.parquet(base + "/d"), *cols) == rows(state.driving_duration(status), *cols)


def test_one_wrong_stamp_does_not_undo_the_chunks(spark):
    """Cuts follow ranks: outliers, clustered and equal stamps give chunks of at most twice the bound."""
    from autopulse.operators.scan import with_chunks

    n = 30_000
    ids = spark.range(n).select(F.col("id").alias("seq"), F.lit("v").alias("k"))
    far = ids.unionByName(spark.createDataFrame([(1 << 60, "v"), (-(1 << 60), "v")], "seq long, k string"))
    near = ids.select((F.pow(F.lit(10.0), F.col("seq") / 100) ).alias("t"), "seq", "k")
    equal = ids.select(F.when(F.col("seq") % 10 > 0, 7.0).alias("t"), "seq", "k")
    odd = ids.select(F.when(F.col("seq") % 3 == 0, float("nan")).otherwise(float("-inf")).alias("t"), "seq", "k")
    for df, order in [(far, ["seq"]), (near, ["t", "seq"]), (equal, ["t", "seq"]), (odd, ["t", "seq"])]:
        sizes = with_chunks(df, ["k"], order, 500).groupBy("_chunk").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("lo"), F.max(F.struct(*order)).alias("hi"))
        got = sorted(sizes.collect())
        assert sum(r["n"] for r in got) == df.count() and max(r["n"] for r in got) <= 1000
        place = ordered_scan(df, ["k"], order, chunk_size=500)
        want = F.row_number().over(Window.partitionBy("k").orderBy(*order))
        assert place.withColumn("want", want).where("_pos <> want").count() == 0


def test_chunks_deeper_than_one_fan(spark):
    from autopulse.operators.scan import with_chunks

    df = spark.range(12_000).select((F.col("id") * F.col("id")).alias("seq"))
    sizes = [r["count"] for r in with_chunks(df, [], "seq", 20).groupBy("_chunk").count().collect()]
    assert max(sizes) <= 40 and len(sizes) <= 2 * 12_000 / 20


def test_keyed_table_writes_what_the_batch_holds(spark):
    import os
    import tempfile

    from autopulse.streaming.keyed import KeyedTable

    def size(base):
        return {n: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{base}/{n}") for f in fs if f.endswith(".parquet"))
                for n in os.listdir(base) if not n.startswith("_")}

    base = tempfile.mkdtemp()
    table = KeyedTable(spark, base, "k string, v long", ["k"], bucket_rows=4000)
    fleet = spark.range(40_000).select(F.col("id").cast("string").alias("k"), F.lit(0).cast("long").alias("v"))
    table.put(fleet, 0)
    want = {str(i): 0 for i in range(40_000)}
    whole = sum(size(base).values())
    for batch_id in range(1, 9):
        rows = {str(i * 7 % 40_000): batch_id for i in range(batch_id * 10, batch_id * 10 + 30)} | {None: batch_id}
        table.put(spark.createDataFrame(list(rows.items()), "k string, v long"), batch_id)
        want |= rows
        grown = size(base)
        assert sum(b for n, b in grown.items() if not n.endswith("-0")) < whole / 10   # the first run is not rewritten
        assert len(grown) <= 8                                                        # and old runs are gone
    got = {r["k"]: r["v"] for r in table.all().collect()}
    assert got == want
    asked = spark.createDataFrame([("7",), (None,), ("absent",)], "k string")
    assert {r["k"]: r["v"] for r in table.lookup(asked).collect()} == {k: want[k] for k in ("7", None)}


def test_keyed_batch_that_fails_before_its_commit_runs_again(spark, monkeypatch):
    import tempfile

    import pytest

    from autopulse.sinks.manifest import Manifest
    from autopulse.streaming import carried

    df = spark.createDataFrame([(i, f"v{i % 3}", 130.0) for i in range(40)], "seq long, vehicle_id string, speed double")
    base = tempfile.mkdtemp()
    run = carried.overspeed_run_batch(base + "/o", base + "/c", alert_count=3, chunk_size=4)
    run(df.where("seq < 10"), 0)
    with monkeypatch.context() as m:
        m.setattr(Manifest, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            run(df.where("seq >= 10 AND seq < 25"), 1)
    run(df.where("seq >= 10 AND seq < 25"), 1)
    run(df.where("seq >= 10 AND seq < 25"), 1)   # and once more after its commit
    run(df.where("seq >= 25"), 2)
    cols = ["vehicle_id", "seq", "speed", "consecutive_overspeed_count", "alert"]
    assert rows(spark.read.parquet(base + "/o"), *cols) == rows(state.overspeed_alert(df), *cols)
    with pytest.raises(FileNotFoundError):   # a lost state folder is not taken for an empty one
        carried.overspeed_run_batch(base + "/o2", base + "/none")(df, 3)


EDGE_LINES = [("v1,130", ("v1", 130.0)), (" v1 , 130 ", ("v1", 130.0)), ("v1,120,,", ("v1", 120.0)),
              ("v1,", None), (",5", None), ("v1,abc", None), ("v1,1,2", None), ("v1,120, ", None),
              ("v1,NaN", ("v1", "nan")), ("", None), ("v1,inf", None), ("v1,Infinity", ("v1", math.inf))]


def test_speed_line_edges(spark):
    df = spark.createDataFrame([(i, l) for i, (l, _) in enumerate(EDGE_LINES)], "seq long, value string")
    got = {r["seq"]: (r["vehicle_id"], r["speed"]) for r in lines.parse_speed_lines(df).collect()}
    for i, (_, want) in enumerate(EDGE_LINES):
        if want is None:
            assert i not in got
        elif want[1] == "nan":
            assert got[i][0] == "v1" and math.isnan(got[i][1])
        else:
            assert got[i] == want


def test_status_lines_lower_case(spark):
    df = spark.createDataFrame([("v1,DRIVING",), ("v2,",), ("v3, Idle ,",)], "value string")
    assert rows(lines.parse_status_lines(df)) == [("v1", "driving"), ("v3", "idle")]


def test_word_count_per_batch(spark):
    df = spark.createDataFrame([(1, "spark streaming"), (1, "spark spark window"), (2, "  driver  ")],
                               "batch int, value string")
    assert rows(lines.word_count(df, by=["batch"])) == [(1, "spark", 3), (1, "streaming", 1), (1, "window", 1),
                                                          (2, "driver", 1)]


def test_brake_tokens_from_sample_messages(spark):
    msgs = ["-1.2", "-3.8", "-5.1", "-6.0", "-2.4", "-7.3", "0.4"]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    got = lines.below_threshold(lines.parse_numeric_tokens(df)).collect()
    assert sorted(r["number"] for r in got) == [-7.3, -6.0, -5.1]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.sampled_from(["a", "hot"]), st.integers(0, 40), speed_st), min_size=1, max_size=50),
       chunk=st.sampled_from([1, 5, 3600]))
def test_overspeed_run_by_time_with_tie_break(spark, data, chunk):
    import datetime as dt
    t0 = dt.datetime(2024, 3, 10, 1, 59, 50)   # seconds around a DST change in some zones
    records = [(t0 + dt.timedelta(seconds=s), i, v, sp) for i, (v, s, sp) in enumerate(data)]
    df = spark.createDataFrame(records, "ts timestamp_ntz, id long, vehicle_id string, speed double")
    from autopulse.operators.state import is_overspeed
    scanned = ordered_scan(df, ["vehicle_id"], ["ts", "id"], reset_when=~is_overspeed(F.col("speed"), 100.0),
                           chunk_size=chunk)
    got = sorted((r["vehicle_id"], r["id"], r["_run"]) for r in scanned.collect())
    ordered = sorted(records, key=lambda r: (r[0], r[1]))
    count, want = {}, []
    for ts, i, v, sp in ordered:
        count[v] = count.get(v, 0) + 1 if sp > 100.0 else 0
        want.append((v, i, count[v]))
    assert got == sorted(want)


def test_state_operators_accept_a_multi_column_order(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    recs = [(t, 2, "v1", "driving"), (t, 1, "v1", "parked"), (t + dt.timedelta(seconds=1), 0, "v1", "driving")]
    df = spark.createDataFrame(recs, "ts timestamp_ntz, id long, vehicle_id string, status string")
    got = [r["total_driving_seconds"] for r in state.driving_duration(df, seq=["ts", "id"]).orderBy("ts", "id").collect()]
    assert got == [0, 5, 10]
    assert dict(rows(state.latest_state(df, seq=["ts", "id"]))) == {"v1": "driving"}


def test_hot_vehicle_is_spread_over_tasks(spark):
    """A vehicle holding almost all rows is scanned by many tasks, not one."""
    from autopulse.operators.scan import ordered_scan
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20000).select(F.col("id").alias("seq"),
                                       F.when(F.col("id") % 50 == 0, "cold").otherwise("hot").alias("vehicle_id"))
        out = ordered_scan(df, ["vehicle_id"], "seq", chunk_size=1000)
        hot = out.filter(F.col("vehicle_id") == "hot")
        tasks = hot.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 1
        pos = [r[0] for r in hot.orderBy("seq").select("_pos").collect()]
        assert pos == list(range(1, len(pos) + 1))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)


def test_window_start_offset(spark):
    import datetime as dt
    from autopulse.operators.windows import window_counts
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    df = spark.createDataFrame([(t0 + dt.timedelta(seconds=s),) for s in (3, 12, 14)], "ts timestamp_ntz")
    plain = {(r["window_start"].second, r["count"]) for r in window_counts(df, "ts", 10, 10).collect()}
    assert plain == {(0, 1), (10, 2)}
    shifted = {(r["window_start"].second, r["count"]) for r in window_counts(df, "ts", 10, 10,
                                                                             start_offset_seconds=5).collect()}
    assert shifted == {(55, 1), (5, 2)}


def test_tumbling_windows_and_validation(spark):
    import datetime as dt

    import pytest
    from autopulse.operators.windows import window_counts
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t0 + dt.timedelta(seconds=s),) for s in (1, 59, 60, 61, 200)], "ts timestamp_ntz")
    got = sorted((r["window_start"].minute, r["count"]) for r in window_counts(df, "ts", 60, 60).collect())
    assert got == [(0, 2), (1, 2), (3, 1)]          # each row in exactly one window
    with pytest.raises(ValueError):
        window_counts(df, "ts", 60, 25)
