"""Stream = batch: each streaming operator over several micro-batches equals its batch twin."""

import pytest
from pyspark.sql import functions as F

from autopulse.operators import cabin, lines, state
from autopulse.session import scratch_dir
from autopulse.sources import testbed as tb
from autopulse.streaming import batches, runner
from autopulse.streaming import state as sstate
from conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def split_events(spark):
    """The sf0.001 events written as 4 files in event_id order (4 micro-batches at 1 file per trigger)."""
    import os
    import time

    path = scratch_dir(spark, "events-split")
    ev = tb.table(spark, SF_SMALL, "events")
    ev.repartitionByRange(4, "event_id").sortWithinPartitions("event_id").write.parquet(path)
    # the file source orders files by modification time: make it follow event_id
    parts = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    now = time.time()
    for i, f in enumerate(parts):
        os.utime(os.path.join(path, f), (now - 100 + i, now - 100 + i))
    return path, ev.schema


def stream_of(spark, split_events, max_files=1):
    path, schema = split_events
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def run_append(spark, df, name):
    base = scratch_dir(spark, name)
    runner.run_to_end(runner.start_parquet_append(df, base + "/out", base + "/ckpt", available_now=True))
    return spark.read.parquet(base + "/out")


def test_overspeed_stream_equals_batch_over_batches(spark, split_events):
    speeds = lines.parse_speed_lines(tb.speed_lines_from_events(stream_of(spark, split_events)))
    got = run_append(spark, sstate.overspeed_alert_stream(speeds, seq="event_id", threshold=60.0), "os")
    batch_speeds = lines.parse_speed_lines(tb.speed_lines_from_events(tb.table(spark, SF_SMALL, "events")))
    want = state.overspeed_alert(batch_speeds, seq="event_id", threshold=60.0, chunk_size=64)
    assert rows(got) == rows(want.select(*got.columns))
    assert got.agg(F.max("consecutive_overspeed_count")).first()[0] >= 2


def test_driving_stream_equals_batch(spark, split_events):
    st = lines.parse_status_lines(tb.status_lines_from_events(stream_of(spark, split_events)))
    got = run_append(spark, sstate.driving_duration_stream(st, seq="event_id"), "drive")
    bst = lines.parse_status_lines(tb.status_lines_from_events(tb.table(spark, SF_SMALL, "events")))
    assert rows(got) == rows(state.driving_duration(bst, seq="event_id", chunk_size=50).select(*got.columns))


def test_restart_resumes_state_without_double_counting(spark, split_events):
    path, schema = split_events
    base = scratch_dir(spark, "restart")
    files = sorted(p for p in __import__("os").listdir(path) if p.endswith(".parquet"))
    inbox = base + "/inbox"
    import os
    import shutil
    os.makedirs(inbox)
    for f in files[:2]:
        shutil.copy(os.path.join(path, f), inbox)

    def run():
        src = spark.readStream.schema(schema).parquet(inbox)
        st = lines.parse_status_lines(tb.status_lines_from_events(src))
        q = runner.start_parquet_append(sstate.driving_duration_stream(st, seq="event_id"), base + "/out",
                                        base + "/ckpt", available_now=True)
        runner.run_to_end(q)

    run()
    for f in files[2:]:
        shutil.copy(os.path.join(path, f), inbox)
    run()
    got = spark.read.parquet(base + "/out")
    bst = lines.parse_status_lines(tb.status_lines_from_events(tb.table(spark, SF_SMALL, "events")))
    assert rows(got) == rows(state.driving_duration(bst, seq="event_id").select(*got.columns))


def test_event_count_complete_mode(spark, split_events):
    counts = cabin.event_counts(tb.kafka_records_from_events(stream_of(spark, split_events)))
    base = scratch_dir(spark, "evcount")
    runner.run_to_end(runner.start_foreach_batch(counts, runner.overwrite_snapshot(base + "/out"), base + "/ckpt",
                                                 "complete", available_now=True))
    got = runner.read_snapshot(spark, base + "/out")
    want = cabin.event_counts(tb.kafka_records_from_events(tb.table(spark, SF_SMALL, "events")))
    assert rows(got) == rows(want)
    ordered = cabin.ordered_event_counts(got).collect()
    assert [r["count"] for r in ordered] == sorted((r["count"] for r in ordered), reverse=True)


def test_brake_window_update_mode_equals_batch(spark, split_events):
    from autopulse.operators.windows import brake_window_counts
    s = batches.brake_window_stream(tb.numeric_lines_from_events(stream_of(spark, split_events)), threshold=-3.0)
    base = scratch_dir(spark, "brake")
    runner.run_to_end(runner.start_foreach_batch(s, runner.overwrite_batch(base + "/out"), base + "/ckpt", "update",
                                                 available_now=True))
    got = runner.read_latest_updates(spark, base + "/out", ["window_start", "window_end"])
    want = brake_window_counts(tb.numeric_lines_from_events(tb.table(spark, SF_SMALL, "events")), threshold=-3.0)
    assert rows(got) == rows(want.select(*got.columns))


def test_raw_lines_numbered_per_batch_and_text_files(spark, split_events):
    raw = tb.speed_lines_from_events(stream_of(spark, split_events)).select("event_id", "value")
    base = scratch_dir(spark, "raw")
    runner.run_to_end(runner.start_foreach_batch(raw, batches.raw_lines_batch(base + "/out", "event_id",
                                                                              base + "/text", chunk_size=16),
                                                 base + "/ckpt", available_now=True))
    got = spark.read.parquet(base + "/out")
    assert got.select("batch_id").distinct().count() == 4
    per_batch = got.groupBy("batch_id").agg(F.min("record_no"), F.max("record_no"), F.count(F.lit(1))).collect()
    assert all(r[1] == 1 and r[2] == r[3] for r in per_batch)
    text = spark.read.text(base + "/text/raw_stream_*")
    assert text.count() == got.count()
    # the text records and the Parquet copy of a batch carry the same batch time
    text_times = {r[0] for r in text.select(F.regexp_extract("value", r"^batch_time=([^\t]*)", 1)).distinct().collect()}
    assert text_times == {r[0] for r in got.select("batch_time").distinct().collect()}
    assert text.filter(~F.col("value").rlike(r"^batch_time=\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\trecord_no=\d+\traw_data=")).count() == 0


def test_cabin_etl_file_sink_is_exactly_once(spark, split_events):
    recs = tb.kafka_records_from_events(stream_of(spark, split_events, max_files=2))
    base = scratch_dir(spark, "etl")
    for _ in range(2):   # the second run finds nothing new on the same checkpoint
        runner.run_to_end(runner.start_parquet_append(cabin.cabin_etl(recs), base + "/out", base + "/ckpt",
                                                      available_now=True))
    got = spark.read.parquet(base + "/out").drop("processing_time")
    want = cabin.cabin_etl(tb.kafka_records_from_events(tb.table(spark, SF_SMALL, "events")), False)
    assert rows(got) == rows(want)


def test_latest_state_update_mode_over_batches(spark, split_events):
    st = lines.parse_status_lines(tb.status_lines_from_events(stream_of(spark, split_events)))
    base = scratch_dir(spark, "latest")
    runner.run_to_end(runner.start_foreach_batch(sstate.latest_state_snapshot(st, seq="event_id"),
                                                 runner.overwrite_batch(base + "/out"), base + "/ckpt", "update",
                                                 available_now=True))
    got = runner.read_latest_updates(spark, base + "/out", ["vehicle_id"])
    assert spark.read.parquet(base + "/out").select("batch_id").distinct().count() == 4
    bst = lines.parse_status_lines(tb.status_lines_from_events(tb.table(spark, SF_SMALL, "events")))
    assert rows(got) == rows(state.latest_state(bst, seq="event_id"))


def test_brake_window_complete_mode_without_watermark(spark, split_events):
    from autopulse.operators.windows import brake_window_counts
    s = batches.brake_window_stream(tb.numeric_lines_from_events(stream_of(spark, split_events)), threshold=-3.0,
                                    watermark=None)
    base = scratch_dir(spark, "brake-complete")
    runner.run_to_end(runner.start_foreach_batch(s, runner.overwrite_snapshot(base + "/out"), base + "/ckpt",
                                                 "complete", available_now=True))
    got = runner.read_snapshot(spark, base + "/out")
    want = brake_window_counts(tb.numeric_lines_from_events(tb.table(spark, SF_SMALL, "events")), threshold=-3.0)
    assert rows(got) == rows(want.select(*got.columns))


@pytest.mark.parametrize("n_files", [2, 7])
def test_state_streams_equal_batch_for_other_batch_boundaries(spark, n_files):
    import os
    import time
    ev = tb.table(spark, SF_SMALL, "events")
    path = scratch_dir(spark, f"events-split-{n_files}")
    ev.repartitionByRange(n_files, "event_id").sortWithinPartitions("event_id").write.parquet(path)
    now = time.time()
    for i, f in enumerate(sorted(f for f in os.listdir(path) if f.endswith(".parquet"))):
        os.utime(os.path.join(path, f), (now - 100 + i, now - 100 + i))
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)
    speeds = lines.parse_speed_lines(tb.speed_lines_from_events(src))
    got = run_append(spark, sstate.overspeed_run_stream(speeds, seq="event_id", threshold=60.0), f"os-{n_files}")
    want = state.overspeed_run(lines.parse_speed_lines(tb.speed_lines_from_events(ev)), seq="event_id",
                               threshold=60.0, chunk_size=97)
    assert rows(got) == rows(want.select(*got.columns))


def test_complete_mode_restart_counts_everything_once(spark, split_events):
    import os
    import shutil
    path, schema = split_events
    base = scratch_dir(spark, "evcount-restart")
    inbox = base + "/inbox"
    os.makedirs(inbox)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))

    def run():
        counts = cabin.event_counts(tb.kafka_records_from_events(spark.readStream.schema(schema).parquet(inbox)))
        runner.run_to_end(runner.start_foreach_batch(counts, runner.overwrite_snapshot(base + "/out"),
                                                     base + "/ckpt", "complete", available_now=True))

    shutil.copy(os.path.join(path, files[0]), inbox)
    run()
    for f in files[1:]:
        shutil.copy(os.path.join(path, f), inbox)
    run()
    got = runner.read_snapshot(spark, base + "/out")
    want = cabin.event_counts(tb.kafka_records_from_events(tb.table(spark, SF_SMALL, "events")))
    assert rows(got) == rows(want)


def test_driving_time_snapshot_equals_batch_totals(spark, split_events):
    st = lines.parse_status_lines(tb.status_lines_from_events(stream_of(spark, split_events)))
    base = scratch_dir(spark, "drive-snap")
    runner.run_to_end(runner.start_foreach_batch(sstate.driving_time_snapshot(st), runner.overwrite_batch(base + "/out"),
                                                 base + "/ckpt", "update", available_now=True))
    got = runner.read_latest_updates(spark, base + "/out", ["vehicle_id"])
    bst = lines.parse_status_lines(tb.status_lines_from_events(tb.table(spark, SF_SMALL, "events")))
    want = (state.driving_duration(bst, seq="event_id").groupBy("vehicle_id")
            .agg(F.max("total_driving_seconds").alias("total_driving_seconds")))
    assert rows(got) == rows(want)


def test_console_preview_runs(spark, split_events):
    from autopulse.operators.cabin import kafka_envelope
    q = runner.start_console(kafka_envelope(tb.kafka_records_from_events(stream_of(spark, split_events))),
                             num_rows=3, available_now=True, checkpoint=scratch_dir(spark, "console") + "/ckpt")
    runner.run_to_end(q)
    assert q.lastProgress is not None and q.lastProgress["numInputRows"] >= 0


def test_batch_text_sink_skips_empty_batches(spark):
    import os
    base = scratch_dir(spark, "k9")
    empty = spark.createDataFrame([], "value string")
    assert batches.write_batch_text(empty, base, "raw_stream", 3) == ""
    assert not os.path.exists(base)
    path = batches.write_batch_text(spark.createDataFrame([("a",), ("b",)], "value string"), base, "raw_stream", 4)
    assert path.endswith("raw_stream_000000004") and spark.read.text(path).count() == 2
    # a re-run of the same batch replaces its output (idempotent)
    batches.write_batch_text(spark.createDataFrame([("c",)], "value string"), base, "raw_stream", 4)
    assert [r[0] for r in spark.read.text(path).collect()] == ["c"]


def test_table_stream_reads_single_files_and_folders_of_part_files(spark):
    import os

    from autopulse.plans.catalog import QUERIES

    docs = spark.createDataFrame([(i, "en", "s", f"alpha beta{i % 3}\tgamma") for i in range(30)],
                                 "doc_id long, lang string, source string, text string")
    base = scratch_dir(spark, "tables")
    docs.repartition(3).write.parquet(f"{base}/parts/documents.parquet")
    docs.coalesce(1).write.parquet(f"{base}/one-part")
    os.makedirs(f"{base}/single")
    part = next(f for f in os.listdir(f"{base}/one-part") if f.endswith(".parquet"))
    os.link(f"{base}/one-part/{part}", f"{base}/single/documents.parquet")
    want = [("alpha", 30), ("beta0", 10), ("beta1", 10), ("beta2", 10), ("gamma", 30)]
    for form in ("parts", "single"):
        counts = QUERIES["stream_word_count"](spark, f"{base}/{form}")
        assert rows(counts, "batch_id", "word", "count") == [(0, w, n) for w, n in want]
        records = QUERIES["sink_batch_files"](spark, f"{base}/{form}")
        assert rows(records) == [(f"word={w}\tcount={n}",) for w, n in want]


def test_brake_window_batches_have_more_files_with_more_events(spark, monkeypatch):
    from autopulse.plans import catalog

    made = []
    monkeypatch.setattr(catalog, "scratch_dir", lambda s, name: made.append(scratch_dir(s, name)) or made[-1])
    monkeypatch.setattr(catalog, "EVENTS_A_FILE", 50)
    ran = []
    monkeypatch.setattr(runner, "run_to_end", lambda q, run=runner.run_to_end: (run(q), ran.append(q)))
    got = catalog.QUERIES["stream_brake_window"](spark, SF_SMALL)
    dealt = spark.read.parquet(next(p for p in made if "brake-events" in p))
    n = tb.table(spark, SF_SMALL, "events").count()
    assert dealt.count() == n and n / 50 <= len(dealt.inputFiles()) <= n / 50 + 8
    assert sum(p["numInputRows"] > 0 for p in ran[0].recentProgress) == 4
    assert rows(got) == rows(catalog.QUERIES["brake_window"](spark, SF_SMALL).select(*got.columns))
