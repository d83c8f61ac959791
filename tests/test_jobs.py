"""The reference's jobs end to end on data derived from the sf0.001 tables."""

import os

from pyspark.sql import functions as F

from autopulse.operators import aggregate, clean, joins, lines, state
from autopulse.operators.events import add_event_flags
from autopulse.plans import jobs
from autopulse.plans.catalog import _as_text
from autopulse.session import scratch_dir
from autopulse.sinks.files import write_csv
from autopulse.sources import testbed as tb
from autopulse.streaming import runner
from autopulse.streaming.batches import number_records
from autopulse.streaming.sources import read_kafka_replay, read_line_stream
from conftest import SF_SMALL, rows


def test_flagship_job_from_csv(spark):
    tel = tb.telemetry_from_events(tb.table(spark, SF_SMALL, "events"))
    csv = scratch_dir(spark, "tel-csv")
    write_csv(_as_text(tel), csv)
    out = scratch_dir(spark, "flagship-job")
    written = jobs.flagship_job(spark, csv, out)
    assert len(written) == 8
    got = spark.read.parquet(f"{out}/vehicle_scores_parquet")
    assert rows(got) == rows(aggregate.vehicle_scores(add_event_flags(tel)))
    # fixed-size results are single CSV files, the fleet-sized one is not forced to one task
    assert len([f for f in os.listdir(f"{out}/hourly_events") if f.endswith(".csv")]) == 1


def test_cleaning_job(spark):
    e = tb.table(spark, SF_SMALL, "events")
    raw = tb.sensors_from_events(e).drop("speed").join(e.select("event_id", F.col("value").alias("speed")), "event_id")
    csv = scratch_dir(spark, "sensors-csv")
    write_csv(_as_text(raw), csv)
    out = scratch_dir(spark, "cleaning-job")
    res = jobs.cleaning_job(spark, csv, out)
    sensors = tb.sensors_from_events(e)
    cleaned = spark.read.parquet(f"{out}/cleaned_sensors_parquet")
    assert cleaned.count() == clean.clean_sensors(sensors).count()
    assert cleaned.filter(F.col("temp").isNull()).count() == 0
    prof = res["raw_profile"].first()
    assert prof["total_records"] == sensors.count() and prof["lower_bound"] < prof["upper_bound"]
    outliers = spark.read.parquet(f"{out}/original_outliers_iqr_parquet")
    assert outliers.count() == clean.iqr_outliers(sensors).count()
    assert res["raw_describe"].count() == 5
    assert res["raw_outliers_preview"].count() == min(10, outliers.count())


def test_join_jobs(spark):
    cab = tb.cabin_events_from_orders(tb.table(spark, SF_SMALL, "orders"))
    st = tb.status_from_lineitem(tb.table(spark, SF_SMALL, "lineitem"))
    ev_path, st_path = scratch_dir(spark, "cabin-json"), scratch_dir(spark, "status-pq")
    cab.withColumn("timestamp", tb.ts_text(F.col("timestamp"))).write.json(ev_path)
    st.write.parquet(st_path)
    out = scratch_dir(spark, "join-jobs")
    res = jobs.multisource_job(spark, ev_path, st_path, out)
    n = joins.join_events_status(cab, st).count()
    assert res["row_count"].first()[0] == n
    assert spark.read.parquet(f"{out}/joined_events_status_parquet").count() == n
    assert res["preview"].count() == 20
    hist = spark.read.option("header", True).schema("speed_range string, count long").csv(
        jobs.navigation_speed_job(spark, ev_path, st_path, out))
    assert rows(hist) == rows(joins.navigation_speed_histogram(cab, st))
    rpm = spark.read.option("header", True).csv(jobs.voice_rpm_job(spark, ev_path, st_path, out))
    assert int(rpm.first()["voice_count"]) == joins.voice_rpm_stats(cab, st).first()["voice_count"]


def test_streaming_jobs_on_kafka_replay(spark):
    replay = scratch_dir(spark, "kafka-replay")
    tb.kafka_records_from_events(tb.table(spark, SF_SMALL, "events")).write.parquet(replay)
    base = scratch_dir(spark, "kafka-jobs")
    q = jobs.cabin_etl_job(read_kafka_replay(spark, replay), base + "/etl", base + "/ck1", available_now=True)
    runner.run_to_end(q)
    q = jobs.event_count_job(read_kafka_replay(spark, replay), base + "/count", base + "/ck2", available_now=True)
    runner.run_to_end(q)
    etl = spark.read.parquet(base + "/etl")
    assert etl.count() == etl.filter(F.trim("event") != "").count() > 0
    assert runner.read_snapshot(spark, base + "/count").agg(F.sum("count")).first()[0] > 0


def test_state_jobs_write_sorted_record_dumps(spark):
    src = scratch_dir(spark, "speed-lines")
    tb.speed_lines_from_events(tb.table(spark, SF_SMALL, "events")).write.parquet(src)
    schema = spark.read.parquet(src).schema
    base = scratch_dir(spark, "state-jobs")
    stream = spark.readStream.schema(schema).parquet(src)
    q = jobs.overspeed_alert_job(stream, "event_id", base + "/out", base + "/ck", text_dir=base + "/txt",
                                 threshold=60.0, available_now=True)
    runner.run_to_end(q)
    got = spark.read.parquet(base + "/out").drop("batch_id")
    speeds = lines.parse_speed_lines(tb.speed_lines_from_events(tb.table(spark, SF_SMALL, "events")))
    want = state.overspeed_alert(speeds, seq="event_id", threshold=60.0)
    assert rows(got) == rows(want.select(*got.columns))
    text = [r[0] for r in spark.read.text(base + "/txt/overspeed_alert_*").collect()]
    assert len(text) == got.count() and all(t.startswith("vehicle_id=") and "\talert=" in t for t in text)


def test_text_line_stream_word_count(spark):
    inbox = scratch_dir(spark, "text-inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.txt"), "w") as f:
        f.write("spark streaming\nspark spark window\ndriver brake warning\n")
    base = scratch_dir(spark, "wc-job")
    runner.run_to_end(jobs.word_count_job(read_line_stream(spark, inbox), base + "/out", base + "/txt", base + "/ck",
                                          available_now=True))
    got = {r["word"]: r["count"] for r in spark.read.parquet(base + "/out").collect()}
    assert got == {"spark": 3, "streaming": 1, "window": 1, "driver": 1, "brake": 1, "warning": 1}


def test_number_records_batch_form(spark):
    df = spark.createDataFrame([(b, i, f"l{i}") for b in ("x", "y") for i in range(0, 40, 3)],
                               "batch string, seq long, value string")
    got = number_records(df, "seq", by=["batch"], chunk_size=4).orderBy("batch", "seq").collect()
    assert [r["record_no"] for r in got] == list(range(1, 15)) * 2


def test_brake_window_job_by_arrival_time_on_text_lines(spark):
    inbox = scratch_dir(spark, "brake-inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.txt"), "w") as f:   # the sample brake messages
        f.write("\n".join(["-1.2", "-3.8", "-5.1", "-6.0", "-2.4", "-7.3", "0.4"]) + "\n")
    base = scratch_dir(spark, "brake-job")
    runner.run_to_end(jobs.brake_window_job(read_line_stream(spark, inbox), base + "/out", base + "/ck",
                                            time_col=None, text_dir=base + "/txt", available_now=True))
    got = runner.read_latest_updates(spark, base + "/out", ["window_start", "window_end"])
    counts = [r["count"] for r in got.collect()]
    assert len(counts) == 6 and set(counts) == {3}   # 3 hard brakes, in each of the 6 overlapping windows
    text = [r[0] for r in spark.read.text(base + "/txt/brake_window_*").collect()]
    assert len(text) == 6 and all("\tmetric=hard_brake\tcount=3\twindow_seconds=60\tslide_seconds=10"
                                  "\tthreshold=-5.0" in t and t.startswith("batch_time=") for t in text)


def test_state_job_on_kafka_ordered_by_offset(spark):
    from autopulse.streaming.sources import kafka_lines
    ev = tb.table(spark, SF_SMALL, "events")
    lines_df = tb.speed_lines_from_events(ev)
    replay = scratch_dir(spark, "kafka-speed")
    (lines_df.select(F.col("value").cast("binary").alias("value"),
                     F.split("value", ",")[0].cast("binary").alias("key"), F.lit("speed").alias("topic"),
                     F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
                     F.col("ts").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))
     .write.parquet(replay))
    base = scratch_dir(spark, "kafka-state")
    q = jobs.overspeed_run_job(kafka_lines(read_kafka_replay(spark, replay)), "seq", base + "/out", base + "/ck",
                               threshold=60.0, available_now=True)
    runner.run_to_end(q)
    got = spark.read.parquet(base + "/out").withColumnRenamed("seq", "event_id")
    want = state.overspeed_run(lines.parse_speed_lines(lines_df), seq="event_id", threshold=60.0)
    assert rows(got.select(*want.columns)) == rows(want)


def test_remaining_stream_jobs_run(spark):
    """Kafka raw / JSON, raw lines, latest state and driving duration jobs end to end."""
    from autopulse.streaming.sources import kafka_lines
    ev = tb.table(spark, SF_SMALL, "events")
    replay = scratch_dir(spark, "kafka-replay-2")
    tb.kafka_records_from_events(ev).write.parquet(replay)
    status_replay = scratch_dir(spark, "kafka-status")
    (tb.status_lines_from_events(ev)
     .select(F.col("value").cast("binary").alias("value"), F.lit(None).cast("binary").alias("key"),
             F.lit("status").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
             F.col("ts").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))
     .write.parquet(status_replay))
    base = scratch_dir(spark, "more-jobs")
    n = ev.count()
    runner.run_to_end(jobs.kafka_raw_job(read_kafka_replay(spark, replay), base + "/raw", base + "/c1",
                                         available_now=True))
    assert spark.read.parquet(base + "/raw").count() == n
    runner.run_to_end(jobs.kafka_json_job(read_kafka_replay(spark, replay), base + "/json", base + "/c2",
                                          available_now=True))
    assert spark.read.parquet(base + "/json").filter(F.col("vehicle_id").startswith("v")).count() == n
    status_lines = kafka_lines(read_kafka_replay(spark, status_replay))
    runner.run_to_end(jobs.raw_lines_job(status_lines.select("seq", "value"), "seq", base + "/lines",
                                         base + "/lines-txt", base + "/c3", available_now=True))
    assert spark.read.parquet(base + "/lines").agg(F.max("record_no")).first()[0] == n
    runner.run_to_end(jobs.latest_state_job(kafka_lines(read_kafka_replay(spark, status_replay)), "seq",
                                            base + "/latest", base + "/c4", text_dir=base + "/latest-txt",
                                            available_now=True))
    assert spark.read.parquet(base + "/latest").count() == n
    runner.run_to_end(jobs.driving_duration_job(kafka_lines(read_kafka_replay(spark, status_replay)), "seq",
                                                base + "/drive", base + "/c5", available_now=True))
    got = spark.read.parquet(base + "/drive").withColumnRenamed("seq", "event_id")
    want = state.driving_duration(lines.parse_status_lines(tb.status_lines_from_events(ev)), seq="event_id")
    assert rows(got.select(*want.columns)) == rows(want)


def test_cli_batch_and_stream_jobs(spark):
    from autopulse.cli import main
    tel = tb.telemetry_from_events(tb.table(spark, SF_SMALL, "events"))
    csv = scratch_dir(spark, "cli-tel")
    write_csv(_as_text(tel), csv)
    out = scratch_dir(spark, "cli-out")
    written = main(["flagship", csv, out, "2.5", "-3.5", "3.0"], spark=spark)
    assert len(written) == 8
    got = spark.read.parquet(f"{out}/hourly_events_parquet").agg(F.sum("hard_accel_count")).first()[0]
    want = add_event_flags(tel, 2.5, -3.5, 3.0).agg(F.sum("is_hard_accel")).first()[0]
    assert got == want
    replay = scratch_dir(spark, "cli-replay")
    tb.kafka_records_from_events(tb.table(spark, SF_SMALL, "events")).write.parquet(replay)
    base = scratch_dir(spark, "cli-etl")
    main(["cabin-etl", "--replay", replay, "--output", base + "/out", "--checkpoint", base + "/ck",
          "--available-now"], spark=spark)
    assert spark.read.parquet(base + "/out").count() > 0


def test_cli_line_jobs(spark):
    from autopulse.cli import main
    inbox = scratch_dir(spark, "cli-lines")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.txt"), "w") as f:
        f.write("spark streaming\nspark spark window\n-5.1 -6.0 -7.3 0.4\n")
    base = scratch_dir(spark, "cli-wc")
    main(["word-count", "--lines", inbox, "--output", base + "/out", "--checkpoint", base + "/ck",
          "--available-now"], spark=spark)
    got = {r["word"]: r["count"] for r in spark.read.parquet(base + "/out").collect()}
    assert got["spark"] == 3 and got["-6.0"] == 1
    base = scratch_dir(spark, "cli-brake")
    main(["brake-window", "--lines", inbox, "--output", base + "/out", "--checkpoint", base + "/ck",
          "--available-now"], spark=spark)
    assert {r["count"] for r in spark.read.parquet(base + "/out").collect()} == {3}


def test_cli_console_event_count(spark):
    from autopulse.cli import main
    replay = scratch_dir(spark, "cli-console")
    tb.kafka_records_from_events(tb.table(spark, SF_SMALL, "events")).write.parquet(replay)
    assert main(["event-count", "--replay", replay, "--console", "--checkpoint", replay + "-ck",
                 "--available-now"], spark=spark) == {"console": "event-count"}


def test_cli_remaining_batch_jobs(spark):
    from autopulse.cli import main
    e = tb.table(spark, SF_SMALL, "events")
    raw = tb.sensors_from_events(e).drop("speed").join(e.select("event_id", F.col("value").alias("speed")), "event_id")
    sensors_csv = scratch_dir(spark, "cli-sensors")
    write_csv(_as_text(raw), sensors_csv)
    out = scratch_dir(spark, "cli-batch")
    written = main(["cleaning", sensors_csv, out], spark=spark)
    assert "cleaned_sensors:parquet" in written
    cab = tb.cabin_events_from_orders(tb.table(spark, SF_SMALL, "orders"))
    st = tb.status_from_lineitem(tb.table(spark, SF_SMALL, "lineitem"))
    ev_path, st_path = scratch_dir(spark, "cli-ev"), scratch_dir(spark, "cli-st")
    cab.withColumn("timestamp", tb.ts_text(F.col("timestamp"))).write.json(ev_path)
    st.write.parquet(st_path)
    assert "joined_events_status:parquet" in main(["multisource", ev_path, st_path, out], spark=spark)
    assert main(["navigation-speed", ev_path, st_path, out], spark=spark).endswith("navigation_speed_distribution")
    assert main(["voice-rpm", ev_path, st_path, out], spark=spark).endswith("voice_rpm_analysis")


def test_inferred_json_events_with_nested_fields(spark):
    import pytest
    from autopulse.operators import joins
    from autopulse.sinks.files import publish
    from autopulse.sources.files import read_cabin_events_json
    path = scratch_dir(spark, "json-nested")
    os.makedirs(path)
    with open(os.path.join(path, "e.json"), "w") as f:
        f.write('{"timestamp": "2024-01-01 00:00:00", "event_type": "NavigationStart", "meta": {"src": "hud"}}\n')
        f.write('{"timestamp": "bad", "event_type": "VoiceCommand", "meta": {"src": "mic"}}\n')
    ev = read_cabin_events_json(spark, path, infer=True)
    assert dict(ev.dtypes)["timestamp"] == "string" and dict(ev.dtypes)["meta"].startswith("struct")
    st = spark.createDataFrame([(__import__("datetime").datetime(2024, 1, 1), 42.0, 1200.0)],
                               "timestamp timestamp_ntz, speed double, rpm double")
    joined = joins.join_events_status(ev, st)
    assert joined.count() == 1                      # the bad timestamp matches nothing
    with pytest.raises(ValueError):                 # CSV cannot hold the nested column (T15)
        publish(joined, scratch_dir(spark, "nested-pub"), "joined", formats=("csv",))
    assert "joined:parquet" in publish(joined, scratch_dir(spark, "nested-pub"), "joined", formats=("parquet",))


def test_telemetry_reader_nulls_malformed_values(spark):
    from autopulse.sources.files import read_telemetry_csv
    path = scratch_dir(spark, "tel-bad")
    os.makedirs(path)
    with open(os.path.join(path, "t.csv"), "w") as f:
        f.write("timestamp,vehicle_id,speed,acceleration,lateral_acceleration,driver\n")
        f.write("2024-01-01 10:00:00,v1,55.5,3.5,0.1,ann\n")
        f.write("not-a-time,v2,abc,,NaN,bob\n")
    df = read_telemetry_csv(spark, path)
    assert dict(df.dtypes)["driver"] == "string" and dict(df.dtypes)["speed"] == "double"
    good, bad = sorted(df.collect(), key=lambda r: r["vehicle_id"])
    assert good["timestamp"].hour == 10 and good["speed"] == 55.5
    assert bad["timestamp"] is None and bad["speed"] is None and bad["acceleration"] is None
    assert bad["lateral_acceleration"] != bad["lateral_acceleration"]   # NaN kept as NaN


def test_sensor_reader_edge_rows_through_cleaning(spark):
    from autopulse.operators import clean as cl
    from autopulse.sources.files import read_sensor_csv
    path = scratch_dir(spark, "sens-edge")
    os.makedirs(path)
    with open(os.path.join(path, "s.csv"), "w") as f:
        f.write("temp,speed,humidity,pressure\n")
        for temp, speed in [("10", "199"), ("", "200"), ("20", "201"), ("30", ""), ("", "12.7"), ("40", "1e2")]:
            f.write(f"{temp},{speed},50,1000\n")
    df = read_sensor_csv(spark, path)
    assert sorted((r["speed"] is None, r["speed"]) for r in df.collect()) == sorted(
        [(False, 199), (False, 200), (False, 201), (True, None), (False, 12), (True, None)])
    assert tuple(cl.quality_profile(df).first()) == (6, 2, 1)        # speed 200 is not "> 200"
    cleaned = cl.clean_sensors(df)
    assert sorted(r["speed"] for r in cleaned.collect()) == [12, 199]   # 200, 201 and NULL speeds dropped
    assert {r["temp"] for r in cleaned.collect()} == {10.0, 25.0}       # mean of 10, 20, 30, 40 fills NULL
