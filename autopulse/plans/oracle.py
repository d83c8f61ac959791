"""DuckDB SQL twins of the registered queries (the correctness oracle).

The views region ... conversations are pre-registered by the checker.  Each entry
computes the same result as its Spark query straight from the tables, in plain SQL.
"""

from __future__ import annotations

# Adapter CTEs: the same projections as autopulse.sources.testbed.
_K = "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)"
CTES = {
    "telemetry": f"""
        SELECT ts AS "timestamp", CAST(user_id AS VARCHAR) AS vehicle_id, value AS speed,
               ({_K} - 50) / 10.0::DOUBLE AS acceleration,
               ((event_id * 7) % 60) / 10.0::DOUBLE AS lateral_acceleration, event_id
        FROM events""",
    "flagged": """
        SELECT *, CASE WHEN acceleration > 3.0 THEN 1 ELSE 0 END AS is_hard_accel,
                  CASE WHEN acceleration < -3.0 THEN 1 ELSE 0 END AS is_hard_decel,
                  CASE WHEN lateral_acceleration > 4.0 THEN 1 ELSE 0 END AS is_hard_turn
        FROM telemetry""",
    "sensors": f"""
        SELECT event_id,
               CASE WHEN {_K} % 10 = 0 THEN NULL ELSE {_K} / 2.0::DOUBLE END AS temp,
               CAST(floor(value) AS INTEGER) AS speed,
               (event_id % 100) * 1.0::DOUBLE AS humidity,
               1000.0::DOUBLE + (event_id % 50) AS pressure
        FROM events""",
    "cabin": """
        SELECT TIMESTAMP '1995-01-01' + to_seconds(o_orderkey // 2) AS "timestamp",
               CASE o_orderpriority WHEN '1-URGENT' THEN 'NavigationStart'
                                    WHEN '2-HIGH' THEN 'VoiceCommand' ELSE o_orderpriority END AS event_type
        FROM orders""",
    "status": """
        SELECT TIMESTAMP '1995-01-01' + to_seconds(l_orderkey // 2) AS "timestamp", l_quantity * 2 AS speed, l_quantity * 100 AS rpm FROM lineitem""",
}


def with_ctes(names: list[str] | tuple[str, ...], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + body


_FLAG_SUMS = """CAST(sum(is_hard_accel) AS BIGINT) AS hard_accel_count,
                CAST(sum(is_hard_decel) AS BIGINT) AS hard_decel_count,
                CAST(sum(is_hard_turn) AS BIGINT) AS hard_turn_count"""

SQL: dict[str, str] = {}

SQL["event_flags"] = with_ctes(["telemetry", "flagged"], "SELECT * FROM flagged")

SQL["vehicle_scores"] = with_ctes(["telemetry", "flagged"], """
    SELECT vehicle_id, accel_count, decel_count, turn_count,
           CAST(greatest(round(100 * exp(-(accel_count * 0.02 + decel_count * 0.03 + turn_count * 0.015)), 2), 0)
                AS DOUBLE) AS risk_score
    FROM (SELECT vehicle_id, CAST(sum(is_hard_accel) AS BIGINT) AS accel_count,
                 CAST(sum(is_hard_decel) AS BIGINT) AS decel_count,
                 CAST(sum(is_hard_turn) AS BIGINT) AS turn_count
          FROM flagged GROUP BY vehicle_id)""")

SQL["hourly_events"] = with_ctes(["telemetry", "flagged"], f"""
    SELECT CAST(hour("timestamp") AS INTEGER) AS hour, {_FLAG_SUMS}, count(*) AS total_records
    FROM flagged GROUP BY 1""")

SQL["weekday_weekend"] = with_ctes(["telemetry", "flagged"], f"""
    SELECT CASE WHEN dayofweek("timestamp") + 1 BETWEEN 2 AND 6 THEN 'weekday' ELSE 'weekend' END AS day_type,
           {_FLAG_SUMS}, count(*) AS total_records,
           round(sum(is_hard_accel) * 1000 / count(*), 2) AS accel_rate_per_1000,
           round(sum(is_hard_decel) * 1000 / count(*), 2) AS decel_rate_per_1000,
           round(sum(is_hard_turn) * 1000 / count(*), 2) AS turn_rate_per_1000
    FROM flagged GROUP BY 1""")

SQL["daily_events"] = with_ctes(["telemetry", "flagged"], f"""
    SELECT CAST(dayofweek("timestamp") + 1 AS INTEGER) AS weekday_num,
           ['周日', '周一', '周二', '周三', '周四', '周五', '周六'][dayofweek("timestamp") + 1] AS weekday_name,
           {_FLAG_SUMS}
    FROM flagged GROUP BY 1, 2""")

# --- cleaning ----------------------------------------------------------------------------
CTES["filled"] = """
    SELECT event_id, COALESCE(CASE WHEN isnan(temp) THEN NULL ELSE temp END,
                              (SELECT avg(temp) FROM sensors), 0.0::DOUBLE) AS temp,
           speed, humidity, pressure
    FROM sensors"""


def _quartile_cte(src: str) -> str:
    """q1/q3 as the values of rank max(1, ceil(p * n)) among non-NULL speeds."""
    return f"""
        SELECT CAST(max(CASE WHEN rn = greatest(1, ceil(0.25 * n)) THEN speed END) AS DOUBLE) AS q1,
               CAST(max(CASE WHEN rn = greatest(1, ceil(0.75 * n)) THEN speed END) AS DOUBLE) AS q3
        FROM (SELECT speed, row_number() OVER (ORDER BY speed) AS rn, count(*) OVER () AS n
              FROM {src} WHERE speed IS NOT NULL)"""


CTES["quartiles"] = _quartile_cte("sensors")
CTES["fence"] = """
    SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
    FROM quartiles"""

SQL["filter_max_speed"] = with_ctes(["sensors"], "SELECT * FROM sensors WHERE speed < 200")
SQL["fill_mean"] = with_ctes(["sensors", "filled"], "SELECT * FROM filled")
SQL["clean_sensors"] = with_ctes(["sensors", "filled"], "SELECT * FROM filled WHERE speed < 200")
SQL["iqr_bounds"] = with_ctes(["sensors", "quartiles", "fence"], "SELECT * FROM fence")
SQL["iqr_outliers"] = with_ctes(["sensors", "quartiles", "fence"], """
    SELECT s.* FROM sensors s, fence f WHERE s.speed < f.lower_bound OR s.speed > f.upper_bound""")
SQL["quality_profile"] = with_ctes(["sensors"], """
    SELECT count(*) AS total_records, count(*) FILTER (WHERE temp IS NULL) AS temp_null_count,
           count(*) FILTER (WHERE speed > 200) AS speed_over_max_count
    FROM sensors""")
SQL["describe_numeric"] = with_ctes(["sensors"], " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}::DOUBLE) AS mean,
               stddev_samp({c}::DOUBLE) AS stddev, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max
        FROM sensors""" for c in ("temp", "speed", "humidity", "pressure")))

# --- joins -------------------------------------------------------------------------------
CTES["joined"] = """SELECT c."timestamp", c.event_type, s.speed, s.rpm
                    FROM cabin c JOIN status s ON c."timestamp" = s."timestamp" """
_J = ["cabin", "status", "joined"]
SQL["join_events_status"] = with_ctes(_J, "SELECT * FROM joined")
SQL["join_row_count"] = with_ctes(_J, "SELECT count(*) AS row_count FROM joined")
SQL["nav_events"] = with_ctes(_J, """SELECT "timestamp", speed FROM joined WHERE event_type = 'NavigationStart'""")
SQL["voice_events"] = with_ctes(_J, """SELECT "timestamp", rpm FROM joined WHERE event_type = 'VoiceCommand'""")
SQL["nav_speed_histogram"] = with_ctes(_J, """
    SELECT CASE WHEN speed < 30 THEN '0-30km/h' WHEN speed < 60 THEN '30-60km/h'
                WHEN speed < 90 THEN '60-90km/h' ELSE '90km/h+' END AS speed_range, count(*) AS count
    FROM joined WHERE event_type = 'NavigationStart' GROUP BY 1""")
SQL["voice_rpm_stats"] = with_ctes(_J, """
    SELECT max(rpm) AS max_rpm, min(rpm) AS min_rpm, avg(rpm) AS avg_rpm, count(*) AS voice_count
    FROM joined WHERE event_type = 'VoiceCommand'""")
SQL["preview_top_n"] = with_ctes(_J, """
    SELECT * FROM joined
    ORDER BY "timestamp" NULLS FIRST, event_type NULLS FIRST, speed NULLS FIRST, rpm NULLS FIRST LIMIT 20""")

# --- lines, scalar functions, state, windows ----------------------------------------------
_JVM_TRIM = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
_WS = r"'[ \t\n\x0B\f\r]+'"


def _jvm_fields(x: str) -> str:
    """JVM split(',') then trim: trailing empty fields dropped first."""
    return (f"list_transform(CASE WHEN {x} = '' THEN [''] WHEN regexp_replace({x}, ',+$', '') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(regexp_replace({x}, ',+$', ''), ',') END, lambda f: {_JVM_TRIM.format(x='f')})")


CTES["speed_lines"] = """
    SELECT event_id, ts, CAST(user_id AS VARCHAR) || ',' ||
           CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END ||
           CASE WHEN event_id % 5 = 0 THEN ',,' ELSE '' END AS value
    FROM events"""
CTES["status_lines"] = """
    SELECT event_id, ts, CAST(user_id AS VARCHAR) || ',' ||
           CASE WHEN event_type = 'view' THEN 'driving' ELSE event_type END AS value
    FROM events"""
CTES["numeric_lines"] = f"""
    SELECT event_id, ts, CAST(({_K} - 50) / 10.0::DOUBLE AS VARCHAR) || ' ' || event_type AS value FROM events"""
CTES["speeds"] = f"""
    SELECT event_id, ts, p[1] AS vehicle_id, TRY_CAST(p[2] AS DOUBLE) AS speed
    FROM (SELECT event_id, ts, {_jvm_fields('value')} AS p FROM speed_lines)
    WHERE len(p) = 2 AND p[1] <> '' AND TRY_CAST(p[2] AS DOUBLE) IS NOT NULL"""
CTES["statuses"] = f"""
    SELECT event_id, ts, p[1] AS vehicle_id, lower(p[2]) AS status
    FROM (SELECT event_id, ts, {_jvm_fields('value')} AS p FROM status_lines)
    WHERE len(p) = 2 AND p[1] <> '' AND p[2] <> ''"""
CTES["tokens"] = f"""
    SELECT event_id, ts, TRY_CAST(tok AS DOUBLE) AS number
    FROM (SELECT event_id, ts, unnest(string_split_regex({_JVM_TRIM.format(x='value')}, {_WS})) AS tok
          FROM numeric_lines)
    WHERE tok <> '' AND TRY_CAST(tok AS DOUBLE) IS NOT NULL"""
CTES["runs"] = """
    SELECT vehicle_id, event_id, speed,
           CAST(CASE WHEN over THEN sum(CASE WHEN over THEN 1 ELSE 0 END)
                    OVER (PARTITION BY vehicle_id, grp ORDER BY event_id ROWS UNBOUNDED PRECEDING)
                ELSE 0 END AS INTEGER) AS consecutive_overspeed_count
    FROM (SELECT *, sum(CASE WHEN over THEN 0 ELSE 1 END)
                      OVER (PARTITION BY vehicle_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS grp
          FROM (SELECT *, coalesce(speed > 60.0 AND NOT isnan(speed), false) AS over FROM speeds))"""
CTES["alerts"] = """
    SELECT *, CASE WHEN consecutive_overspeed_count >= 3 THEN 'TRIGGERED' ELSE 'WAITING' END AS alert FROM runs"""

SQL["parse_speed_lines"] = with_ctes(["speed_lines", "speeds"], "SELECT * FROM speeds")
SQL["parse_status_lines"] = with_ctes(["status_lines", "statuses"], "SELECT * FROM statuses")
SQL["parse_numeric_tokens"] = with_ctes(["numeric_lines", "tokens"], "SELECT * FROM tokens")
SQL["word_count"] = f"""
    SELECT source, word, count(*) AS count
    FROM (SELECT source, unnest(string_split_regex({_JVM_TRIM.format(x='text')}, {_WS})) AS word FROM documents)
    WHERE word <> '' GROUP BY source, word"""
SQL["format_records"] = with_ctes(["speed_lines", "speeds", "runs", "alerts"], """
    SELECT event_id, 'vehicle_id=' || vehicle_id || chr(9) || 'speed=' || CAST(speed AS VARCHAR) || chr(9) ||
           'consecutive_overspeed_count=' || CAST(consecutive_overspeed_count AS VARCHAR) || chr(9) ||
           'alert=' || alert AS record
    FROM alerts""")
SQL["scalar_time_fns"] = """
    SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday_num,
           strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS batch_time,
           'raw_stream_' || strftime(ts + INTERVAL 8 HOUR, '%Y%m%d_%H%M%S_%g') || '.txt' AS file_name
    FROM events"""
SQL["scalar_text_fns"] = with_ctes(["speed_lines"], f"""
    SELECT event_id, {_JVM_TRIM.format(x='value')} AS trimmed, CAST(length(value) AS INTEGER) AS n_chars,
           value IS NOT NULL AND length(trim(value, ' ')) > 0 AS is_non_blank, lower(value) AS lowered,
           CAST(len(p) AS INTEGER) AS n_fields, p[2] AS speed_text, TRY_CAST(p[2] AS DOUBLE) AS speed_double,
           CASE WHEN regexp_matches({_JVM_TRIM.format(x='p[2]')}, '^[+-]?[0-9]*\\.?[0-9]*$')
                 AND {_JVM_TRIM.format(x='p[2]')} NOT IN ('', '+', '-')
                THEN CASE WHEN regexp_matches(p[2], '[0-9]')
                          THEN TRY_CAST(trunc(TRY_CAST({_JVM_TRIM.format(x='p[2]')} AS DECIMAL(38, 18))) AS INTEGER)
                          ELSE 0 END END
               AS speed_int
    FROM (SELECT *, {_jvm_fields('value')} AS p FROM speed_lines)""")
SQL["scalar_json_fns"] = """
    SELECT event_id, json_extract_string(props, '$.k') AS k_text,
           TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events"""
SQL["latest_state"] = with_ctes(["status_lines", "statuses"], """
    SELECT vehicle_id, arg_max(status, event_id) AS latest_state FROM statuses GROUP BY vehicle_id""")
SQL["driving_duration"] = with_ctes(["status_lines", "statuses"], """
    SELECT vehicle_id, event_id, status AS latest_status,
           CAST(sum(CASE WHEN status = 'driving' THEN 5 ELSE 0 END)
                OVER (PARTITION BY vehicle_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
               AS total_driving_seconds
    FROM statuses""")
SQL["overspeed_run"] = with_ctes(["speed_lines", "speeds", "runs"], "SELECT * FROM runs")
SQL["overspeed_alert"] = with_ctes(["speed_lines", "speeds", "runs", "alerts"], "SELECT * FROM alerts")
SQL["brake_window"] = with_ctes(["numeric_lines", "tokens"], """
    SELECT make_timestamp(start_s * 1000000) AS window_start, make_timestamp((start_s + 60) * 1000000) AS window_end,
           'hard_brake' AS metric, count(*) AS count, 60 AS window_seconds, 10 AS slide_seconds,
           -3.0::DOUBLE AS threshold
    FROM (SELECT (CAST(floor(epoch_us(ts) / 10000000) AS BIGINT) - i) * 10 AS start_s
          FROM (SELECT ts, unnest(range(0, 6)) AS i FROM tokens WHERE number < -3.0))
    GROUP BY start_s""")

# --- sources and sinks --------------------------------------------------------------------
SQL["src_csv_telemetry"] = with_ctes(["telemetry"], """
    SELECT "timestamp", vehicle_id, speed, acceleration, lateral_acceleration,
           CAST(event_id AS VARCHAR) AS event_id
    FROM telemetry""")
SQL["src_csv_sensors"] = with_ctes(["sensors"], """
    SELECT CAST(event_id AS VARCHAR) AS event_id, temp, speed, humidity, pressure FROM sensors""")
SQL["src_json_events"] = """
    SELECT strftime(TIMESTAMP '1995-01-01' + to_seconds(o_orderkey // 2), '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
           CASE o_orderpriority WHEN '1-URGENT' THEN 'NavigationStart' WHEN '2-HIGH' THEN 'VoiceCommand'
                                ELSE o_orderpriority END AS event_type,
           o_orderkey AS trip, o_orderstatus AS meta_status
    FROM orders"""
SQL["src_parquet_status"] = with_ctes(["status"], "SELECT * FROM status")
SQL["sink_csv_roundtrip"] = (
    "SELECT *, 'single_file' AS layout FROM (" + SQL["hourly_events"] + ") UNION ALL "
    "SELECT *, 'partitioned' AS layout FROM (" + SQL["hourly_events"] + ")")
SQL["sink_parquet_roundtrip"] = SQL["vehicle_scores"]
SQL["sink_publish_dual"] = (
    "SELECT *, 'csv' AS format FROM (" + SQL["daily_events"] + ") UNION ALL "
    "SELECT *, 'parquet' AS format FROM (" + SQL["daily_events"] + ")")
SQL["sink_publish_if_any"] = SQL["iqr_outliers"]

# --- streams (checked against the batch SQL of the same data) -------------------------------
CTES["kafka_msgs"] = f"""
    SELECT event_id, user_id, ts, 'v' || CAST(user_id AS VARCHAR) AS vehicle_id,
           CASE WHEN {_K} % 25 = 0 THEN ' ' ELSE event_type END AS event,
           CASE WHEN {_K} % 20 = 1 THEN NULL ELSE value END AS speed,
           ({_K} - 50) / 10.0::DOUBLE AS acceleration,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time
    FROM events"""
SQL["stream_kafka_raw"] = with_ctes(["kafka_msgs"], """
    SELECT CAST(user_id AS VARCHAR) AS message_key,
           '{"vehicle_id":"' || vehicle_id || '","event":"' || event || '",' ||
           CASE WHEN speed IS NULL THEN '' ELSE '"speed":' || CAST(speed AS VARCHAR) || ',' END ||
           '"acceleration":' || CAST(acceleration AS VARCHAR) || ',"ts":"' || event_time || '"}' AS raw_value,
           'cabin' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
           CAST(ts AS VARCHAR) AS kafka_time
    FROM kafka_msgs""")
SQL["stream_json_parse"] = with_ctes(["kafka_msgs"], """
    SELECT vehicle_id, event, speed, acceleration, event_time FROM kafka_msgs""")
SQL["stream_cabin_etl"] = with_ctes(["kafka_msgs"], """
    SELECT vehicle_id, event, speed, acceleration, event_time FROM kafka_msgs
    WHERE length(trim(vehicle_id, ' ')) > 0 AND length(trim(event, ' ')) > 0
      AND speed IS NOT NULL AND acceleration IS NOT NULL""")
SQL["stream_event_count"] = with_ctes(["kafka_msgs"], """
    SELECT event, count(*) AS count FROM kafka_msgs WHERE length(trim(event, ' ')) > 0 GROUP BY event""")
SQL["stream_raw_lines"] = with_ctes(["speed_lines"], """
    SELECT event_id, row_number() OVER (ORDER BY event_id) AS record_no, value AS raw_data, 0 AS batch_id
    FROM speed_lines""")
_ALL_WORDS = f"""
    SELECT word, count(*) AS count
    FROM (SELECT unnest(string_split_regex({_JVM_TRIM.format(x='text')}, {_WS})) AS word FROM documents)
    WHERE word <> '' GROUP BY word"""
SQL["stream_word_count"] = f"SELECT 0 AS batch_id, word, count FROM ({_ALL_WORDS})"
SQL["sink_batch_files"] = f"""
    SELECT 'word=' || word || chr(9) || 'count=' || CAST(count AS VARCHAR) AS record FROM ({_ALL_WORDS})"""
SQL["stream_brake_window"] = SQL["brake_window"]
SQL["stream_latest_state"] = SQL["latest_state"]
SQL["stream_driving_duration"] = SQL["driving_duration"]
SQL["stream_overspeed_run"] = SQL["overspeed_run"]
SQL["stream_overspeed_alert"] = SQL["overspeed_alert"]
SQL["event_count"] = SQL["stream_event_count"]
SQL["event_count_ordered"] = (
    "SELECT event, count, row_number() OVER (ORDER BY count DESC, event) AS place FROM ("
    + SQL["stream_event_count"] + ")")
SQL["latest_state_per_record"] = with_ctes(["status_lines", "statuses"], """
    SELECT vehicle_id, event_id, status AS latest_state FROM statuses""")
SQL["stream_kafka_replay"] = SQL["stream_kafka_raw"]
SQL["describe_text"] = with_ctes(["sensors"], """
    SELECT 'count' AS summary, CAST(count(temp) AS VARCHAR) AS temp, CAST(count(speed) AS VARCHAR) AS speed FROM sensors
    UNION ALL SELECT 'mean', printf('%.9f', avg(temp)), printf('%.9f', avg(speed)) FROM sensors
    UNION ALL SELECT 'stddev', printf('%.9f', stddev_samp(temp)), printf('%.9f', stddev_samp(speed)) FROM sensors
    UNION ALL SELECT 'min', CAST(min(temp) AS VARCHAR), CAST(min(speed) AS VARCHAR) FROM sensors
    UNION ALL SELECT 'max', CAST(max(temp) AS VARCHAR), CAST(max(speed) AS VARCHAR) FROM sensors""")

# --- text lines and whole jobs ----------------------------------------------------------------
SQL["stream_lines_state"] = with_ctes(["speed_lines", "speeds", "runs"], """
    SELECT vehicle_id, speed, consecutive_overspeed_count FROM runs""")
SQL["sink_sorted_dump"] = f"SELECT record FROM ({SQL['format_records']})"
SQL["sink_raw_lines_text"] = with_ctes(["speed_lines"], """
    SELECT 'record_no=' || CAST(row_number() OVER (PARTITION BY step ORDER BY event_id) AS VARCHAR) || chr(9) ||
           'raw_data=' || value AS record
    FROM (SELECT *, floor((event_id - min(event_id) OVER ()) * 3.0::DOUBLE
                          / (max(event_id) OVER () - min(event_id) OVER () + 1)) AS step FROM speed_lines)""")
SQL["sink_brake_window_text"] = f"""
    SELECT 'window_start=' || strftime(window_start, '%Y-%m-%d %H:%M:%S') || chr(9) ||
           'window_end=' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(9) || 'metric=' || metric || chr(9) ||
           'count=' || CAST(count AS VARCHAR) || chr(9) || 'window_seconds=60' || chr(9) || 'slide_seconds=10' ||
           chr(9) || 'threshold=-3.0' AS record
    FROM ({SQL['brake_window']})"""
_NO_TOTAL, _NO_SCORE = "NULL::BIGINT AS total_records", "NULL::DOUBLE AS risk_score"
_FLAGS = "hard_accel_count AS accel_count, hard_decel_count AS decel_count, hard_turn_count AS turn_count"
SQL["flagship_job"] = f"""
    SELECT 'hourly_events' AS report, CAST(hour AS VARCHAR) AS item, {_FLAGS}, total_records, {_NO_SCORE}
    FROM ({SQL['hourly_events']})
    UNION ALL SELECT 'weekday_weekend_events', day_type, {_FLAGS}, total_records, {_NO_SCORE}
    FROM ({SQL['weekday_weekend']})
    UNION ALL SELECT 'daily_events', weekday_name, {_FLAGS}, {_NO_TOTAL}, {_NO_SCORE} FROM ({SQL['daily_events']})
    UNION ALL SELECT 'vehicle_scores', vehicle_id, accel_count, decel_count, turn_count, {_NO_TOTAL}, risk_score
    FROM ({SQL['vehicle_scores']})"""
CTES["cleaned"] = "SELECT * FROM filled WHERE speed < 200"
CTES["cleaned_quartiles"] = _quartile_cte("cleaned")


def _cleaning_part(name: str, src: str, quartiles: str) -> str:
    return f"""
        SELECT '{name}' AS data, count(*) AS total_records, count(*) FILTER (WHERE temp IS NULL) AS temp_null_count,
               count(*) FILTER (WHERE speed > 200) AS speed_over_max_count,
               count(*) FILTER (WHERE speed < q1 - 1.5 * (q3 - q1) OR speed > q3 + 1.5 * (q3 - q1)) AS n_outliers,
               any_value(q1) AS q1, any_value(q3) AS q3, any_value(q3 - q1) AS iqr,
               any_value(q1 - 1.5 * (q3 - q1)) AS lower_bound, any_value(q3 + 1.5 * (q3 - q1)) AS upper_bound
        FROM {src}, {quartiles}"""


SQL["cleaning_job"] = with_ctes(
    ["sensors", "filled", "cleaned", "quartiles", "cleaned_quartiles"],
    _cleaning_part("raw", "sensors", "quartiles") + " UNION ALL " + _cleaning_part("cleaned", "cleaned", "cleaned_quartiles"))
