import duckdb
import pytest

import __spark_entry__ as E
from autopulse.operators.joins import navigation_speed_histogram
from autopulse.sources.testbed import table
from autopulse.plans import flagship
from autopulse.plans.catalog import QUERIES
from autopulse.operators import aggregate
from autopulse.operators.events import add_event_flags
from autopulse.session import scratch_dir
from autopulse.sources import testbed as tb
from conftest import SF_SMALL, rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["vehicle_id", "accel_count", "decel_count", "turn_count", "risk_score"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    # the training-data queries that SQL cannot express have brute-force tests of their own
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in tb.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)

    def norm(v):
        return round(v, 9) if isinstance(v, float) else v

    got = sorted((tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    want = sorted((tuple(norm(r[i]) for i in order) for r in res.fetchall()), key=repr)
    assert got == want


def test_flagship_cube_equals_direct_aggregates(spark):
    tel = tb.telemetry_from_events(tb.table(spark, SF_SMALL, "events"))
    out = scratch_dir(spark, "flagship")
    written = flagship.run_flagship(spark, tel, out)
    assert len(written) == 8
    flagged = add_event_flags(tel)
    direct = {"hourly_events": aggregate.hourly_events(flagged), "vehicle_scores": aggregate.vehicle_scores(flagged),
              "weekday_weekend_events": aggregate.weekday_weekend_events(flagged),
              "daily_events": aggregate.daily_events(flagged)}
    for key, (csv_name, pq_name) in flagship.OUTPUT_NAMES.items():
        assert rows(spark.read.parquet(f"{out}/{pq_name}")) == rows(direct[key])
        csv = spark.read.option("header", True).schema(direct[key].schema).csv(f"{out}/{csv_name}")
        assert rows(csv) == rows(direct[key])


ANSI_SENSITIVE = ["src_csv_sensors", "scalar_text_fns", "parse_speed_lines", "stream_cabin_etl", "iqr_bounds"]


@pytest.mark.parametrize("name", ANSI_SENSITIVE)
def test_results_do_not_depend_on_ansi_mode(spark, name):
    q = E.queries()[name]
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "true")
        on = rows(q(spark, SF_SMALL))
        spark.conf.set("spark.sql.ansi.enabled", "false")
        off = rows(q(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert on == off


BATCH_QUERIES = [n for n in sorted(QUERIES) if not n.startswith(("stream_", "src_", "sink_"))]


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_plans_have_no_cross_products(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark):
    plan = E.queries()["vehicle_scores"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line or "FileScan" in line]
    assert schemas and all("value:" not in s and "ts:" not in s and "event_type" not in s for s in schemas)
    # keys that are plain columns (the adapters' stamps are computed): the NULL filter reaches both scans
    orders, items = table(spark, SF_SMALL, "orders"), table(spark, SF_SMALL, "lineitem")
    hist = navigation_speed_histogram(
        orders.selectExpr("o_orderdate AS timestamp", "o_orderpriority AS event_type"),
        items.selectExpr("l_shipdate AS timestamp", "l_quantity * 2 AS speed"))
    plan = hist._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(l_shipdate)" in plan and "IsNotNull(o_orderdate)" in plan


def test_chunked_scan_reuses_its_input_shuffle(spark):
    df = E.queries()["overspeed_run"](spark, SF_SMALL)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
