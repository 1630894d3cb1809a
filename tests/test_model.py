"""Invariants of the whole model, sources, sinks and report slicers."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from fleet_points import START, TESTDATA, at, point, rows
from roadpulse import Fleet, warehouse
from roadpulse.model import FOREIGN_KEYS, MODEL_TABLES, PRIMARY_KEYS
from roadpulse.operators import foreign_key_violations, number_rows, primary_key_violations
from roadpulse.plans import reports
from roadpulse.sinks import JdbcTarget, load_warehouse, save_tables, write_csv
from roadpulse.sources import load_raw, load_testbed, speed_limits
from roadpulse.sources.testbed import TESTBED_SETTINGS
from roadpulse.versions import Versions
from roadpulse.warehouse import SPEED_LIMITS, build_warehouse, open_warehouse


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A staged fleet written out and loaded again."""
    out = str(tmp_path_factory.mktemp("warehouse"))
    fleet = Fleet(
        spark, load_testbed(spark, f"{TESTDATA}/sf0.01"), TESTBED_SETTINGS, staged=True
    )
    return out, build_warehouse(fleet, out, by_day=True)


def test_published_counts_of_the_test_tables(built):
    """As an independent SQL count of the views has them, missing ids, times and levels
    included."""
    _, star = built
    log = {r["check_name"]: r["records_affected"] for r in star["dq_log"].collect()}
    assert log["total_raw_rows"] == 10150
    assert [log[c] for c in ("out_of_range_date", "duplicate_event_id", "invalid_gps")] == [
        334, 149, 93,
    ]
    assert [log[c] for c in ("negative_speed", "orphan_vehicle", "rows_accepted")] == [
        19, 701, 8854,
    ]
    assert [
        log[c] for c in ("orphan_driver", "orphan_trip", "battery_out_of_range", "null_trip_id")
    ] == [477, 787, 708, 1278]


def test_keys_hold(built):
    _, star = built
    keys = primary_key_violations(star, PRIMARY_KEYS)
    # five vehicles sent points without a time, whose day is missing
    violations = {r[0]: tuple(r)[2:] for r in keys.collect()}
    assert violations.pop("fact_daily_vehicle_summary") == (0, 5)
    assert set(violations.values()) == {(0, 0)}
    edges = foreign_key_violations(star, FOREIGN_KEYS)
    assert len(rows(edges)) == 11
    assert {r["orphan_rows"] for r in edges.collect()} == {0}


def test_key_checks_find_what_is_wrong(spark):
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int")
    tables = {"p": parent, "c": child}
    assert rows(primary_key_violations(tables, [("p", ["k"])]), "duplicate_keys", "null_keys") == [
        (1, 1)
    ]
    assert rows(foreign_key_violations(tables, [("c", "p", "k")]), "orphan_rows") == [(2,)]


def test_facts_agree_with_each_other(built):
    _, star = built
    daily = star["fact_daily_vehicle_summary"]
    assert daily.agg(F.sum("anomaly_count")).first()[0] == star["fact_anomaly_events"].count()
    trips = star["fact_trip_summary"]
    too_long = F.col("running_hours") * 60 > F.col("actual_duration_mins") + 0.31
    assert trips.filter(too_long).count() == 0
    assert daily.filter("idle_hours > running_hours").count() == 0


def test_exports(spark, built):
    out, star = built
    out = Versions(spark, out).current()
    assert list(star) == MODEL_TABLES
    again = load_warehouse(spark, f"{out}/parquet")
    assert rows(again["fact_trip_summary"]) == rows(star["fact_trip_summary"])
    for table in MODEL_TABLES:
        back = spark.read.option("header", True).csv(f"{out}/csv/{table}.csv")
        assert back.count() == star[table].count()
        assert sorted(back.columns) == sorted(star[table].columns)
    days = spark.read.parquet(f"{out}/parquet/fact_anomaly_events.parquet")
    pruned = days.filter("date_key = 20240110")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date_key" in pruned


def test_a_failed_rebuild_leaves_the_set_before(spark, tmp_path, make_fleet, monkeypatch):
    """Fails in the last table; readers of the folder and of the catalog see the old set."""
    out, database = str(tmp_path / "dw"), "rebuild_test"
    slow, fast = ([point("a", 0), point("b", 60, speed_kmph=v)] for v in (10.0, 99.0))
    with pytest.raises(FileNotFoundError):
        open_warehouse(spark, out)
    build_warehouse(make_fleet(slow, staged=True), out, database=database)
    before = {n: rows(t) for n, t in open_warehouse(spark, out).items()}
    write = warehouse.write_parquet

    def failing(tables, *args):
        write({n: t for n, t in tables.items() if n != "fact_anomaly_events"}, *args)
        if "fact_anomaly_events" in tables:
            raise OSError("disk")

    with monkeypatch.context() as patched:
        patched.setattr(warehouse, "write_parquet", failing)
        with pytest.raises(OSError, match="disk"):
            build_warehouse(make_fleet(fast, staged=True), out, database=database)
    assert {n: rows(t) for n, t in open_warehouse(spark, out).items()} == before
    assert len(Versions(spark, out).names()) == 1
    for days in (False, True, True):
        star = build_warehouse(make_fleet(fast, staged=True), out, by_day=days, database=database)
        after = {n: rows(t) for n, t in open_warehouse(spark, out).items()}
        assert after != before and len(after["fact_anomaly_events"]) == 1
        for name in (*star, SPEED_LIMITS):
            table = spark.table(f"{database}.{name}")
            assert name == SPEED_LIMITS or rows(table) == after[name]
            assert Versions(spark, out).current() in table.inputFiles()[0]
    assert len(Versions(spark, out).names()) == 2
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_csv_timestamps_are_plain(spark, tmp_path, make_fleet):
    fleet = make_fleet([point("a", 0.25), point("b", 1)])
    table = {"points": fleet.clean_telemetry.select("event_id", "event_timestamp")}
    write_csv(table, str(tmp_path))
    back = spark.read.option("header", True).csv(f"{tmp_path}/points.csv")
    assert rows(back) == [("a", "2025-01-20 08:00:00.25"), ("b", "2025-01-20 08:00:01")]


def test_catalog_tables_can_be_replaced(spark, make_fleet):
    spark.sql("CREATE DATABASE IF NOT EXISTS fleet_test")
    fleet = make_fleet([point("a", 0)])
    small = {n: fleet.star()[n] for n in ("dim_customer", "dim_vehicle")}
    for _ in range(2):
        save_tables(small, "fleet_test", speed_limits(spark))
    assert spark.table("fleet_test.dim_vehicle").count() == 5
    assert spark.table("fleet_test.ref_speed_limit").count() == 4
    spark.sql("DROP DATABASE fleet_test CASCADE")


def test_jdbc_options():
    target = JdbcTarget("jdbc:postgresql://host/db", user="u", password="p", schema="dw")
    options = target.options("dim_date")
    assert options["dbtable"] == "dw.dim_date" and options["url"].endswith("/db")
    assert "truncate" not in options
    kept = replace(target, keep_definitions=True, extra={"sslmode": "require"}).options("x")
    assert (kept["truncate"], kept["cascadeTruncate"], kept["sslmode"]) == (
        "true", "true", "require",
    )


def test_raw_folder_types(spark, tmp_path, make_fleet):
    """Declared types: phones stay text, ids such as T1 stay ids, zone-less times."""
    fleet = make_fleet([point("a", 0), point("b", 90, speed_kmph=70.0)])
    raw = fleet.raw
    wide = raw.telemetry.withColumn("battery_level", F.col("battery_level").cast("bigint"))
    wide.write.parquet(f"{tmp_path}/telemetry_events.parquet")
    write_csv(
        {n: getattr(raw, n) for n in ("vehicles", "drivers", "customers", "trips")},
        str(tmp_path),
    )
    loaded = load_raw(spark, str(tmp_path))
    for name in ("telemetry", "vehicles", "drivers", "customers", "trips", "speed_limits"):
        assert rows(getattr(loaded, name)) == rows(getattr(raw, name)), name
        assert getattr(loaded, name).dtypes == getattr(raw, name).dtypes
    again = Fleet(spark, loaded)
    assert rows(again.fact_trip_summary) == rows(fleet.fact_trip_summary)


def test_numbering_with_ties_and_nulls(spark):
    from roadpulse.session import Workspace

    values = [(None,), *[(i % 50,) for i in range(1000)], (None,)]
    df = spark.createDataFrame(values, "v int").repartition(7)
    found = number_rows(df, "n", ["v"], Workspace(spark)).orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(1, 1003))
    assert [r["v"] for r in found] == sorted(i % 50 for i in range(1000)) + [None, None]


def test_slicers(built):
    _, star = built
    dated = reports.in_context(star, from_day=date(2024, 1, 5), to_day=date(2024, 1, 6))
    assert {r["date_key"] for r in dated["fact_trip_summary"].collect()} <= {20240105, 20240106}
    assert dated["dim_vehicle"] is star["dim_vehicle"]
    one = reports.in_context(star, driver_ids=["DRV_3"], anomaly_types=["OVERSPEEDING"])
    kinds = one["fact_anomaly_events"].select("driver_id", "anomaly_type").distinct()
    assert rows(kinds) == [("OVERSPEEDING", "DRV_3")]
    # no driver in the daily fact: it stays as it is
    assert one["fact_daily_vehicle_summary"] is star["fact_daily_vehicle_summary"]
    severe = reports.in_context(star, severities=["LOW"])
    assert {r["severity"] for r in severe["fact_anomaly_events"].collect()} <= {"LOW"}


def test_active_today_ignores_the_date_slicer(built):
    _, star = built
    whole = reports.fleet_kpis(star).first()
    sliced = reports.fleet_kpis(star, to_day=date(2024, 1, 3)).first()
    assert sliced["total_anomalies"] < whole["total_anomalies"]
    assert sliced["active_today"] == whole["active_today"] > 0


def test_safety_score(spark):
    cases = spark.createDataFrame(
        [(0, 100.0), (1, 100.0), (50, 100.0), (None, 10.0), (3, 0.0), (3, None)],
        "high int, km double",
    )
    scored = cases.select(reports.safety_score(F.col("high"), F.col("km")).alias("s"))
    assert [r["s"] for r in scored.collect()] == [100.0, 97.0, 0.0, 100.0, None, None]


def test_recent_anomalies_are_the_latest_per_driver(make_fleet):
    fast = dict(speed_kmph=100.0)
    fleet = make_fleet(
        [point(f"e{i:02}", i * 1000, **fast) for i in range(25)]
        + [point("other", 5, vehicle_id="V2", driver_id="D2", **fast)]
    )
    found = reports.recent_anomalies(fleet.star(keyed=False)).collect()
    times = sorted((r["start_time"] for r in found if r["driver_id"] == "D1"), reverse=True)
    assert times == [at(i * 1000) for i in range(24, 4, -1)]
    assert START < times[-1] and len(found) == 21
