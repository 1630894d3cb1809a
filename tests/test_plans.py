"""Shapes of physical plans that must hold at any scale."""

from __future__ import annotations

import re

import pytest

from fleet_points import START, TESTDATA, point
from roadpulse import Fleet
from roadpulse.operators import mark_duplicates
from roadpulse.plans import facts, reports, segments
from roadpulse.sources import load_raw, load_testbed
from roadpulse.sources.testbed import TESTBED_SETTINGS
from roadpulse.warehouse import build_warehouse, open_warehouse


@pytest.fixture(scope="module")
def fleet(spark):
    return Fleet(spark, load_testbed(spark, f"{TESTDATA}/sf0.001"), TESTBED_SETTINGS)


def plan(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    return text.split("== Physical Plan ==")[1]


def event_shuffles(text: str) -> set[str]:
    """Hash shuffles whose rows still carry a timestamp, by their keys."""
    return set(re.findall(r"hashpartitioning\((event_id|vehicle_id|trip_id|driver_id)#", text))


def test_staged_points_are_shuffled_once_by_event_and_once_by_slice(fleet):
    """What is written before the ordering and the ordering itself."""
    checked = plan(fleet.checked_telemetry)
    assert event_shuffles(checked) == {"event_id"}
    assert checked.count("hashpartitioning(event_id#") == 1
    points = plan(segments.order_points(fleet.raw.telemetry).frame)
    exchanges = re.findall(r"Exchange hashpartitioning\(vehicle_id#\d+, _slice#\d+", points)
    reused = points.count("ReusedExchange")
    # the rows, and the same rows for the slices' states
    assert 1 <= len(exchanges) - reused <= 2


@pytest.mark.parametrize("table", ["tel_ordered", "anomaly_overspeed", "unkeyed_anomalies"])
def test_events_are_read_for_the_points_and_for_the_slices_only(spark, make_fleet, fleet, table):
    """Two scans of the telemetry in the plan as made, before any exchange is reused."""
    fresh = Fleet(spark, fleet.raw, TESTBED_SETTINGS)
    text = getattr(fresh, table)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Union") == 2  # the telemetry view is a union


def test_readers_of_staged_points_do_not_order_them_again(spark, fleet):
    staged = Fleet(spark, fleet.raw, TESTBED_SETTINGS, staged=True)
    staged.ordered  # noqa: B018
    rollup = plan(facts.activity_rollup(staged.ordered, staged.settings))
    assert "Window" not in rollup and "hashpartitioning(event_id" not in rollup
    events = plan(staged.events())
    assert "hashpartitioning(event_id" not in events
    staged.release()


def test_duplicates_are_dropped_before_the_shuffle(fleet):
    text = plan(fleet.clean_telemetry)
    final, _, before = text.partition("Exchange hashpartitioning(event_id")
    assert "WindowGroupLimit" in final and "WindowGroupLimit" in before
    assert "Partial" in before


@pytest.mark.parametrize(
    "table", ["clean_telemetry", "tel_pairs", "fact_daily_vehicle_summary", "fact_trip_summary"]
)
def test_no_python_and_no_single_task_window(fleet, table):
    text = plan(getattr(fleet, table))
    assert not re.search(r"Python|Pandas|Arrow", text)
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_rows_of_single_ids_are_not_shuffled_for_the_duplicate_flag(fleet):
    text = plan(mark_duplicates(fleet.raw.telemetry, "event_id", "event_timestamp"))
    single, _, again = text.partition("Window")
    assert "Exchange hashpartitioning" not in single.split("BroadcastExchange")[0]
    # two ranks of the rows with repeated ids, and the count of the ids alone
    assert again.count("Exchange hashpartitioning(event_id") == 3


def test_kpis_read_each_fact_once_and_days_prune_files(spark, tmp_path, make_fleet):
    points = [point(f"e{i}", 86400 * (i % 3) + 60 * i, speed_kmph=99.0) for i in range(30)]
    build_warehouse(make_fleet(points, staged=True), str(tmp_path), csv=False, by_day=True)
    star = open_warehouse(spark, str(tmp_path))
    text = plan(reports.fleet_kpis(star, from_day=START.date(), to_day=START.date()))
    for column in ("total_distance_km", "actual_distance_km", "anomaly_type"):
        assert len(re.findall(rf"FileScan parquet [^\n]*{column}#", text)) == 1, column
    found = plan(reports.in_context(star, from_day=START.date())["fact_anomaly_events"])
    scan = next(x for x in found.splitlines() if "FileScan" in x and "anomaly_type#" in x)
    assert re.search(r"PartitionFilters: \[[^\]]*date_key#\d+ >= 20250120", scan)


def test_rollup_is_a_hash_aggregate(fleet):
    text = plan(fleet.rollup)
    assert re.search(r"HashAggregate\(keys=\[vehicle_id#\d+, driver_id", text)
    assert not re.search(r"SortAggregate\(key=\[vehicle_id#\d+, driver_id", text)


def test_raw_side_of_the_log_reads_ids_and_times_only(spark, tmp_path, make_fleet):
    from roadpulse.plans import quality
    from roadpulse.sources import schemas

    root = tmp_path / "raw"
    fleet = make_fleet([point("a", 0)])
    fleet.raw.telemetry.write.parquet(f"{root}/telemetry_events.parquet")
    for name, schema in [
        ("vehicles", schemas.VEHICLES), ("drivers", schemas.DRIVERS),
        ("customers", schemas.CUSTOMERS), ("trips", schemas.TRIPS),
    ]:
        spark.createDataFrame([], schema).write.option("header", True).csv(f"{root}/{name}.csv")
    raw = load_raw(spark, str(root))
    assert raw.telemetry.schema == schemas.TELEMETRY
    totals = plan(quality.quality_totals(raw.telemetry, fleet.checked_telemetry, fleet.settings))
    assert "ReadSchema: struct<event_id:string,event_timestamp:timestamp_ntz>" in totals
    late = plan(raw.telemetry.filter("event_timestamp >= '2025-01-26'").select("event_id"))
    assert "GreaterThanOrEqual(event_timestamp" in late
    assert "ReadSchema: struct<event_id:string,event_timestamp:timestamp_ntz>" in late
