from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fleet_points import at, point, rows
from roadpulse.operators import first_copies, mark_duplicates
from roadpulse.plans import quality
from roadpulse.settings import Settings

WEEK_END = (6 * 24 + 16) * 3600  # seconds from the test start to 2025-01-27 00:00


def flags_of(fleet, *names):
    return {r["event_id"]: tuple(r[n] for n in names) for r in fleet.flagged_telemetry.collect()}


def test_date_bound_is_inclusive_and_null_safe(make_fleet):
    fleet = make_fleet([
        point("last", WEEK_END - 1), point("first_out", WEEK_END), point("none", None),
        point("long_before", -400 * 86400),
    ])
    assert flags_of(fleet, "is_after_range") == {
        "last": (False,), "first_out": (True,), "none": (False,), "long_before": (False,),
    }


@pytest.mark.parametrize(
    "lat, lon, bad",
    [
        (6.0, 68.0, False), (36.0, 97.0, False), (5.999, 77.0, True), (36.001, 77.0, True),
        (20.0, 67.999, True), (20.0, 97.001, True), (0.0, 77.0, True), (20.0, 0.0, True),
        (None, 77.0, True), (20.0, None, True), (float("nan"), 77.0, True),
    ],
)
def test_gps_bounds(make_fleet, lat, lon, bad):
    fleet = make_fleet([point("a", 0, latitude=lat, longitude=lon)])
    assert flags_of(fleet, "is_bad_gps") == {"a": (bad,)}


def test_masters_and_null_ids(make_fleet):
    fleet = make_fleet([
        point("known", 0),
        point("orphans", 1, vehicle_id="V9", driver_id="D9", trip_id="T9"),
        point("nulls", 2, vehicle_id=None, driver_id=None, trip_id=None),
    ])
    names = ["is_orphan_vehicle", "is_orphan_driver", "is_orphan_trip", "is_null_trip"]
    assert flags_of(fleet, *names) == {
        "known": (False, False, False, False),
        "orphans": (True, True, True, False),
        "nulls": (True, True, False, True),
    }


def test_repairs(make_fleet):
    fleet = make_fleet([
        point("low", 0, battery_level=-4), point("high", 1, battery_level=104),
        point("none", 2, battery_level=None, speed_kmph=None),
        point("ids", 3, driver_id="D9", trip_id="T9"),
    ])
    assert rows(fleet.clean_telemetry, "event_id", "battery_level", "driver_id", "trip_id") == [
        ("high", 100, "D1", "T1"), ("ids", 50, "UNKNOWN", None), ("low", 0, "D1", "T1"),
        ("none", 0, "D1", "T1"),
    ]
    assert fleet.clean_telemetry.columns == fleet.raw.telemetry.columns


def test_repeated_master_keys_do_not_multiply_rows(spark, make_fleet):
    from dataclasses import replace

    fleet = make_fleet([point("a", 0), point("b", 1)])
    doubled = replace(
        fleet.raw,
        vehicles=fleet.raw.vehicles.union(fleet.raw.vehicles),
        trips=fleet.raw.trips.union(fleet.raw.trips),
    )
    assert quality.flagged_telemetry(doubled, Settings()).count() == 2
    assert quality.checked_telemetry(doubled, Settings()).count() == 2


def test_exclusive_reasons_and_log_reconcile(make_fleet):
    everything_wrong = dict(latitude=0.0, speed_kmph=-1.0, vehicle_id="V9", driver_id="D9")
    fleet = make_fleet([
        point("ok", 0), point("late", WEEK_END, **everything_wrong),
        point("dup", 0), point("dup", 5, **everything_wrong), point("dup", WEEK_END + 1),
        point("gps", 1, **everything_wrong),
        point("speed", 2, speed_kmph=-1.0, vehicle_id="V9"),
        point("vehicle", 3, vehicle_id="V9"),
        point("repair", 4, driver_id="D9", trip_id="T9", battery_level=104),
        point("off_trip", 6, trip_id=None),
    ])
    log = {r["check_name"]: r["records_affected"] for r in fleet.dq_log.collect()}
    assert log == {
        "total_raw_rows": 10, "out_of_range_date": 2, "duplicate_event_id": 1,
        "invalid_gps": 1, "negative_speed": 1, "orphan_vehicle": 1, "orphan_driver": 1,
        "orphan_trip": 1, "battery_out_of_range": 1, "null_trip_id": 1, "rows_accepted": 4,
    }
    assert rows(fleet.reconciliation(), "rows_read", "rows_rejected", "unaccounted") == [
        (10, 6, 0)
    ]
    by_row = quality.with_reject_reason(fleet.flagged_telemetry)
    counted = by_row.groupBy("reject_reason").agg(F.count("*").alias("n")).collect()
    assert {r["reject_reason"]: r["n"] for r in counted} == {
        None: 4, "out_of_range_date": 2, "duplicate_event_id": 1, "invalid_gps": 1,
        "negative_speed": 1, "orphan_vehicle": 1,
    }


def test_log_wording_of_the_published_week():
    details = {check: detail for _, check, _, detail in quality.log_lines(Settings())}
    assert details["out_of_range_date"] == (
        "event_timestamp on the partial trailing day 2025-01-27 (outside 7-day window)"
    )
    assert details["invalid_gps"] == (
        "lat/lon null, zero, or outside India bounds (6-36N, 68-97E)"
    )


def test_duplicates_null_ids_null_times_and_exact_copies(make_fleet):
    """A third and more of all rows share one id, spread over many partitions."""
    copies = [point("hot", 100 + i % 7, heading=float(i % 5)) for i in range(300)]
    nameless = [point(None, 50 + i) for i in range(100)]
    timeless = [point("t", None), point("t", 9), point("u", None), point("u", None)]
    single = [point(f"s{i}", i) for i in range(50)]
    telemetry = make_fleet(copies + nameless + timeless + single).raw.telemetry.repartition(13)

    marked = mark_duplicates(telemetry, "event_id", "event_timestamp")
    assert marked.count() == 454
    kept = marked.filter("NOT is_duplicate").drop("is_duplicate")
    firsts = first_copies(telemetry, "event_id", "event_timestamp")
    assert rows(kept) == rows(firsts)
    chosen = {r["event_id"]: r["event_timestamp"] for r in firsts.collect()}
    assert len(chosen) == firsts.count() == 54
    assert chosen["hot"] == at(100) and chosen[None] == at(50)
    assert chosen["t"] == at(9) and chosen["u"] is None
    # equal times: the lowest of the remaining columns
    assert rows(firsts.filter("event_id = 'hot'"), "heading") == [(0.0,)]
