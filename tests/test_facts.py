from __future__ import annotations

import pytest

from fleet_points import at, point, rows

MIDNIGHT = 16 * 3600  # seconds from the test start to 2025-01-21 00:00


def only(df) -> dict:
    (row,) = df.collect()
    return row.asDict()


def test_segments_cap_time_and_integrate_speed(make_fleet):
    fleet = make_fleet([
        point("a", 0, speed_kmph=30.0), point("b", 60, speed_kmph=60.0),
        point("c", 3660, speed_kmph=60.0, ignition_status="OFF"), point("d", 3700),
    ])
    found = rows(fleet.tel_pairs, "prev_ts", "raw_dt_sec", "dt_sec", "effective_km")
    assert found == [
        (at(0), 60, 60, pytest.approx(0.75)),
        (at(60), 3600, 300, pytest.approx(5.0)),
        (at(3660), 40, 40, 0.0),
    ]


def test_elapsed_counts_second_boundaries(make_fleet):
    fleet = make_fleet([point("a", 0.9), point("b", 1.1), point("c", 1.9)])
    assert rows(fleet.tel_pairs, "event_timestamp", "raw_dt_sec") == [
        (at(1.1), 1), (at(1.9), 0),
    ]


def test_daily_summary_attributes_segments_to_the_earlier_day(make_fleet):
    fleet = make_fleet([
        point("a", MIDNIGHT - 100, speed_kmph=36.0),
        point("b", MIDNIGHT + 100, speed_kmph=36.0, trip_id="T2"),
        point("c", MIDNIGHT + 200, speed_kmph=0.0, trip_id=None),
        point("d", MIDNIGHT + 300, speed_kmph=0.0),
    ])
    days = {r["date_key"]: r for r in fleet.fact_daily_vehicle_summary.collect()}
    first, second = days[20250120], days[20250121]
    assert (first["total_distance_km"], first["running_hours"]) == (2.0, 0.06)
    assert (second["total_distance_km"], second["running_hours"]) == (0.5, 0.06)
    assert (first["idle_hours"], second["idle_hours"]) == (0.0, 0.03)
    assert (first["trip_count"], second["trip_count"]) == (1, 2)
    assert (second["avg_speed"], second["max_speed"]) == (36.0, 36.0)


def test_daily_summary_without_movement(make_fleet):
    fleet = make_fleet([point("a", 0, speed_kmph=0.0, trip_id=None)])
    day = only(fleet.fact_daily_vehicle_summary)
    assert day["avg_speed"] is None and day["max_speed"] == 0.0
    assert (day["total_distance_km"], day["trip_count"], day["anomaly_count"]) == (0.0, 0, 0)


def test_trip_summary_counts_same_trip_segments_only(make_fleet):
    fleet = make_fleet([
        point("a", 0, trip_id=None, speed_kmph=50.0),
        point("b", 100, speed_kmph=36.0, driver_id="D2"),
        point("c", 200, speed_kmph=0.0),
        point("d", 300, speed_kmph=0.0),
        point("e", 400, speed_kmph=80.0),
        point("f", 500, trip_id="T2"),
    ])
    trips = {r["trip_id"]: r for r in fleet.fact_trip_summary.collect()}
    trip = trips["T1"]
    assert set(trips) == {"T1", "T2"}
    assert (trip["driver_id"], trip["actual_start"], trip["actual_end"]) == ("D2", at(100), at(400))
    assert trip["actual_duration_mins"] == 5.0
    assert trip["actual_distance_km"] == 1.61  # 100 s at 18 km/h and at 40 km/h
    assert (trip["idle_time_mins"], trip["running_hours"]) == (3.33, 0.08)
    assert (trip["stoppage_count"], trip["anomaly_count"]) == (1, 1)
    assert (trip["avg_speed"], trip["max_speed"], trip["time_key"]) == (58.0, 80.0, 481)
    assert trips["T2"]["actual_distance_km"] == 0.0


def test_trip_must_be_in_the_master(make_fleet):
    fleet = make_fleet([point("a", 0, trip_id="T9"), point("b", 1, trip_id=None)])
    assert fleet.fact_trip_summary.count() == 0


def test_rounding_is_by_binary_value(spark):
    from pyspark.sql import functions as F

    from roadpulse.functions import round_half_away, settle

    values = spark.createDataFrame([(1.005,), (2.5,), (-2.5,), (10.015,)], "x double")
    found = values.select(
        round_half_away(F.col("x"), 2).alias("r"), round_half_away(F.col("x"), 0).alias("w")
    )
    assert [tuple(r) for r in found.collect()] == [
        (1.0, 1.0), (2.5, 3.0), (-2.5, -3.0), (10.02, 10.0),
    ]
    noisy = spark.createDataFrame([(0.1 + 0.2,)], "x double").select(settle(F.col("x")).alias("x"))
    assert noisy.first()["x"] == 0.3


def test_calendar_and_clock(make_fleet):
    fleet = make_fleet([point("a", 0)])
    days = fleet.dim_date.orderBy("date_key").collect()
    assert [r["date_key"] for r in days] == list(range(20250120, 20250127))
    assert [r["day_sort"] for r in days] == [1, 2, 3, 4, 5, 6, 7]
    assert (days[-1]["day_of_week"], days[-1]["day_name"], days[-1]["is_weekend"]) == (
        0, "Sunday", True,
    )
    assert (days[0]["month_name"], days[-1]["week_of_year"]) == ("January", 4)
    minutes = {r["hh_mm"]: r["part_of_day"] for r in fleet.dim_time.collect()}
    assert len(minutes) == 1440
    bounds = ["05:59", "06:00", "11:59", "12:00", "16:59", "17:00", "20:59", "21:00", "23:59"]
    assert [minutes[b] for b in bounds] == [
        "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night",
        "Night",
    ]
