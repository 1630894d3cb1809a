from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fleet_points import START, at, point, rows
from roadpulse.operators import SLICE, mark_runs


def speeding(fleet):
    return rows(fleet.anomaly_overspeed, "start_time", "end_time", "max_speed", "point_count")


def test_gap_of_exactly_120_seconds_holds_121_breaks(make_fleet):
    fast = dict(speed_kmph=61.0)
    fleet = make_fleet([point("a", 0, **fast), point("b", 120, **fast), point("c", 241, **fast)])
    assert speeding(fleet) == [(at(0), at(120), 61.0, 2), (at(241), at(241), 61.0, 1)]


def test_unflagged_point_between_breaks(make_fleet):
    fast = dict(speed_kmph=61.0)
    fleet = make_fleet([point("a", 0, **fast), point("b", 10), point("c", 20, **fast)])
    assert [r[3] for r in speeding(fleet)] == [1, 1]


def test_limit_is_strict_and_per_type(make_fleet):
    fleet = make_fleet(
        [point(f"{v}{s}", s, vehicle_id=v, speed_kmph=float(s))
         for v, limit in [("V1", 60), ("V2", 50), ("V3", 80), ("V4", 70)]
         for s in (limit, limit + 1)]
        + [point("tram", 500, vehicle_id="V5", speed_kmph=500.0),
           point("mute", 1, speed_kmph=None)]
    )
    assert rows(fleet.anomaly_overspeed, "vehicle_id", "max_speed", "speed_limit") == [
        ("V1", 61.0, 60), ("V2", 51.0, 50), ("V3", 81.0, 80), ("V4", 71.0, 70),
    ]


def test_event_takes_first_known_trip_and_earliest_peak(make_fleet):
    fleet = make_fleet([
        point("a", 0, speed_kmph=70.0, trip_id=None, driver_id="D2", latitude=21.0),
        point("b", 10, speed_kmph=90.0, trip_id="T2", latitude=22.0),
        point("c", 20, speed_kmph=90.0, trip_id="T1", latitude=23.0),
    ])
    assert rows(fleet.anomaly_overspeed, "driver_id", "trip_id", "latitude", "max_speed") == [
        ("D2", "T2", 22.0, 90.0)
    ]


def test_severity_bounds(make_fleet):
    far = 1000
    fleet = make_fleet([
        point("a", 0, speed_kmph=72.0),              # exactly 1.2 x 60
        point("b", far, speed_kmph=72.01),
    ])
    facts = fleet.unkeyed_anomalies
    assert rows(facts, "start_time", "severity", "metric_value", "threshold_value") == [
        (at(0), "MEDIUM", 72.0, 60.0), (at(far), "HIGH", 72.01, 60.0),
    ]
    assert rows(facts, "date_key", "time_key", "duration_secs") == [
        (20250120, 480, 0), (20250120, 496, 0),
    ]


@pytest.mark.parametrize(
    "seconds, severity",
    [(900, None), (901, "LOW"), (1799, "LOW"), (1800, "MEDIUM"), (3599, "MEDIUM"), (3600, "HIGH")],
)
def test_idle_duration(make_fleet, seconds, severity):
    times = [*range(0, seconds, 100), seconds]
    fleet = make_fleet([
        point(f"e{i:03}", t, speed_kmph=0.0, latitude=20.0 + i * 1e-7)
        for i, t in enumerate(times)
    ])
    found = rows(fleet.unkeyed_anomalies, "anomaly_type", "severity", "metric_value", "latitude")
    expected = [("EXCESSIVE_IDLING", severity, float(seconds), 20.0)] if severity else []
    assert found == expected


def test_idle_needs_ignition(make_fleet):
    still = dict(speed_kmph=0.0, ignition_status="OFF")
    fleet = make_fleet([point(f"e{i:03}", i * 60, **still) for i in range(30)])
    assert fleet.unkeyed_anomalies.count() == 0


def test_one_glitch_is_one_jump(make_fleet):
    fleet = make_fleet([
        point("a", 0), point("b", 10), point("c", 20, latitude=25.0), point("d", 30),
        point("e", 40),
    ])
    (jump,) = fleet.anomaly_gpsjump.collect()
    # into the bad fix and out of it; the event starts at the point before
    assert (jump["start_time"], jump["end_time"], jump["point_count"]) == (at(10), at(30), 2)
    assert jump["latitude"] == 25.0
    assert jump["implied_speed_kmph"] == pytest.approx(555.975 * 360, rel=1e-3)


def test_no_elapsed_time_is_no_jump(make_fleet):
    fleet = make_fleet([point("a", 0), point("b", 0, latitude=25.0)])
    assert fleet.anomaly_gpsjump.count() == 0


def test_null_time_closes_nothing_and_stays_last(make_fleet):
    fast = dict(speed_kmph=61.0)
    fleet = make_fleet([point("n", None, **fast), point("a", 0, **fast), point("b", 10, **fast)])
    ordered = rows(fleet.tel_ordered, "seq", "event_id", "prev_ts")
    assert ordered == [(1, "a", None), (2, "b", at(0)), (3, "n", at(10))]
    assert speeding(fleet) == [(at(0), at(10), 61.0, 3)]


def test_keys_follow_the_global_order(make_fleet):
    fast = dict(speed_kmph=100.0)
    fleet = make_fleet(
        [point(f"{v}-{i}", i * 1000, vehicle_id=v, **fast) for v in ("V1", "V2", "V3")
         for i in range(40)]
    )
    found = fleet.fact_anomaly_events.orderBy("anomaly_key").collect()
    assert [r["anomaly_key"] for r in found] == list(range(1, 121))
    order = [(r["start_time"], r["vehicle_id"], r["anomaly_type"]) for r in found]
    assert order == sorted(order)


def brute_force_runs(points, max_gap):
    """Runs of flagged neighbours, by walking each vehicle's points in order."""
    found = []
    for vehicle in sorted({p["vehicle_id"] for p in points}):
        mine = sorted(
            (p for p in points if p["vehicle_id"] == vehicle),
            key=lambda p: (p["event_timestamp"], p["event_id"]),
        )
        current, before = None, None
        for p in mine:
            if p["speed_kmph"] > 50:
                late = before is not None and (
                    int(p["event_timestamp"].timestamp()) - int(before.timestamp()) > max_gap
                )
                if current is None or late:
                    current = [vehicle, p["event_timestamp"], 0]
                    found.append(current)
                current[2] += 1
            else:
                current = None
            before = p["event_timestamp"]
    return sorted(map(tuple, found), key=repr)


def test_runs_against_brute_force(make_fleet):
    """Runs that cross the borders of slices, one vehicle holding 90 % of the points."""
    rng = random.Random(7)
    points, clock = [], dict.fromkeys(["V1", "V2", "V3"], 0.0)
    for i in range(2000):
        vehicle = "V1" if rng.random() < 0.9 else rng.choice(["V2", "V3"])
        clock[vehicle] += rng.choice([0.4, 5, 60, 119.7, 120.2, 300])
        points.append(
            point(f"e{i:04}", clock[vehicle], vehicle_id=vehicle,
                  speed_kmph=rng.choice([20.0, 80.0, 80.0, 80.0]))
        )
    timeline = make_fleet(points).ordered
    assert timeline.frame.select(SLICE).distinct().count() > 2
    marked = mark_runs(
        timeline, {"run": F.col("speed_kmph") > 50}, "seq", "event_timestamp", "prev_ts", 120
    )
    found = marked.frame.groupBy("vehicle_id", "run").agg(
        F.min("event_timestamp").alias("start"), F.count("*").alias("n")
    )
    assert rows(found, "vehicle_id", "start", "n") == sorted(
        brute_force_runs(points, 120), key=repr
    )
    assert any(
        START.date() < f["start"].date() for f in found.select("start").limit(500).collect()
    )
