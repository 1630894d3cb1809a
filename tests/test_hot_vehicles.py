"""Slices, staging and joins without broadcasts must not change a single value."""

from __future__ import annotations

import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleet_points import TESTDATA, point, rows
from roadpulse import Fleet
from roadpulse.operators import SLICE
from roadpulse.plans import quality, segments
from roadpulse.sources import load_testbed
from roadpulse.sources.testbed import TESTBED_SETTINGS


@pytest.fixture(scope="module")
def fleet(spark):
    return Fleet(spark, load_testbed(spark, f"{TESTDATA}/sf0.001"), TESTBED_SETTINGS)


def test_sliced_points_equal_one_window_per_vehicle(fleet):
    assert fleet.ordered.frame.select(SLICE).distinct().count() > 10
    window = Window.partitionBy("vehicle_id").orderBy(
        *[F.col(c).asc_nulls_last() for c in segments.ORDER]
    )
    plain = fleet.clean_telemetry.select(
        "*",
        F.row_number().over(window).cast("bigint").alias("seq"),
        *[F.lag(c).over(window).alias(n) for n, c in segments.LOOK_BACK.items()],
    )
    assert rows(fleet.tel_ordered) == rows(plain)


def crowded_points() -> list[dict]:
    """Nine tenths of the points on one day of V1: a busy minute, one instant with many
    points, and many without a time."""
    rng = random.Random(5)
    points = [point(f"a{i:05}", rng.random() * 60, speed_kmph=80.0) for i in range(400)]
    points += [point(f"EV-00{rng.randrange(10**6):06}x{i}", 30.5) for i in range(400)]
    points += [point(f"é{i}" if i % 2 else f"n{i}", None) for i in range(400)]
    points += [point("", 30.5), point("", None)]
    points += [point(f"r{i}", rng.random() * 86400 * 3, vehicle_id="V2") for i in range(60)]
    points += [point("same", 70_000) for _ in range(300)]  # one id: nothing to cut
    rng.shuffle(points)
    return points


@pytest.mark.parametrize("staged", [False, True])
def test_crowded_days_are_cut_further(make_fleet, monkeypatch, staged):
    whole = make_fleet(crowded_points())
    expected = rows(whole.tel_ordered)
    events = rows(whole.unkeyed_anomalies)
    assert whole.ordered.frame.filter("vehicle_id = 'V1'").select(SLICE).distinct().count() == 3
    monkeypatch.setattr(segments, "SLICE_ROWS", 40)
    fleet = make_fleet(crowded_points(), staged=staged)
    assert rows(fleet.tel_ordered) == expected and events
    assert rows(fleet.unkeyed_anomalies) == events
    sizes = fleet.ordered.frame.groupBy("vehicle_id", SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 40
    quiet = fleet.ordered.frame.filter("vehicle_id = 'V2'")
    assert quiet.agg(F.max(F.length(SLICE))).first()[0] == 10  # only crowded days are cut
    fleet.release()


def test_nothing_is_cut_without_crowds(make_fleet):
    for points in ([], [point("a", 0), point(None, None, vehicle_id=None)]):
        fleet = make_fleet(points)
        assert fleet._crowded == [] and fleet.tel_ordered.count() == min(1, len(points))


def test_staging_changes_nothing_and_leaves_nothing(spark, fleet):
    staged = Fleet(spark, fleet.raw, TESTBED_SETTINGS, staged=True)
    tables = ("dq_log", "fact_daily_vehicle_summary", "fact_trip_summary", "fact_anomaly_events")
    for table in tables:
        assert rows(getattr(fleet, table)) == rows(getattr(staged, table))
    folder = staged.workspace.root
    staged.release()
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


@pytest.fixture
def no_broadcasts(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_masters_too_large_to_broadcast(spark, fleet, request, monkeypatch):
    """Without broadcasts the masters and the slices are sort-merged, to the same result,
    even where the lists of unknown ids are too long as well."""
    expected = rows(fleet.fact_trip_summary)
    request.getfixturevalue("no_broadcasts")
    monkeypatch.setattr(quality, "SHORT_LIST_BYTES", -1)
    merged = Fleet(spark, fleet.raw, TESTBED_SETTINGS).fact_trip_summary
    assert rows(merged) == expected
    assert "BroadcastHashJoin" not in merged._jdf.queryExecution().toString()


@pytest.mark.parametrize("table", ["flagged_telemetry", "checked_telemetry"])
@pytest.mark.parametrize("limit", [quality.SHORT_LIST_BYTES, -1])
def test_unknown_ids_find_the_same_orphans(spark, fleet, request, monkeypatch, table, limit):
    """Masters too large to broadcast: rows meet the unknown ids, not the masters."""
    expected = rows(getattr(fleet, table))
    request.getfixturevalue("no_broadcasts")
    monkeypatch.setattr(quality, "SHORT_LIST_BYTES", limit)
    looked_up = getattr(Fleet(spark, fleet.raw, TESTBED_SETTINGS), table)
    assert rows(looked_up) == expected
    wide = re.findall(
        r"hashpartitioning\((?:coalesce\()?(trip_id|driver_id|vehicle_id)#",
        looked_up._jdf.queryExecution().executedPlan().toString(),
    )
    assert (wide == []) == (limit > 0)


@pytest.mark.parametrize("limit", [quality.SHORT_LIST_BYTES, -1])
def test_rows_without_ids_pass_around_the_unknown_ids(
    make_fleet, no_broadcasts, monkeypatch, limit
):
    monkeypatch.setattr(quality, "SHORT_LIST_BYTES", limit)
    fleet = make_fleet(
        [point(f"n{i}", i, trip_id=None, driver_id=None, vehicle_id=None) for i in range(200)]
        + [point(f"u{i}", i, trip_id="T9", driver_id=f"D{i}") for i in range(100)]
        + [point(None, None, vehicle_id="V9", trip_id="")]
    )
    names = ["is_orphan_trip", "is_orphan_driver", "is_orphan_vehicle"]
    counted = fleet.flagged_telemetry.groupBy("trip_id", *names).count()
    assert rows(counted, "trip_id", *names, "count") == sorted(
        [
            (None, False, True, True, 200),
            ("T9", True, False, False, 2),  # D1 and D2 are known
            ("T9", True, True, False, 98),
            ("", True, False, True, 1),
        ],
        key=repr,
    )


def test_empty_telemetry_and_masters_without_broadcasts(spark, make_fleet, no_broadcasts):
    fleet = make_fleet([])
    assert fleet.checked_telemetry.count() == 0
    bare = replace(fleet.raw, trips=fleet.raw.trips.limit(0), telemetry=make_fleet(
        [point("a", 0)]
    ).raw.telemetry)
    found = rows(Fleet(spark, bare).flagged_telemetry, "is_orphan_trip", "is_orphan_driver")
    assert found == [(True, False)]
