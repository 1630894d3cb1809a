"""CSV masters are bound by header and read strictly; the log can fail to add up."""

from __future__ import annotations

import pytest

from fleet_points import point, rows
from roadpulse.plans import quality
from roadpulse.sources import schemas
from roadpulse.sources.raw import read_csv

HEADER = "vehicle_type,extra,vehicle_id,registration_date,customer_id,vehicle_number"


def written(tmp_path, *lines):
    path = tmp_path / "vehicles.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_columns_are_bound_by_name(spark, tmp_path):
    path = written(tmp_path, HEADER, "BIKE,x,V1,2023-01-02,C1,MH1", "LCV,,V2,,C2,")
    got = read_csv(spark, path, schemas.VEHICLES)
    assert got.schema == schemas.VEHICLES
    assert rows(got, "vehicle_id", "vehicle_type", "vehicle_number") == [
        ("V1", "BIKE", "MH1"), ("V2", "LCV", None),
    ]


def test_missing_column_raises(spark, tmp_path):
    path = written(tmp_path, HEADER.replace("customer_id", "client"), "BIKE,x,V1,2023-01-02,C1,M")
    with pytest.raises(ValueError, match="customer_id"):
        read_csv(spark, path, schemas.VEHICLES)


def test_bad_date_raises(spark, tmp_path):
    path = written(tmp_path, HEADER, "BIKE,x,V1,not-a-date,C1,MH1")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_csv(spark, path, schemas.VEHICLES).collect()


def test_rows_lost_in_deduplication_are_unaccounted(make_fleet):
    fleet = make_fleet([point(f"e{i}", i) for i in range(20)] + [point("e3", 99)])
    totals = quality.quality_totals(
        fleet.raw.telemetry, fleet.checked_telemetry.filter("event_id <> 'e7'"), fleet.settings
    )
    log = quality.audit_log(totals, fleet.settings)
    assert rows(quality.reconciliation(log), "rows_read", "rows_accepted", "unaccounted") == [
        (21, 19, 1)
    ]
    assert rows(fleet.reconciliation(), "unaccounted") == [(0,)]
