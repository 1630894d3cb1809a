"""Hand-written telemetry points and helpers of the fleet tests."""

from __future__ import annotations

from datetime import datetime, timedelta

TESTDATA = "/root/testdata"
START = datetime(2025, 1, 20, 8, 0, 0)


def at(seconds: float | None) -> datetime | None:
    return None if seconds is None else START + timedelta(seconds=seconds)


def point(event_id, seconds, **changes) -> dict:
    """One valid telemetry row, ``seconds`` after the start of the test day."""
    row = {
        "event_id": event_id,
        "vehicle_id": "V1",
        "driver_id": "D1",
        "trip_id": "T1",
        "event_timestamp": at(seconds),
        "latitude": 20.0,
        "longitude": 77.0,
        "speed_kmph": 30.0,
        "heading": 0.0,
        "gps_accuracy": 1.0,
        "ignition_status": "ON",
        "battery_level": 50,
    }
    unknown = changes.keys() - row.keys()
    assert not unknown, unknown
    return row | changes


def rows(df, *columns) -> list[tuple]:
    """All rows as tuples, in a stable order."""
    picked = df.select(*columns) if columns else df.select(*sorted(df.columns))
    return sorted((tuple(r) for r in picked.collect()), key=repr)
