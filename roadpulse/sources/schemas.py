"""Declared schemas of the raw inputs. Nothing is inferred: inference would read
a phone number as BIGINT and a trip id such as ``T1`` as a timestamp."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(columns: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


TELEMETRY = _schema([
    ("event_id", T.StringType()),
    ("vehicle_id", T.StringType()),
    ("driver_id", T.StringType()),
    ("trip_id", T.StringType()),
    ("event_timestamp", T.TimestampNTZType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("speed_kmph", T.DoubleType()),
    ("heading", T.DoubleType()),
    ("gps_accuracy", T.DoubleType()),
    ("ignition_status", T.StringType()),
    ("battery_level", T.IntegerType()),
])

VEHICLES = _schema([
    ("vehicle_id", T.StringType()),
    ("vehicle_number", T.StringType()),
    ("vehicle_type", T.StringType()),
    ("customer_id", T.StringType()),
    ("registration_date", T.DateType()),
])

DRIVERS = _schema([
    ("driver_id", T.StringType()),
    ("driver_name", T.StringType()),
    ("phone", T.StringType()),
    ("license_number", T.StringType()),
    ("vehicle_id", T.StringType()),
    ("joining_date", T.DateType()),
])

CUSTOMERS = _schema([
    ("customer_id", T.StringType()),
    ("customer_name", T.StringType()),
    ("city", T.StringType()),
    ("industry", T.StringType()),
])

TRIPS = _schema([
    ("trip_id", T.StringType()),
    ("vehicle_id", T.StringType()),
    ("driver_id", T.StringType()),
    ("planned_start", T.TimestampNTZType()),
    ("planned_end", T.TimestampNTZType()),
    ("origin_city", T.StringType()),
    ("destination_city", T.StringType()),
    ("status", T.StringType()),
])

