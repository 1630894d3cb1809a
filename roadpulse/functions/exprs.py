"""Column expressions shared by the plans. All are built-in Spark functions, so
they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole-second boundaries crossed from ``start`` to ``end`` (BIGINT).

    Both ends are floored to the second first: 00:00:00.9 to 00:00:01.1 is 1.
    """
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def date_key(moment: Column) -> Column:
    """Calendar day as the integer YYYYMMDD."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def time_key(moment: Column) -> Column:
    """Minute of the day, 0 to 1439 (BIGINT)."""
    return (F.hour(moment) * 60 + F.minute(moment)).cast("bigint")


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double by scaling it, halves away from zero.

    ``round(value, digits)`` works on the shortest decimal text of the double
    (1.005 gives 1.01); the scaled form works on its binary value (1.0).
    """
    if digits == 0:
        return F.round(value, 0)
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def settle(value: Column) -> Column:
    """Drop the noise that the order of a floating-point sum leaves behind.

    Averages of two-decimal speeds often end in exactly ...5; without this the
    last digit after rounding would change from run to run with shuffle order.
    """
    return round_half_away(value, 9)


def haversine_km(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_km: float
) -> Column:
    """Great-circle distance between two points given in degrees."""
    half_lat = F.sin(F.radians(lat2 - lat1) / F.lit(2.0))
    half_lon = F.sin(F.radians(lon2 - lon1) / F.lit(2.0))
    chord = half_lat * half_lat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * (half_lon * half_lon)
    )
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(chord))


def first_known(value: Column, order: Column, moment: Column) -> Column:
    """Aggregate: the first non-NULL ``value`` by ``order``, among rows that have
    a ``moment``. Plain ``min_by`` would return the NULL of the first row."""
    return F.min_by(value, F.when(value.isNotNull() & moment.isNotNull(), order))
