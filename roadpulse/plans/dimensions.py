"""The five conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions import date_key
from roadpulse.settings import UNKNOWN_DRIVER, Settings


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_name", "city", "industry")


def dim_vehicle(vehicles: DataFrame, speed_limits: DataFrame) -> DataFrame:
    """Vehicles with the limit of their type (NULL for a type without one)."""
    # no hint needed: the optimizer knows that the limits are a four-row list
    return vehicles.join(speed_limits, "vehicle_type", "left").select(
        "vehicle_id",
        "vehicle_number",
        "vehicle_type",
        "customer_id",
        F.col("speed_limit").alias("speed_limit_kmph"),
        "registration_date",
    )


def dim_driver(drivers: DataFrame) -> DataFrame:
    """Drivers plus the member that telemetry without a known driver points to."""
    columns = drivers.select(
        "driver_id",
        "driver_name",
        "phone",
        "license_number",
        F.col("vehicle_id").alias("assigned_vehicle_id"),
        "joining_date",
    )
    values = {"driver_id": UNKNOWN_DRIVER, "driver_name": "Unknown Driver"}
    unknown = drivers.sparkSession.range(1).select(
        [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in columns.schema]
    )
    return columns.unionByName(unknown)


def dim_date(spark: SparkSession, telemetry: DataFrame, settings: Settings) -> DataFrame:
    """One row per day, first and last day included."""
    last = F.lit(settings.last_day)
    if settings.first_day is not None:
        bounds = spark.range(1).select(F.lit(settings.first_day).alias("first"))
    else:
        bounds = telemetry.agg(F.to_date(F.min("event_timestamp")).alias("first"))
    # an empty range would count backwards, so it is filtered out first
    days = bounds.filter(F.col("first") <= last).select(
        F.explode(F.sequence("first", last)).alias("date")
    )
    day = F.col("date")
    sunday_first = (F.dayofweek(day) - 1).cast("bigint")
    return days.select(
        date_key(day).alias("date_key"),
        "date",
        F.dayofmonth(day).cast("bigint").alias("day"),
        F.month(day).cast("bigint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.year(day).cast("bigint").alias("year"),
        sunday_first.alias("day_of_week"),
        F.when(sunday_first == 0, F.lit(7).cast("bigint"))
        .otherwise(sunday_first)
        .alias("day_sort"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).cast("bigint").alias("week_of_year"),
        sunday_first.isin(0, 6).alias("is_weekend"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per minute of the day."""
    minute_of_day = F.col("id")
    hour = F.floor(minute_of_day / 60)
    part = (
        F.when((hour < 6) | (hour >= 21), "Night")
        .when(hour < 12, "Morning")
        .when(hour < 17, "Afternoon")
        .otherwise("Evening")
    )
    return spark.range(0, 24 * 60, 1, 1).select(
        minute_of_day.alias("time_key"),
        hour.alias("hour"),
        (minute_of_day % 60).alias("minute"),
        F.format_string("%02d:%02d", hour, minute_of_day % 60).alias("hh_mm"),
        part.alias("part_of_day"),
    )
