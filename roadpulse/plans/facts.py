"""Daily and trip facts, both read off one small rollup of the ordered points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import (
    date_key,
    elapsed_seconds,
    round_half_away,
    settle,
    time_key,
)
from roadpulse.operators import Timeline
from roadpulse.plans.segments import engine_was_on, segment_km, segment_seconds
from roadpulse.settings import Settings


def activity_rollup(timeline: Timeline, settings: Settings) -> DataFrame:
    """Sums per vehicle, driver, trip, day of the point and day of its segment.

    This is the only aggregation that reads event-sized data. All its buffers
    have a fixed width, so it runs as a hash aggregate that combines in the map
    tasks; its rows follow the changes of driver, trip and day, not the points.
    Whatever the facts need beyond sums (the driver at a trip's first point,
    distinct trips per day, the two different day attributions) is worked out
    on its result.
    """
    has_segment = F.col("prev_ts").isNotNull()
    same_trip = has_segment & (F.col("prev_trip") == F.col("trip_id"))
    stood = F.col("prev_speed") == 0
    moving = F.col("speed_kmph") > 0
    seconds, km, running = segment_seconds(settings), segment_km(settings), engine_was_on()
    stopped_here = same_trip & (F.col("prev_speed") > 0) & (F.col("speed_kmph") == 0)
    return timeline.frame.groupBy(
        "vehicle_id",
        "driver_id",
        "trip_id",
        F.to_date("event_timestamp").alias("own_day"),
        F.to_date("prev_ts").alias("segment_day"),
    ).agg(
        F.min("event_timestamp").alias("first_at"),
        F.max("event_timestamp").alias("last_at"),
        F.sum(F.when(moving, F.col("speed_kmph"))).alias("moving_speed_sum"),
        F.count_if(moving).alias("moving_points"),
        F.max("speed_kmph").alias("max_speed"),
        F.sum(F.when(has_segment, km)).alias("km"),
        F.sum(F.when(has_segment & running, seconds)).alias("running_sec"),
        F.sum(F.when(has_segment & running & stood, seconds)).alias("idle_sec"),
        F.sum(F.when(same_trip, km)).alias("trip_km"),
        F.sum(F.when(same_trip & running, seconds)).alias("trip_running_sec"),
        F.sum(F.when(same_trip & running & stood, seconds)).alias("trip_idle_sec"),
        F.count_if(stopped_here).alias("stops"),
    )


def _mean_speed():
    return F.try_divide(F.sum("moving_speed_sum"), F.sum("moving_points"))


def _rounded(value, digits: int = 2):
    return round_half_away(settle(value), digits)


def daily_vehicle_summary(rollup: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Vehicle x day. Speeds and trips belong to the day of the point, distance
    and times to the day on which the segment began."""
    none = F.lit(None)
    of_points = F.struct(
        date_key(F.col("own_day")).alias("date_key"),
        F.lit(True).alias("has_points"),
        F.col("trip_id").alias("trip_id"),
        "moving_speed_sum",
        "moving_points",
        "max_speed",
        none.cast("double").alias("km"),
        none.cast("bigint").alias("running_sec"),
        none.cast("bigint").alias("idle_sec"),
    )
    of_segments = F.struct(
        date_key(F.col("segment_day")).alias("date_key"),
        F.lit(False).alias("has_points"),
        none.cast("string").alias("trip_id"),
        none.cast("double").alias("moving_speed_sum"),
        none.cast("bigint").alias("moving_points"),
        none.cast("double").alias("max_speed"),
        "km",
        "running_sec",
        "idle_sec",
    )
    shares = rollup.select(
        "vehicle_id",
        F.inline(F.array(of_points, F.when(F.col("segment_day").isNotNull(), of_segments))),
    ).filter("has_points IS NOT NULL")
    days = (
        shares.groupBy("date_key", "vehicle_id")
        .agg(
            F.bool_or("has_points").alias("has_points"),
            F.sum("km").alias("km"),
            F.sum("running_sec").alias("running_sec"),
            F.sum("idle_sec").alias("idle_sec"),
            _mean_speed().alias("avg_speed"),
            F.max("max_speed").alias("max_speed"),
            F.count_distinct("trip_id").alias("trip_count"),
        )
        .filter("has_points")
    )
    counts = (
        anomalies.filter(F.col("date_key").isNotNull())
        .groupBy("date_key", "vehicle_id")
        .agg(F.count("*").alias("anomaly_count"))
    )
    zero = F.lit(0.0)
    return days.join(counts, ["date_key", "vehicle_id"], "left").select(
        "date_key",
        "vehicle_id",
        _rounded(F.coalesce("km", zero)).alias("total_distance_km"),
        _rounded(F.coalesce(F.col("running_sec") / 3600.0, zero)).alias("running_hours"),
        _rounded(F.coalesce(F.col("idle_sec") / 3600.0, zero)).alias("idle_hours"),
        _rounded(F.col("avg_speed")).alias("avg_speed"),
        "max_speed",
        "trip_count",
        F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
    )


def trip_summary(rollup: DataFrame, trips: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One row per trip that is in the master and has telemetry. Segment measures
    count segments with both ends on the trip."""
    origin = F.when(
        F.col("first_at").isNotNull(), F.struct("first_at", "vehicle_id", "driver_id")
    )
    driven = (
        rollup.filter(F.col("trip_id").isNotNull())
        .groupBy("trip_id")
        .agg(
            F.min(origin).alias("origin"),
            F.max("last_at").alias("actual_end"),
            _mean_speed().alias("avg_speed"),
            F.max("max_speed").alias("max_speed"),
            F.sum("trip_km").alias("km"),
            F.sum("trip_running_sec").alias("running_sec"),
            F.sum("trip_idle_sec").alias("idle_sec"),
            F.sum("stops").alias("stoppage_count"),
        )
    )
    counts = (
        anomalies.filter(F.col("trip_id").isNotNull())
        .groupBy("trip_id")
        .agg(F.count("*").alias("anomaly_count"))
    )
    planned = trips.select(
        "trip_id", "origin_city", "destination_city", "status", "planned_start", "planned_end"
    )
    start, end, zero = F.col("origin.first_at"), F.col("actual_end"), F.lit(0.0)
    return (
        driven.join(planned, "trip_id")
        .join(counts, "trip_id", "left")
        .select(
            "trip_id",
            F.col("origin.vehicle_id").alias("vehicle_id"),
            F.col("origin.driver_id").alias("driver_id"),
            "origin_city",
            "destination_city",
            "status",
            "planned_start",
            "planned_end",
            start.alias("actual_start"),
            "actual_end",
            _rounded(elapsed_seconds(start, end) / 60.0).alias("actual_duration_mins"),
            _rounded(F.coalesce("km", zero)).alias("actual_distance_km"),
            _rounded(F.col("avg_speed")).alias("avg_speed"),
            "max_speed",
            _rounded(F.coalesce(F.col("idle_sec") / 60.0, zero)).alias("idle_time_mins"),
            _rounded(F.coalesce(F.col("running_sec") / 3600.0, zero)).alias("running_hours"),
            "stoppage_count",
            F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
            date_key(start).alias("date_key"),
            time_key(start).alias("time_key"),
        )
    )
