"""Three anomaly detectors over ordered points, collapsed to one row per event."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import (
    date_key,
    elapsed_seconds,
    first_known,
    haversine_km,
    round_half_away,
    time_key,
)
from roadpulse.operators import Runs
from roadpulse.settings import EXCESSIVE_IDLING, GPS_JUMP, OVERSPEEDING, Settings


@dataclass(frozen=True)
class Detector:
    """What makes a point part of an event, and what the event reports."""

    anomaly_type: str
    flag: Column
    # instant at which the point's contribution begins
    begins: Column
    # value whose peak the event reports, with the position of that peak
    peak: Column
    threshold: Column

    @property
    def column(self) -> str:
        return f"run_{self.anomaly_type.lower()}"


def overspeeding() -> Detector:
    limit = F.col("speed_limit_kmph")
    return Detector(
        OVERSPEEDING,
        F.col("speed_kmph") > limit,
        F.col("event_timestamp"),
        F.col("speed_kmph"),
        limit.cast("double"),
    )


def excessive_idling(settings: Settings) -> Detector:
    return Detector(
        EXCESSIVE_IDLING,
        (F.col("ignition_status") == "ON") & (F.col("speed_kmph") == 0),
        F.col("event_timestamp"),
        # level all along, so the earliest point gives the position
        F.lit(0.0),
        F.lit(float(settings.idle_alarm_sec)),
    )


def gps_jump(settings: Settings) -> Detector:
    """Implied speed between two fixes above the limit; it uses the real elapsed
    time, not the capped one, and no time at all implies no speed."""
    seconds = elapsed_seconds(F.col("prev_ts"), F.col("event_timestamp"))
    distance = haversine_km(
        F.col("prev_lat"),
        F.col("prev_lon"),
        F.col("latitude"),
        F.col("longitude"),
        settings.earth_radius_km,
    )
    implied = F.try_divide(distance, seconds / F.lit(3600.0))
    return Detector(
        GPS_JUMP,
        (seconds > 0) & (implied > settings.jump_kmph),
        F.col("prev_ts"),
        implied,
        F.lit(float(settings.jump_kmph)),
    )


def detectors(settings: Settings) -> list[Detector]:
    return [overspeeding(), excessive_idling(settings), gps_jump(settings)]


def with_speed_limit(points: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Attach each vehicle's limit, one per vehicle, NULL if its type has none.

    No hint: small limit lists are broadcast, larger ones are joined on vehicle_id.
    """
    limits = vehicles.groupBy("vehicle_id").agg(
        F.max("speed_limit_kmph").alias("speed_limit_kmph")
    )
    return points.join(limits, "vehicle_id", "left")


def runs_of(chosen: list[Detector], settings: Settings) -> Runs:
    """The runs of the detectors' flags, for points with look-back columns and limit."""
    return Runs(
        {d.column: d.flag for d in chosen}, "event_timestamp", "prev_ts", settings.run_gap_sec
    )


def collapse(marked: DataFrame, settings: Settings, chosen: list[Detector]) -> DataFrame:
    """Events of ordered points whose runs are marked, for all chosen detectors in one pass.

    A point that is part of events of several types contributes one narrow record
    to each, and the records are grouped per (vehicle, type, run), combining in
    the map tasks.
    """
    records = F.array(
        *[
            F.when(
                F.col(d.column).isNotNull(),
                F.struct(
                    F.lit(d.anomaly_type).alias("anomaly_type"),
                    F.col(d.column).alias("run"),
                    d.begins.alias("begins"),
                    d.peak.alias("peak"),
                    d.threshold.alias("threshold"),
                ),
            )
            for d in chosen
        ]
    )
    kept = ["vehicle_id", "driver_id", "trip_id", "event_timestamp", "latitude", "longitude"]
    points = marked.select(*kept, "seq", F.inline(records)).filter("run IS NOT NULL")
    seq, moment = F.col("seq"), F.col("event_timestamp")
    events = (
        # the run comes first: sorting for the groups then compares numbers
        points.groupBy("run", "vehicle_id", "anomaly_type")
        .agg(
            first_known(F.col("driver_id"), seq, moment).alias("driver_id"),
            first_known(F.col("trip_id"), seq, moment).alias("trip_id"),
            F.min("begins").alias("start_time"),
            F.max("event_timestamp").alias("end_time"),
            F.max("peak").alias("peak"),
            F.max("threshold").alias("threshold_value"),
            # the place of the peak, the earliest one if it is reached again
            F.max_by(F.struct("latitude", "longitude"), F.struct("peak", -seq)).alias("place"),
            F.count("*").alias("point_count"),
        )
        .withColumn("duration_secs", elapsed_seconds(F.col("start_time"), F.col("end_time")))
    )
    long_enough = (F.col("anomaly_type") != EXCESSIVE_IDLING) | (
        F.col("duration_secs") > settings.idle_alarm_sec
    )
    return events.filter(long_enough).select(
        "anomaly_type",
        "vehicle_id",
        "driver_id",
        "trip_id",
        "start_time",
        "end_time",
        "duration_secs",
        F.col("place.latitude").alias("latitude"),
        F.col("place.longitude").alias("longitude"),
        "peak",
        "threshold_value",
        "point_count",
    )


def overspeed_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("anomaly_type") == OVERSPEEDING).select(
        "vehicle_id",
        "driver_id",
        "trip_id",
        "start_time",
        "end_time",
        F.col("peak").alias("max_speed"),
        F.col("threshold_value").cast("int").alias("speed_limit"),
        "latitude",
        "longitude",
        "point_count",
    )


def idle_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("anomaly_type") == EXCESSIVE_IDLING).select(
        "vehicle_id",
        "driver_id",
        "trip_id",
        "start_time",
        "end_time",
        "latitude",
        "longitude",
        "point_count",
        "duration_secs",
    )


def jump_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("anomaly_type") == GPS_JUMP).select(
        "vehicle_id",
        "driver_id",
        "trip_id",
        "start_time",
        "end_time",
        F.col("peak").alias("implied_speed_kmph"),
        "latitude",
        "longitude",
        "point_count",
    )


def anomaly_facts(events: DataFrame, settings: Settings) -> DataFrame:
    """The event fact without its surrogate key."""
    kind = F.col("anomaly_type")
    seconds = F.col("duration_secs")
    severity = (
        F.when(
            kind == OVERSPEEDING,
            F.when(
                F.col("peak") > F.col("threshold_value") * settings.overspeed_high_ratio, "HIGH"
            ).otherwise("MEDIUM"),
        )
        .when(
            kind == EXCESSIVE_IDLING,
            F.when(seconds < settings.idle_medium_sec, "LOW")
            .when(seconds < settings.idle_high_sec, "MEDIUM")
            .otherwise("HIGH"),
        )
        .otherwise("HIGH")
    )
    metric = F.when(kind == EXCESSIVE_IDLING, seconds.cast("double")).otherwise(F.col("peak"))
    return events.select(
        "anomaly_type",
        "vehicle_id",
        "driver_id",
        "trip_id",
        "start_time",
        "end_time",
        "duration_secs",
        round_half_away(F.col("latitude"), 6).alias("latitude"),
        round_half_away(F.col("longitude"), 6).alias("longitude"),
        severity.alias("severity"),
        round_half_away(metric, 2).alias("metric_value"),
        "threshold_value",
        date_key(F.col("start_time")).alias("date_key"),
        time_key(F.col("start_time")).alias("time_key"),
    )


# Order of the surrogate key; the end time settles what the first three leave open.
KEY_ORDER = ["start_time", "vehicle_id", "anomaly_type", "end_time"]
