"""Points in order per vehicle, and the segments between neighbouring points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import operators
from roadpulse.functions import date_key, elapsed_seconds
from roadpulse.operators import Runs, Timeline, open_timeline
from roadpulse.session import Workspace
from roadpulse.settings import Settings

ORDER = ("event_timestamp", "event_id")

# Points of one vehicle that a task orders at once, where their times or ids tell them apart.
SLICE_ROWS = 1_000_000

# what the plans on ordered points read of a point
POINT = (
    "event_id",
    "vehicle_id",
    "driver_id",
    "trip_id",
    "event_timestamp",
    "latitude",
    "longitude",
    "speed_kmph",
    "ignition_status",
)

# new column -> column of the point before
LOOK_BACK = {
    "prev_lat": "latitude",
    "prev_lon": "longitude",
    "prev_ts": "event_timestamp",
    "prev_ign": "ignition_status",
    "prev_speed": "speed_kmph",
    "prev_trip": "trip_id",
}


def crowded_slices(telemetry: DataFrame, workspace: Workspace) -> list[DataFrame]:
    """Days of a vehicle, and its points without a time, that are too many for one task."""
    return operators.crowded_slices(telemetry, "vehicle_id", ORDER, SLICE_ROWS, workspace.cut)


def order_points(
    points: DataFrame, runs: Runs | None = None, crowded: Sequence[DataFrame] = ()
) -> Timeline:
    """Points in order per vehicle, with the runs of their flags; those without a time come
    last. They are ordered in slices of a day, or less where ``crowded`` says so."""
    timeline = open_timeline(points, "vehicle_id", ORDER, crowded)
    return timeline.in_order("seq", LOOK_BACK, runs)


def segment_seconds(settings: Settings) -> Column:
    """Time a segment accounts for: a long silence counts as the cap only."""
    return F.least(
        elapsed_seconds(F.col("prev_ts"), F.col("event_timestamp")),
        F.lit(settings.segment_cap_sec),
    )


def engine_was_on() -> Column:
    return F.col("prev_ign") == "ON"


def segment_km(settings: Settings) -> Column:
    """Mean of the two speeds times elapsed time, counted with the engine on."""
    mean_speed = (F.col("speed_kmph") + F.col("prev_speed")) / F.lit(2.0)
    hours = segment_seconds(settings) / F.lit(3600.0)
    return F.when(engine_was_on(), mean_speed * hours).otherwise(F.lit(0.0))


def segments(ordered: DataFrame, settings: Settings) -> DataFrame:
    """One row per pair of neighbouring points; its day is that of the earlier."""
    return ordered.filter(F.col("prev_ts").isNotNull()).select(
        "vehicle_id",
        "driver_id",
        "trip_id",
        "prev_trip",
        "event_timestamp",
        "prev_ts",
        "speed_kmph",
        "prev_speed",
        "ignition_status",
        "prev_ign",
        date_key(F.col("prev_ts")).alias("date_key"),
        elapsed_seconds(F.col("prev_ts"), F.col("event_timestamp")).alias("raw_dt_sec"),
        segment_seconds(settings).alias("dt_sec"),
        segment_km(settings).alias("effective_km"),
    )
