"""The warehouse as one object: raw tables in, star schema out."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from roadpulse.operators import (
    Timeline,
    foreign_key_violations,
    number_rows,
    primary_key_violations,
)
from roadpulse.plans import anomalies, dimensions, facts, quality, segments
from roadpulse.session import Workspace
from roadpulse.settings import Settings
from roadpulse.sources import RawTables, load_raw

# Names of the delivered model's tables and keys.
# Tables of the delivered model, dimensions before the facts that refer to them.
MODEL_TABLES = [
    "dim_customer",
    "dim_vehicle",
    "dim_driver",
    "dim_date",
    "dim_time",
    "fact_daily_vehicle_summary",
    "fact_trip_summary",
    "fact_anomaly_events",
    "dq_log",
]

PRIMARY_KEYS = [
    ("dim_customer", ["customer_id"]),
    ("dim_vehicle", ["vehicle_id"]),
    ("dim_driver", ["driver_id"]),
    ("dim_date", ["date_key"]),
    ("dim_time", ["time_key"]),
    ("fact_trip_summary", ["trip_id"]),
    ("fact_anomaly_events", ["anomaly_key"]),
    ("fact_daily_vehicle_summary", ["date_key", "vehicle_id"]),
]

# child, parent, column
FOREIGN_KEYS = [
    ("dim_vehicle", "dim_customer", "customer_id"),
    ("fact_daily_vehicle_summary", "dim_vehicle", "vehicle_id"),
    ("fact_daily_vehicle_summary", "dim_date", "date_key"),
    ("fact_trip_summary", "dim_vehicle", "vehicle_id"),
    ("fact_trip_summary", "dim_driver", "driver_id"),
    ("fact_trip_summary", "dim_date", "date_key"),
    ("fact_trip_summary", "dim_time", "time_key"),
    ("fact_anomaly_events", "dim_vehicle", "vehicle_id"),
    ("fact_anomaly_events", "dim_driver", "driver_id"),
    ("fact_anomaly_events", "dim_date", "date_key"),
    ("fact_anomaly_events", "dim_time", "time_key"),
]


class Star(Mapping):
    """The model tables by name; a table is planned when it is asked for."""

    def __init__(self, fleet: Fleet, keyed: bool):
        self._fleet = fleet
        self._keyed = keyed

    def __getitem__(self, name: str) -> DataFrame:
        if name not in MODEL_TABLES:
            raise KeyError(name)
        if name == "fact_anomaly_events" and not self._keyed:
            return self._fleet.unkeyed_anomalies
        return getattr(self._fleet, name)

    def __iter__(self) -> Iterator[str]:
        return iter(MODEL_TABLES)

    def __len__(self) -> int:
        return len(MODEL_TABLES)


class Fleet:
    """Lazily composed tables of one warehouse.

    With ``staged=False`` every table is a pure plan over the raw inputs, good
    for asking one question. With ``staged=True`` the frames with several readers
    are written once to the shared folder, each with the columns its readers need:
    the checked telemetry, the ordered points, the rollup, the two summaries and
    the events. Call ``release()`` when the facts are written.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: RawTables,
        settings: Settings = Settings(),
        staged: bool = False,
    ):
        self.spark = spark
        self.raw = raw
        self.settings = settings
        self.staged = staged
        self.workspace = Workspace(spark)

    @classmethod
    def open(cls, spark: SparkSession, root: str, settings: Settings = Settings(), **options):
        return cls(spark, load_raw(spark, root), settings, **options)

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        return self.workspace.cut(df, name) if self.staged else df

    def release(self) -> None:
        """Delete the intermediate tables. Frames planned by this fleet end here;
        what it has written elsewhere stays."""
        self.workspace.clear()

    # telemetry

    @cached_property
    def flagged_telemetry(self) -> DataFrame:
        return quality.flagged_telemetry(self.raw, self.settings, self.workspace)

    @cached_property
    def checked_telemetry(self) -> DataFrame:
        return quality.checked_telemetry(self.raw, self.settings, self.workspace)

    @cached_property
    def _checks(self) -> DataFrame:
        """What the log counts and the ordered points are made of."""
        if not self.staged:
            return self.checked_telemetry
        columns = [*segments.POINT, *quality.COUNTED_FLAGS, "reject_reason"]
        return self._cut(self.checked_telemetry.select(*columns), "checked")

    @cached_property
    def clean_telemetry(self) -> DataFrame:
        return quality.clean_telemetry(self.checked_telemetry)

    @cached_property
    def quality_totals(self) -> DataFrame:
        return quality.quality_totals(self.raw.telemetry, self._checks, self.settings)

    @cached_property
    def _crowded(self) -> list[DataFrame]:
        return segments.crowded_slices(self.raw.telemetry, self.workspace)

    @cached_property
    def ordered(self) -> Timeline:
        """Points in order, with look-back columns, speed limit and the runs of all three
        detectors, from one sort and one join."""
        points = quality.clean_telemetry(self._checks, segments.POINT)
        limited = anomalies.with_speed_limit(points, self.dim_vehicle)
        runs = anomalies.runs_of(anomalies.detectors(self.settings), self.settings)
        timeline = segments.order_points(limited, runs, self._crowded)
        return timeline.with_frame(self._cut(timeline.frame, "ordered"))

    @cached_property
    def tel_ordered(self) -> DataFrame:
        columns = [*self.clean_telemetry.columns, "seq", *segments.LOOK_BACK]
        ordered = segments.order_points(self.clean_telemetry, crowded=self._crowded)
        return ordered.frame.select(*columns)

    @cached_property
    def tel_pairs(self) -> DataFrame:
        return segments.segments(self.tel_ordered, self.settings)

    # dimensions

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dimensions.dim_customer(self.raw.customers)

    @cached_property
    def dim_vehicle(self) -> DataFrame:
        return dimensions.dim_vehicle(self.raw.vehicles, self.raw.speed_limits)

    @cached_property
    def dim_driver(self) -> DataFrame:
        return dimensions.dim_driver(self.raw.drivers)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.spark, self.raw.telemetry, self.settings)

    @cached_property
    def dim_time(self) -> DataFrame:
        return dimensions.dim_time(self.spark)

    # events and facts

    def events(self, *chosen: anomalies.Detector) -> DataFrame:
        chosen = list(chosen) or anomalies.detectors(self.settings)
        return anomalies.collapse(self.ordered.frame, self.settings, chosen)

    @cached_property
    def anomaly_overspeed(self) -> DataFrame:
        return anomalies.overspeed_events(self.events(anomalies.overspeeding()))

    @cached_property
    def anomaly_idle(self) -> DataFrame:
        return anomalies.idle_events(self.events(anomalies.excessive_idling(self.settings)))

    @cached_property
    def anomaly_gpsjump(self) -> DataFrame:
        return anomalies.jump_events(self.events(anomalies.gps_jump(self.settings)))

    @cached_property
    def unkeyed_anomalies(self) -> DataFrame:
        """The event fact without its surrogate key, which only the delivered table
        needs."""
        return self._cut(anomalies.anomaly_facts(self.events(), self.settings), "events")

    @cached_property
    def fact_anomaly_events(self) -> DataFrame:
        events = self.unkeyed_anomalies
        if not self.staged:
            # numbering reads its input twice
            events = self.workspace.cut(events, "events")
        return number_rows(events, "anomaly_key", anomalies.KEY_ORDER, self.workspace)

    @cached_property
    def rollup(self) -> DataFrame:
        return self._cut(facts.activity_rollup(self.ordered, self.settings), "rollup")

    @cached_property
    def fact_daily_vehicle_summary(self) -> DataFrame:
        daily = facts.daily_vehicle_summary(self.rollup, self.unkeyed_anomalies)
        return self._cut(daily, "daily")

    @cached_property
    def fact_trip_summary(self) -> DataFrame:
        trips = facts.trip_summary(self.rollup, self.raw.trips, self.unkeyed_anomalies)
        return self._cut(trips, "trips")

    @cached_property
    def dq_log(self) -> DataFrame:
        return quality.audit_log(self.quality_totals, self.settings)

    # the model

    def star(self, keyed: bool = True) -> Star:
        """All model tables. Reports need no surrogate key: ``keyed=False`` leaves
        it out and saves the global sort."""
        return Star(self, keyed)

    def pk_violations(self) -> DataFrame:
        return primary_key_violations(self.star(), PRIMARY_KEYS)

    def fk_violations(self) -> DataFrame:
        return foreign_key_violations(self.star(), FOREIGN_KEYS)

    def reconciliation(self) -> DataFrame:
        return quality.reconciliation(self.dq_log)
