"""Report queries over the star schema, under an optional filter context.

``star`` maps table names to DataFrames, either planned on access by
``Fleet.star()`` or loaded from a written warehouse. Facts are counted per foreign key before they
meet a dimension, so joins see a few rows per key and hot keys cost nothing.
"""

from __future__ import annotations

import operator
from collections import ChainMap
from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions import round_half_away, settle
from roadpulse.settings import ANOMALY_TYPES, GPS_JUMP, OVERSPEEDING

Star = Mapping[str, DataFrame]

FACTS = ["fact_daily_vehicle_summary", "fact_trip_summary", "fact_anomaly_events"]
DAY_NAMES = [
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
]


def in_context(
    star: Star,
    *,
    customer_names: list[str] | None = None,
    vehicle_types: list[str] | None = None,
    driver_ids: list[str] | None = None,
    driver_names: list[str] | None = None,
    from_day: date | None = None,
    to_day: date | None = None,
    severities: list[str] | None = None,
    anomaly_types: list[str] | None = None,
) -> Star:
    """Apply slicers. Filters flow one way: customer -> vehicle -> facts, and
    driver and date -> facts. A dimension without a slicer joins nothing. Names
    may be shared by several drivers; ``driver_ids`` picks one person."""
    out = ChainMap({}, star)
    if customer_names is not None:
        out["dim_customer"] = star["dim_customer"].filter(
            F.col("customer_name").isin(customer_names)
        )
        out["dim_vehicle"] = out["dim_vehicle"].join(
            out["dim_customer"].select("customer_id"), "customer_id", "left_semi"
        )
    if vehicle_types is not None:
        out["dim_vehicle"] = out["dim_vehicle"].filter(F.col("vehicle_type").isin(vehicle_types))
    if driver_ids is not None:
        out["dim_driver"] = out["dim_driver"].filter(F.col("driver_id").isin(driver_ids))
    if driver_names is not None:
        out["dim_driver"] = out["dim_driver"].filter(F.col("driver_name").isin(driver_names))
    if from_day is not None:
        out["dim_date"] = out["dim_date"].filter(F.col("date") >= F.lit(from_day))
    if to_day is not None:
        out["dim_date"] = out["dim_date"].filter(F.col("date") <= F.lit(to_day))
    if severities is not None:
        out["fact_anomaly_events"] = out["fact_anomaly_events"].filter(
            F.col("severity").isin(severities)
        )
    if anomaly_types is not None:
        out["fact_anomaly_events"] = out["fact_anomaly_events"].filter(
            F.col("anomaly_type").isin(anomaly_types)
        )
    # the same days once more as key bounds, which reach the files of a by-day layout
    bounds = [
        limit(F.col("date_key"), int(f"{day:%Y%m%d}"))
        for day, limit in ((from_day, operator.ge), (to_day, operator.le))
        if day is not None
    ]
    for fact in FACTS if bounds else []:
        out[fact] = out[fact].filter(reduce(operator.and_, bounds))
    for dim, key in [
        ("dim_vehicle", "vehicle_id"), ("dim_driver", "driver_id"), ("dim_date", "date_key"),
    ]:
        if dim not in out.maps[0]:
            continue
        for fact in FACTS:
            if key in out[fact].columns:
                out[fact] = out[fact].join(out[dim].select(key), key, "left_semi")
    return out


def _round2(value: Column) -> Column:
    return round_half_away(settle(value), 2)


def _is_high_overspeed() -> Column:
    return (F.col("anomaly_type") == OVERSPEEDING) & (F.col("severity") == "HIGH")


def _one_row(parts: list[DataFrame]) -> DataFrame:
    """Put one-row results side by side without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def fleet_kpis(star: Star, **slicers) -> DataFrame:
    """Fleet-level measures in one row. Active Today looks at the last day of the
    whole calendar and so ignores the date slicer, as its definition demands."""
    context = in_context(star, **slicers)
    undated = in_context(
        star, **{k: v for k, v in slicers.items() if k not in ("from_day", "to_day")}
    )
    # one scan of the daily fact for both: its rows, marked by whether they are in the
    # chosen days and on the last one
    last_day = star["dim_date"].agg(F.max("date_key").alias("date_key"))
    daily = undated["fact_daily_vehicle_summary"].join(
        last_day.withColumn("_today", F.lit(True)), "date_key", "left"
    )
    if context["dim_date"] is star["dim_date"]:
        daily = daily.withColumn("_chosen", F.lit(True))
    else:
        days = context["dim_date"].select("date_key", F.lit(True).alias("_chosen"))
        daily = daily.join(days, "date_key", "left")

    def where(mark: str, column: str) -> Column:
        return F.when(F.col(mark), F.col(column))

    drove = F.col("total_distance_km") > 0
    measures = _one_row(
        [
            context["dim_vehicle"].agg(F.count_distinct("vehicle_id").alias("total_vehicles")),
            daily.agg(
                _round2(F.sum(where("_chosen", "total_distance_km"))).alias("total_distance_km"),
                F.count_distinct(F.when(drove, where("_chosen", "vehicle_id"))).alias(
                    "active_vehicles"
                ),
                _round2(F.sum(where("_chosen", "running_hours"))).alias("running_hours"),
                _round2(F.sum(where("_chosen", "idle_hours"))).alias("idle_hours"),
                F.count_distinct(F.when(drove, where("_today", "vehicle_id"))).alias(
                    "active_today"
                ),
            ),
            context["fact_trip_summary"].agg(
                F.count_distinct("trip_id").alias("total_trips"),
                _round2(F.sum("actual_distance_km")).alias("driver_distance_km"),
            ),
            context["fact_anomaly_events"].agg(
                F.count("*").alias("total_anomalies"),
                F.count_if(F.col("anomaly_type") != GPS_JUMP).alias("driver_anomalies"),
                F.count_if(_is_high_overspeed()).alias("_high"),
            ),
        ]
    )
    score = safety_score(F.col("_high"), F.col("driver_distance_km"))
    return measures.withColumn("safety_score", score).drop("_high")


def distance_by_vehicle_type(star: Star) -> DataFrame:
    per_vehicle = (
        star["fact_daily_vehicle_summary"]
        .groupBy("vehicle_id")
        .agg(F.sum("total_distance_km").alias("km"))
    )
    return (
        per_vehicle.join(star["dim_vehicle"].select("vehicle_id", "vehicle_type"), "vehicle_id")
        .groupBy("vehicle_type")
        .agg(_round2(F.sum("km")).alias("total_distance_km"))
    )


def daily_active_vs_anomalies(star: Star) -> DataFrame:
    drove = F.when(F.col("total_distance_km") > 0, F.col("vehicle_id"))
    active = (
        star["fact_daily_vehicle_summary"]
        .groupBy("date_key")
        .agg(F.count_distinct(drove).alias("active_vehicles"))
    )
    events = (
        star["fact_anomaly_events"]
        .groupBy("date_key")
        .agg(F.count("*").alias("total_anomalies"))
    )
    return (
        star["dim_date"]
        .join(active, "date_key", "left")
        .join(events, "date_key", "left")
        .select(
            "date_key",
            "date",
            F.coalesce("active_vehicles", F.lit(0)).alias("active_vehicles"),
            F.coalesce("total_anomalies", F.lit(0)).alias("total_anomalies"),
        )
    )


def anomalies_by_type(star: Star) -> DataFrame:
    """Count and share per type. The window sees one row per type."""
    counts = (
        star["fact_anomaly_events"]
        .groupBy("anomaly_type")
        .agg(F.count("*").alias("total_anomalies"))
    )
    whole = F.sum("total_anomalies").over(Window.partitionBy())
    return counts.select(
        "anomaly_type",
        "total_anomalies",
        round_half_away(F.col("total_anomalies") / whole, 4).alias("share"),
    )


def customer_anomaly_matrix(star: Star) -> DataFrame:
    counts = (
        star["fact_anomaly_events"]
        .groupBy("vehicle_id", "anomaly_type")
        .agg(F.count("*").alias("n"))
    )
    cells = (
        counts.join(star["dim_vehicle"].select("vehicle_id", "customer_id"), "vehicle_id")
        .join(star["dim_customer"].select("customer_id", "customer_name"), "customer_id")
        .groupBy("customer_name")
        .pivot("anomaly_type", ANOMALY_TYPES)
        .agg(F.sum("n"))
    )
    return cells.select(
        "customer_name",
        *[F.coalesce(t, F.lit(0)).alias(t.lower()) for t in ANOMALY_TYPES],
    )


def top_vehicles(star: Star, n: int = 10) -> DataFrame:
    """The ``n`` vehicle numbers with most anomalies; ties by number."""
    counts = (
        star["fact_anomaly_events"].groupBy("vehicle_id").agg(F.count("*").alias("events"))
    )
    return (
        counts.join(star["dim_vehicle"].select("vehicle_id", "vehicle_number"), "vehicle_id")
        .groupBy("vehicle_number")
        .agg(F.sum("events").alias("total_anomalies"))
        .orderBy(F.desc("total_anomalies"), "vehicle_number")
        .limit(n)
    )


def anomalies_by_minute(star: Star) -> DataFrame:
    """Every member of the time dimension with its number of anomalies."""
    counts = (
        star["fact_anomaly_events"]
        .groupBy("time_key")
        .agg(F.count("*").alias("total_anomalies"))
    )
    dim = star["dim_time"]
    return dim.join(counts, "time_key", "left").select(
        *dim.columns, F.coalesce("total_anomalies", F.lit(0)).alias("total_anomalies")
    )


def heatmap_hour_weekday(star: Star) -> DataFrame:
    """Anomalies per hour (rows) and weekday (columns, Monday to Sunday)."""
    counts = (
        star["fact_anomaly_events"]
        .groupBy("time_key", "date_key")
        .agg(F.count("*").alias("n"))
    )
    cells = (
        counts.join(star["dim_time"].select("time_key", "hour"), "time_key")
        .join(star["dim_date"].select("date_key", "day_name"), "date_key")
        .groupBy("hour")
        .pivot("day_name", DAY_NAMES)
        .agg(F.sum("n"))
    )
    return cells.select("hour", *[F.coalesce(d, F.lit(0)).alias(d.lower()) for d in DAY_NAMES])


def safety_score(high_overspeeds: Column, km: Column) -> Column:
    """100 less 3 points per HIGH overspeed per 100 km, not below 0; NULL without
    distance."""
    penalty = F.coalesce(F.try_divide(high_overspeeds, km), F.lit(0.0)) * 100 * 3
    score = F.lit(100.0) - F.least(F.lit(100.0), penalty)
    return F.when(F.coalesce(km, F.lit(0.0)) != 0, round_half_away(settle(score), 0))


def driver_scorecard(star: Star) -> DataFrame:
    """Per driver: trips, distance, anomalies, safety score and its band. Keyed by
    driver_id, since names repeat; distance comes from the trip fact, the only
    one that knows the driver."""
    driven = star["fact_trip_summary"].groupBy("driver_id").agg(
        F.count_distinct("trip_id").alias("trips"),
        _round2(F.sum("actual_distance_km")).alias("km"),
    )
    events = star["fact_anomaly_events"].groupBy("driver_id").agg(
        F.count("*").alias("anomalies"),
        F.count_if(F.col("anomaly_type") != GPS_JUMP).alias("own"),
        F.count_if(_is_high_overspeed()).alias("high"),
    )
    scored = (
        star["dim_driver"]
        .select("driver_id", "driver_name")
        .join(driven, "driver_id", "left")
        .join(events, "driver_id", "left")
        .withColumn("safety_score", safety_score(F.col("high"), F.col("km")))
    )
    score, zero = F.col("safety_score"), F.lit(0)
    return scored.select(
        "driver_id",
        "driver_name",
        F.coalesce("trips", zero).alias("total_trips"),
        F.coalesce("km", F.lit(0.0)).alias("driver_distance_km"),
        F.coalesce("anomalies", zero).alias("total_anomalies"),
        F.coalesce("own", zero).alias("driver_anomalies"),
        "safety_score",
        F.when(score >= 80, "green")
        .when(score >= 60, "amber")
        .when(score.isNotNull(), "red")
        .alias("score_band"),
    )


def driver_daily_trend(star: Star) -> DataFrame:
    """Distance and anomalies per driver and day, for days that have either."""
    keys = ["driver_id", "date_key"]
    trips = star["fact_trip_summary"].select(
        *keys, F.col("actual_distance_km").alias("km"), F.lit(0).alias("n")
    )
    events = star["fact_anomaly_events"].select(
        *keys, F.lit(None).cast("double").alias("km"), F.lit(1).alias("n")
    )
    return (
        trips.unionByName(events)
        .groupBy(*keys)
        .agg(
            _round2(F.coalesce(F.sum("km"), F.lit(0.0))).alias("driver_distance_km"),
            F.sum("n").alias("total_anomalies"),
        )
    )


def recent_anomalies(star: Star, n: int = 20) -> DataFrame:
    """The latest ``n`` events per driver. Filtering on the rank lets every map
    task keep ``n`` rows per driver before the shuffle."""
    latest = Window.partitionBy("driver_id").orderBy(
        F.col("start_time").desc_nulls_last(), "vehicle_id", "anomaly_type", "end_time"
    )
    return (
        star["fact_anomaly_events"]
        .withColumn("recency", F.row_number().over(latest))
        .filter(F.col("recency") <= n)
        .select(
            "driver_id",
            F.col("recency").cast("bigint").alias("recency"),
            "start_time",
            "anomaly_type",
            "severity",
            "metric_value",
            "duration_secs",
        )
    )


def anomaly_breakdown(star: Star) -> DataFrame:
    return (
        star["fact_anomaly_events"]
        .groupBy("anomaly_type", "severity")
        .agg(F.count("*").alias("n"))
        .orderBy("anomaly_type", "severity")
    )


def quality_report(star: Star) -> DataFrame:
    return star["dq_log"].orderBy("step_no").select(
        "step_no", "check_name", "records_affected", "action", "detail"
    )


def table_row_counts(star: Star) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in star.items()
        ],
    )
