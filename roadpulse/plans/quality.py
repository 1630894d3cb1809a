"""Data quality: flags, exclusive rejection, repairs and the audit log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.operators import first_copies, mark_duplicates
from roadpulse.session import Workspace
from roadpulse.settings import UNKNOWN_DRIVER, Settings
from roadpulse.sources import RawTables
from roadpulse.sources.schemas import TELEMETRY

# A list of unknown ids goes to all tasks up to this size, measured.
SHORT_LIST_BYTES = 64 << 20

# Names of the flags, reasons and checks.
FLAGS = [
    "is_after_range",
    "is_duplicate",
    "is_bad_gps",
    "is_neg_speed",
    "is_orphan_vehicle",
    "is_orphan_driver",
    "is_orphan_trip",
    "is_null_trip",
    "is_bad_battery",
]

# Rejection reasons by priority: a row counts under the first that applies.
REJECTIONS = [
    ("out_of_range_date", "is_after_range"),
    ("duplicate_event_id", "is_duplicate"),
    ("invalid_gps", "is_bad_gps"),
    ("negative_speed", "is_neg_speed"),
    ("orphan_vehicle", "is_orphan_vehicle"),
]

# Counted on rows that survive every rejection.
SURVIVOR_CHECKS = [
    ("orphan_driver", "is_orphan_driver"),
    ("orphan_trip", "is_orphan_trip"),
    ("battery_out_of_range", "is_bad_battery"),
    ("null_trip_id", "is_null_trip"),
]

# Flags that the log counts on checked rows.
COUNTED_FLAGS = [f for _, f in SURVIVOR_CHECKS]


def row_flags(settings: Settings) -> dict[str, Column]:
    """Flags that need nothing but the row. A NULL reading is never ambiguous:
    missing coordinates are bad, other missing values raise no flag."""
    lat, lon = F.col("latitude"), F.col("longitude")
    south, north = settings.latitude_bounds
    west, east = settings.longitude_bounds
    located = (
        (lat != 0) & (lon != 0) & lat.between(south, north) & lon.between(west, east)
    )

    def when_known(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    # as text: a datetime literal would pass through the machine's time zone
    end = F.lit(settings.window_end.isoformat(sep=" ")).cast("timestamp_ntz")
    after = F.col("event_timestamp") >= end
    battery = F.col("battery_level")
    return {
        "is_after_range": when_known(after),
        "is_bad_gps": ~when_known(located),
        "is_neg_speed": when_known(F.col("speed_kmph") < 0),
        "is_null_trip": F.col("trip_id").isNull(),
        "is_bad_battery": when_known((battery < 0) | (battery > 100)),
    }


def _broadcastable(df: DataFrame) -> bool:
    """Whether Spark would broadcast ``df`` by its own estimate of the size."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def unknown_ids(
    telemetry: DataFrame, column: str, known: DataFrame, workspace: Workspace
) -> tuple[DataFrame, bool]:
    """Ids of the telemetry that ``known`` (one column) lacks, and whether the list is short.

    One pass over one column: ids are made distinct in the map tasks and an anti join of
    ids meets the master, so that no row of the telemetry is shuffled. The list is written,
    since its size is measured and the plan reads it again.
    """
    ids = telemetry.select(F.col(column).alias("_unknown")).dropna().distinct()
    master = known.toDF("_known")
    found = workspace.cut(
        ids.join(master, F.col("_unknown") == F.col("_known"), "left_anti"), f"unknown_{column}"
    )
    # text and the overhead of an entry in a hash table
    size = found.agg(F.sum(F.octet_length("_unknown") + 64)).first()[0] or 0
    return found, size <= SHORT_LIST_BYTES


def _with_master_flags(df: DataFrame, raw: RawTables, workspace: Workspace | None) -> DataFrame:
    """Look every id up in its master.

    Masters are reduced to distinct keys, so a repeated master key cannot multiply
    telemetry. A key list that Spark would broadcast is joined as it is. For a larger one
    the few ids that it lacks are found first, and that list goes to the rows instead:
    broadcast while its measured size is below ``SHORT_LIST_BYTES``. A longer list is joined
    by a shuffle, in which rows without an id are spread by their event and hot ids are split
    by Spark.
    """
    workspace = workspace or Workspace(df.sparkSession)
    found = df
    for column, flag, master in [
        ("trip_id", "is_orphan_trip", raw.trips),
        ("driver_id", "is_orphan_driver", raw.drivers),
        ("vehicle_id", "is_orphan_vehicle", raw.vehicles),
    ]:
        known = master.select(F.col(column).alias("_known")).distinct()
        if _broadcastable(known):
            found = found.join(known, F.col(column) == F.col("_known"), "left")
            orphan = F.col("_known").isNull()
        else:
            unknown, short = unknown_ids(raw.telemetry, column, known, workspace)
            key = F.col(column)
            if short:
                unknown = F.broadcast(unknown)
            else:
                spread = F.xxhash64("event_id", "event_timestamp").cast("string")
                key = F.coalesce(key, spread)
            found = found.join(unknown, key == F.col("_unknown"), "left")
            orphan = F.col(column).isNull() | F.col("_unknown").isNotNull()
        if flag == "is_orphan_trip":  # a row may be off trip
            orphan = F.col(column).isNotNull() & orphan
        found = found.withColumn(flag, orphan).drop("_known", "_unknown")
    return found


def flagged_telemetry(
    raw: RawTables, settings: Settings, workspace: Workspace | None = None
) -> DataFrame:
    """Every raw row with all nine flags, which may overlap."""
    ranked = mark_duplicates(raw.telemetry, "event_id", "event_timestamp")
    flagged = _with_master_flags(ranked.withColumns(row_flags(settings)), raw, workspace)
    return flagged.select(*raw.telemetry.columns, *FLAGS)


def checked_telemetry(
    raw: RawTables, settings: Settings, workspace: Workspace | None = None
) -> DataFrame:
    """The first copy of every event with its flags and ``reject_reason`` (NULL if
    the row is accepted).

    Later copies are dropped before anything else is looked at: all that the log
    needs about them is their number, which is counted on the raw ids and times.
    """
    firsts = first_copies(raw.telemetry, "event_id", "event_timestamp")
    flagged = _with_master_flags(firsts.withColumns(row_flags(settings)), raw, workspace)
    return with_reject_reason(flagged)


def with_reject_reason(flagged: DataFrame) -> DataFrame:
    """Exclusive reason by priority; works with or without the duplicate flag."""
    reasons = [F.when(F.col(f), F.lit(r)) for r, f in REJECTIONS if f in flagged.columns]
    return flagged.withColumn("reject_reason", F.coalesce(*reasons))


def clean_telemetry(checked: DataFrame, columns=TELEMETRY.names) -> DataFrame:
    """Accepted rows with repairs: unknown driver, trip set to NULL, battery
    clamped (a missing battery level becomes 0)."""
    repairs = {
        "driver_id": F.when(F.col("is_orphan_driver"), F.lit(UNKNOWN_DRIVER)).otherwise(
            F.col("driver_id")
        ),
        "trip_id": F.when(~F.col("is_orphan_trip"), F.col("trip_id")),
        "battery_level": F.least(F.greatest("battery_level", F.lit(0)), F.lit(100)),
    }
    return checked.filter(F.col("reject_reason").isNull()).select(
        *[repairs.get(c, F.col(c)).alias(c) for c in columns]
    )


def quality_totals(
    telemetry: DataFrame, checked: DataFrame, settings: Settings
) -> DataFrame:
    """One row holding the count of every check.

    Duplicates are counted on their own, from the ids and times of the raw rows
    (combined per id in the map tasks): the copies of an id that are in range, less
    the first one if it is. So rows that the checked telemetry loses show up as
    unaccounted.
    """
    after = row_flags(settings)["is_after_range"]
    moment = F.col("event_timestamp")
    per_id = telemetry.groupBy("event_id").agg(
        F.count("*").alias("n"),
        F.count_if(after).alias("n_after"),
        F.min(moment).alias("event_timestamp"),
    )
    # times in the sense of the flag: the first copy has the least known time
    first_in_range = (~after).cast("int")
    raw_side = per_id.agg(
        F.sum("n").alias("total_raw_rows"),
        F.sum("n_after").alias("out_of_range_date"),
        F.sum(F.col("n") - F.col("n_after") - first_in_range).alias("duplicate_event_id"),
    )
    reason = F.col("reject_reason")
    first_side = checked.agg(
        *[F.count_if(reason == r).alias(r) for r, _ in REJECTIONS[2:]],
        *[F.count_if(reason.isNull() & F.col(f)).alias(c) for c, f in SURVIVOR_CHECKS],
        F.count_if(reason.isNull()).alias("rows_accepted"),
    )
    both = raw_side.unionByName(first_side, allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in both.columns])


def reject_reasons(totals: DataFrame) -> DataFrame:
    """Rows per exclusive reason, accepted rows included."""
    pairs = [(r, r) for r, _ in REJECTIONS] + [("accepted", "rows_accepted")]
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(label).alias("reject_reason"), F.col(c).alias("row_count"))
                    for label, c in pairs
                ]
            )
        )
    )


def log_lines(settings: Settings) -> list[tuple[str, str, str, str]]:
    """Audit entries in order: table, check, action, detail."""
    day = f"{settings.window_end:%Y-%m-%d}"
    window = "reporting window"
    if settings.first_day is not None:
        window = f"{(settings.last_day - settings.first_day).days + 1}-day window"
    south, north = settings.latitude_bounds
    west, east = settings.longitude_bounds
    # Wording of the audit log.
    return [
        ("telemetry", "total_raw_rows", "read", "rows read from parquet"),
        (
            "telemetry", "out_of_range_date", "rejected",
            f"event_timestamp on the partial trailing day {day} (outside {window})",
        ),
        (
            "telemetry", "duplicate_event_id", "rejected",
            "same event_id seen more than once; earliest kept",
        ),
        (
            "telemetry", "invalid_gps", "rejected",
            "lat/lon null, zero, or outside India bounds "
            f"({south:g}-{north:g}N, {west:g}-{east:g}E)",
        ),
        ("telemetry", "negative_speed", "rejected", "speed_kmph < 0 (sensor error)"),
        (
            "telemetry", "orphan_vehicle", "rejected",
            "vehicle_id not present in vehicles master",
        ),
        (
            "telemetry", "orphan_driver", "repaired",
            "driver_id not in drivers master; remapped to UNKNOWN driver",
        ),
        (
            "telemetry", "orphan_trip", "repaired",
            "trip_id not in trips master; set to NULL (treated as off-trip)",
        ),
        (
            "telemetry", "battery_out_of_range", "repaired",
            "battery_level outside 0-100; clamped to nearest bound",
        ),
        (
            "telemetry", "null_trip_id", "kept",
            "trip_id NULL = vehicle not on active trip (valid state)",
        ),
        (
            "clean_telemetry", "rows_accepted", "loaded",
            "rows surviving cleaning and loaded to clean_telemetry",
        ),
    ]


def audit_log(totals: DataFrame, settings: Settings) -> DataFrame:
    """The eleven log entries; ``step_no`` keeps their order."""
    entries = [
        F.struct(
            F.lit(number).alias("step_no"),
            F.lit("clean").alias("run_step"),
            F.lit(table).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.col(check).alias("records_affected"),
            F.lit(action).alias("action"),
            F.lit(detail).alias("detail"),
        )
        for number, (table, check, action, detail) in enumerate(log_lines(settings), 1)
    ]
    return totals.select(F.inline(F.array(*entries)))


def reconciliation(log: DataFrame) -> DataFrame:
    """Rows read, rejected and accepted, and the difference, which must be 0."""
    amount = F.col("records_affected")
    return log.agg(
        F.sum(F.when(F.col("action") == "read", amount)).alias("rows_read"),
        F.sum(F.when(F.col("action") == "rejected", amount)).alias("rows_rejected"),
        F.sum(F.when(F.col("action") == "loaded", amount)).alias("rows_accepted"),
    ).withColumn(
        "unaccounted",
        reduce(lambda a, b: a - b, map(F.col, ["rows_read", "rows_rejected", "rows_accepted"])),
    )
