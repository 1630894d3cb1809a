"""DuckDB SQL that states each registered query independently of the Spark plans.

Every statement is a chain of named subqueries over the driver's tables; ``ask``
puts together those that a final SELECT needs. Numbers whose last digit depends
on summation order are rounded twice (9 digits, then as published), as the Spark
side does.
"""

from __future__ import annotations

import re

from roadpulse.settings import SPEED_LIMITS
from roadpulse.sources import testbed

WINDOW_END = "TIMESTAMP '2024-01-30 00:00:00'"
LAST_DAY = "DATE '2024-01-29'"
RUN_GAP = testbed.TESTBED_SETTINGS.run_gap_sec
EARTH_RADIUS_KM = testbed.TESTBED_SETTINGS.earth_radius_km


def _tables(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text)


def _day(moment: str) -> str:
    return f"CAST(strftime({moment}, '%Y%m%d') AS INTEGER)"


def _minute(moment: str) -> str:
    return f"CAST(hour({moment}) * 60 + minute({moment}) AS BIGINT)"


def _r(value: str, digits: int = 2) -> str:
    return f"ROUND(ROUND({value}, 9), {digits})"


def _missing(master: str, column: str) -> str:
    return (
        f"NOT EXISTS (SELECT 1 FROM {master} m WHERE m.{column} = numbered.{column})"
    )


# Subqueries in dependency order. The wording of the audit log.
PARTS: dict[str, str] = {
    "telemetry": _tables(testbed.TELEMETRY_SQL),
    "vehicles": _tables(testbed.VEHICLES_SQL),
    "drivers": _tables(testbed.DRIVERS_SQL),
    "customers": _tables(testbed.CUSTOMERS_SQL),
    "trips": _tables(testbed.TRIPS_SQL),
    "limits": "SELECT * FROM (VALUES {}) v(vehicle_type, speed_limit)".format(
        ", ".join(f"('{t}', {k})" for t, k in SPEED_LIMITS)
    ),
    # quality
    "numbered": """
        SELECT *, row_number() OVER (
                 PARTITION BY event_id
                 ORDER BY event_timestamp NULLS LAST, vehicle_id NULLS LAST,
                          driver_id NULLS LAST, trip_id NULLS LAST, latitude NULLS LAST,
                          longitude NULLS LAST, speed_kmph NULLS LAST, heading NULLS LAST,
                          gps_accuracy NULLS LAST, ignition_status NULLS LAST,
                          battery_level NULLS LAST) AS copy_no
        FROM telemetry""",
    "flagged": f"""
        SELECT numbered.* EXCLUDE (copy_no),
               ifnull(event_timestamp >= {WINDOW_END}, false) AS is_after_range,
               copy_no > 1 AS is_duplicate,
               NOT ifnull(latitude <> 0 AND longitude <> 0
                          AND latitude BETWEEN 6 AND 36
                          AND longitude BETWEEN 68 AND 97, false) AS is_bad_gps,
               ifnull(speed_kmph < 0, false) AS is_neg_speed,
               {_missing('vehicles', 'vehicle_id')} AS is_orphan_vehicle,
               {_missing('drivers', 'driver_id')} AS is_orphan_driver,
               trip_id IS NOT NULL AND {_missing('trips', 'trip_id')} AS is_orphan_trip,
               trip_id IS NULL AS is_null_trip,
               ifnull(battery_level NOT BETWEEN 0 AND 100, false) AS is_bad_battery
        FROM numbered""",
    "judged": """
        SELECT *, CASE WHEN is_after_range THEN 'out_of_range_date'
                       WHEN is_duplicate THEN 'duplicate_event_id'
                       WHEN is_bad_gps THEN 'invalid_gps'
                       WHEN is_neg_speed THEN 'negative_speed'
                       WHEN is_orphan_vehicle THEN 'orphan_vehicle' END AS verdict
        FROM flagged""",
    "clean": """
        SELECT event_id, vehicle_id, if(is_orphan_driver, 'UNKNOWN', driver_id) AS driver_id,
               if(is_orphan_trip, NULL, trip_id) AS trip_id, event_timestamp, latitude,
               longitude, speed_kmph, heading, gps_accuracy, ignition_status,
               CAST(least(greatest(battery_level, 0), 100) AS INTEGER) AS battery_level
        FROM judged WHERE verdict IS NULL""",
    "dq_log": """
        SELECT CAST(step_no AS INTEGER) AS step_no, 'clean' AS run_step, table_name,
               check_name, CAST(records AS BIGINT) AS records_affected, action, detail
        FROM (
          SELECT 1 AS step_no, 'telemetry' AS table_name, 'total_raw_rows' AS check_name,
                 count(*) AS records, 'read' AS action, 'rows read from parquet' AS detail
          FROM judged
          UNION ALL
          SELECT w.step_no, 'telemetry', w.label,
                 (SELECT count(*) FROM judged WHERE verdict = w.label), 'rejected', w.detail
          FROM (VALUES
            (2, 'out_of_range_date', 'event_timestamp on the partial trailing day 2024-01-30 (outside reporting window)'),
            (3, 'duplicate_event_id', 'same event_id seen more than once; earliest kept'),
            (4, 'invalid_gps', 'lat/lon null, zero, or outside India bounds (6-36N, 68-97E)'),
            (5, 'negative_speed', 'speed_kmph < 0 (sensor error)'),
            (6, 'orphan_vehicle', 'vehicle_id not present in vehicles master')
          ) w(step_no, label, detail)
          UNION ALL
          SELECT 7, 'telemetry', 'orphan_driver',
                 (SELECT count(*) FROM judged WHERE verdict IS NULL AND is_orphan_driver),
                 'repaired', 'driver_id not in drivers master; remapped to UNKNOWN driver'
          UNION ALL
          SELECT 8, 'telemetry', 'orphan_trip',
                 (SELECT count(*) FROM judged WHERE verdict IS NULL AND is_orphan_trip),
                 'repaired', 'trip_id not in trips master; set to NULL (treated as off-trip)'
          UNION ALL
          SELECT 9, 'telemetry', 'battery_out_of_range',
                 (SELECT count(*) FROM judged WHERE verdict IS NULL AND is_bad_battery),
                 'repaired', 'battery_level outside 0-100; clamped to nearest bound'
          UNION ALL
          SELECT 10, 'telemetry', 'null_trip_id',
                 (SELECT count(*) FROM judged WHERE verdict IS NULL AND is_null_trip),
                 'kept', 'trip_id NULL = vehicle not on active trip (valid state)'
          UNION ALL
          SELECT 11, 'clean_telemetry', 'rows_accepted', (SELECT count(*) FROM clean),
                 'loaded', 'rows surviving cleaning and loaded to clean_telemetry'
        ) entries""",
    # dimensions
    "dim_customer": "SELECT customer_id, customer_name, city, industry FROM customers",
    "dim_vehicle": """
        SELECT vehicle_id, vehicle_number, vehicle_type, customer_id,
               (SELECT CAST(speed_limit AS INTEGER) FROM limits l
                WHERE l.vehicle_type = v.vehicle_type) AS speed_limit_kmph,
               registration_date
        FROM vehicles v""",
    "dim_driver": """
        SELECT driver_id, driver_name, phone, license_number,
               vehicle_id AS assigned_vehicle_id, joining_date FROM drivers
        UNION ALL
        SELECT 'UNKNOWN', 'Unknown Driver', NULL, NULL, NULL, NULL""",
    "dim_date": f"""
        SELECT {_day('d')} AS date_key, CAST(d AS DATE) AS date,
               CAST(day(d) AS BIGINT) AS day, CAST(month(d) AS BIGINT) AS month,
               strftime(d, '%B') AS month_name, CAST(year(d) AS BIGINT) AS year,
               CAST(isodow(d) % 7 AS BIGINT) AS day_of_week,
               CAST(isodow(d) AS BIGINT) AS day_sort, strftime(d, '%A') AS day_name,
               CAST(weekofyear(d) AS BIGINT) AS week_of_year, isodow(d) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(
                (SELECT CAST(min(event_timestamp) AS DATE) FROM telemetry),
                {LAST_DAY}, INTERVAL 1 DAY)) AS d) spine""",
    "dim_time": """
        SELECT CAST(m AS BIGINT) AS time_key, CAST(m // 60 AS BIGINT) AS hour,
               CAST(m % 60 AS BIGINT) AS minute,
               lpad(CAST(m // 60 AS VARCHAR), 2, '0') || ':'
                 || lpad(CAST(m % 60 AS VARCHAR), 2, '0') AS hh_mm,
               CASE WHEN m BETWEEN 360 AND 719 THEN 'Morning'
                    WHEN m BETWEEN 720 AND 1019 THEN 'Afternoon'
                    WHEN m BETWEEN 1020 AND 1259 THEN 'Evening'
                    ELSE 'Night' END AS part_of_day
        FROM (SELECT unnest(range(1440)) AS m) minutes""",
    # ordered points
    "points": """
        SELECT clean.*, row_number() OVER course AS seq,
               lag(latitude) OVER course AS prev_lat, lag(longitude) OVER course AS prev_lon,
               lag(event_timestamp) OVER course AS prev_ts,
               lag(ignition_status) OVER course AS prev_ign,
               lag(speed_kmph) OVER course AS prev_speed, lag(trip_id) OVER course AS prev_trip
        FROM clean
        WINDOW course AS (PARTITION BY vehicle_id
                          ORDER BY event_timestamp NULLS LAST, event_id NULLS LAST)""",
    "legs": f"""
        SELECT *, {_day('prev_ts')} AS leg_day, least(300, raw_sec) AS sec,
               if(prev_ign = 'ON',
                  (speed_kmph + prev_speed) / 2 * (least(300, raw_sec) / 3600), 0.0) AS km
        FROM (SELECT *, date_diff('second', prev_ts, event_timestamp) AS raw_sec
              FROM points WHERE prev_ts IS NOT NULL) t""",
    # anomalies
    "suspects": f"""
        SELECT 'OVERSPEEDING' AS kind, p.vehicle_id, driver_id, trip_id, seq, event_timestamp,
               event_timestamp AS since, latitude, longitude, speed_kmph AS peak,
               CAST(speed_limit_kmph AS DOUBLE) AS threshold
        FROM points p JOIN dim_vehicle d ON d.vehicle_id = p.vehicle_id
                                        AND p.speed_kmph > d.speed_limit_kmph
        UNION ALL
        SELECT 'EXCESSIVE_IDLING', vehicle_id, driver_id, trip_id, seq, event_timestamp,
               event_timestamp, latitude, longitude, 0, 900
        FROM points WHERE speed_kmph = 0 AND ignition_status = 'ON'
        UNION ALL
        SELECT 'GPS_JUMP', vehicle_id, driver_id, trip_id, seq, event_timestamp, prev_ts,
               latitude, longitude, arc / (sec / 3600), 200
        FROM (SELECT *, date_diff('second', prev_ts, event_timestamp) AS sec,
                     2 * {EARTH_RADIUS_KM} * asin(sqrt(
                       pow(sin(radians(latitude - prev_lat) / 2), 2)
                       + cos(radians(latitude)) * cos(radians(prev_lat))
                         * pow(sin(radians(longitude - prev_lon) / 2), 2))) AS arc
              FROM points WHERE prev_ts IS NOT NULL) hops
        WHERE sec > 0 AND arc / (sec / 3600) > 200""",
    "grouped": f"""
        SELECT *, sum(opens) OVER (PARTITION BY kind, vehicle_id ORDER BY seq) AS run_no
        FROM (SELECT *, CASE WHEN lag(seq) OVER along = seq - 1
                              AND NOT ifnull(date_diff('second', lag(event_timestamp) OVER along,
                                                       event_timestamp) > {RUN_GAP}, false)
                             THEN 0 ELSE 1 END AS opens
              FROM suspects
              WINDOW along AS (PARTITION BY kind, vehicle_id ORDER BY seq)) s""",
    "runs": """
        SELECT *, date_diff('second', start_time, end_time) AS duration_secs
        FROM (SELECT kind, vehicle_id, arg_min(driver_id, event_timestamp) AS driver_id,
                     arg_min(trip_id, event_timestamp) AS trip_id,
                     min(since) AS start_time, max(event_timestamp) AS end_time,
                     max(peak) AS peak, max(threshold) AS threshold,
                     arg_max(latitude, ROW(peak, -seq)) AS latitude,
                     arg_max(longitude, ROW(peak, -seq)) AS longitude,
                     count(*) AS point_count
              FROM grouped GROUP BY kind, vehicle_id, run_no) g
        WHERE kind <> 'EXCESSIVE_IDLING' OR date_diff('second', start_time, end_time) > 900""",
    "fact_anomaly_events": f"""
        SELECT row_number() OVER (ORDER BY start_time NULLS LAST, vehicle_id, kind, end_time)
                 AS anomaly_key,
               kind AS anomaly_type, vehicle_id, driver_id, trip_id, start_time, end_time,
               duration_secs, ROUND(latitude, 6) AS latitude, ROUND(longitude, 6) AS longitude,
               CASE WHEN kind = 'GPS_JUMP' THEN 'HIGH'
                    WHEN kind = 'OVERSPEEDING' THEN if(peak > threshold * 1.2, 'HIGH', 'MEDIUM')
                    WHEN duration_secs >= 3600 THEN 'HIGH'
                    WHEN duration_secs >= 1800 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
               ROUND(if(kind = 'EXCESSIVE_IDLING', CAST(duration_secs AS DOUBLE), peak), 2)
                 AS metric_value,
               threshold AS threshold_value, {_day('start_time')} AS date_key,
               {_minute('start_time')} AS time_key
        FROM runs""",
    # facts
    "fact_daily_vehicle_summary": f"""
        SELECT pts.date_key, pts.vehicle_id,
               {_r('ifnull(leg.km, 0)')} AS total_distance_km,
               {_r('ifnull(leg.running / 3600, 0)')} AS running_hours,
               {_r('ifnull(leg.idle / 3600, 0)')} AS idle_hours,
               {_r('pts.mean_speed')} AS avg_speed, pts.max_speed, pts.trip_count,
               ifnull(ev.n, 0) AS anomaly_count
        FROM (SELECT {_day('event_timestamp')} AS date_key, vehicle_id,
                     avg(speed_kmph) FILTER (WHERE speed_kmph > 0) AS mean_speed,
                     max(speed_kmph) AS max_speed, count(DISTINCT trip_id) AS trip_count
              FROM clean GROUP BY ALL) pts
        LEFT JOIN (SELECT leg_day, vehicle_id, sum(km) AS km,
                          sum(sec) FILTER (WHERE prev_ign = 'ON') AS running,
                          sum(sec) FILTER (WHERE prev_ign = 'ON' AND prev_speed = 0) AS idle
                   FROM legs GROUP BY ALL) leg
               ON leg.leg_day = pts.date_key AND leg.vehicle_id = pts.vehicle_id
        LEFT JOIN (SELECT date_key, vehicle_id, count(*) AS n
                   FROM fact_anomaly_events GROUP BY ALL) ev
               ON ev.date_key = pts.date_key AND ev.vehicle_id = pts.vehicle_id""",
    "fact_trip_summary": f"""
        SELECT pts.trip_id, pts.vehicle_id, pts.driver_id, t.origin_city, t.destination_city,
               t.status, t.planned_start, t.planned_end, pts.actual_start, pts.actual_end,
               {_r("date_diff('second', actual_start, actual_end) / 60")}
                 AS actual_duration_mins,
               {_r('ifnull(leg.km, 0)')} AS actual_distance_km,
               {_r('pts.mean_speed')} AS avg_speed, pts.max_speed,
               {_r('ifnull(leg.idle / 60, 0)')} AS idle_time_mins,
               {_r('ifnull(leg.running / 3600, 0)')} AS running_hours,
               CAST(ifnull(leg.halts, 0) AS BIGINT) AS stoppage_count,
               ifnull(ev.n, 0) AS anomaly_count,
               {_day('actual_start')} AS date_key, {_minute('actual_start')} AS time_key
        FROM (SELECT trip_id, arg_min(vehicle_id, event_timestamp) AS vehicle_id,
                     arg_min(driver_id, event_timestamp) AS driver_id,
                     min(event_timestamp) AS actual_start, max(event_timestamp) AS actual_end,
                     avg(speed_kmph) FILTER (WHERE speed_kmph > 0) AS mean_speed,
                     max(speed_kmph) AS max_speed
              FROM clean WHERE trip_id IS NOT NULL GROUP BY trip_id) pts
        JOIN trips t ON t.trip_id = pts.trip_id
        LEFT JOIN (SELECT trip_id, sum(km) AS km,
                          sum(sec) FILTER (WHERE prev_ign = 'ON') AS running,
                          sum(sec) FILTER (WHERE prev_ign = 'ON' AND prev_speed = 0) AS idle,
                          count(*) FILTER (WHERE prev_speed > 0 AND speed_kmph = 0) AS halts
                   FROM legs WHERE prev_trip = trip_id GROUP BY trip_id) leg
               ON leg.trip_id = pts.trip_id
        LEFT JOIN (SELECT trip_id, count(*) AS n FROM fact_anomaly_events
                   WHERE trip_id IS NOT NULL GROUP BY trip_id) ev
               ON ev.trip_id = pts.trip_id""",
}


def ask(final: str) -> str:
    """The statement for ``final`` with every subquery it needs, directly or not."""
    needed: set[str] = set()
    todo = [final]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & PARTS.keys() - needed:
            needed.add(name)
            todo.append(PARTS[name])
    chain = ",\n".join(f"{n} AS ({PARTS[n].strip()})" for n in PARTS if n in needed)
    return f"WITH {chain}\n{final.strip()}"


def _count(table: str) -> str:
    return f"SELECT '{table}' AS table_name, count(*) AS row_count FROM {table}"


def _unique(table: str, columns: list[str]) -> str:
    keys = ", ".join(columns)
    null = " OR ".join(f"{c} IS NULL" for c in columns)
    return f"""
        SELECT '{table}' AS table_name, '{keys}' AS key_columns,
               (SELECT count(*) FROM (SELECT 1 FROM {table} WHERE NOT ({null})
                                      GROUP BY {keys} HAVING count(*) > 1) d)
                 AS duplicate_keys,
               (SELECT count(*) FROM {table} WHERE {null}) AS null_keys"""


def _refers(child: str, parent: str, column: str) -> str:
    return f"""
        SELECT '{child}' AS child_table, '{parent}' AS parent_table, '{column}' AS key_column,
               (SELECT count(*) FROM {child} c WHERE c.{column} IS NOT NULL AND NOT EXISTS
                  (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})) AS orphan_rows"""


def _kpis(vehicle: str = "true", dated: str = "true", driver: str = "true") -> str:
    """Fleet measures; the arguments are slicer conditions."""
    chosen = f"""vehicle_id IN (SELECT vehicle_id FROM dim_vehicle v
                 JOIN dim_customer c ON c.customer_id = v.customer_id WHERE {vehicle})"""
    days = f"date_key IN (SELECT date_key FROM dim_date WHERE {dated})"
    drivers = f"driver_id IN (SELECT driver_id FROM dim_driver WHERE {driver})"
    return f"""
        SELECT * EXCLUDE (high), if(driver_distance_km > 0,
               {_r('100 - least(100.0, high / driver_distance_km * 300)', 0)}, NULL)
                 AS safety_score FROM (
        SELECT (SELECT count(DISTINCT vehicle_id) FROM dim_vehicle WHERE {chosen})
                 AS total_vehicles,
               d.*, t.*, a.*,
               (SELECT count(DISTINCT vehicle_id) FROM fact_daily_vehicle_summary
                WHERE total_distance_km > 0 AND {chosen}
                  AND date_key = (SELECT max(date_key) FROM dim_date)) AS active_today
        FROM (SELECT {_r('sum(total_distance_km)')} AS total_distance_km,
                     count(DISTINCT vehicle_id) FILTER (WHERE total_distance_km > 0)
                       AS active_vehicles,
                     {_r('sum(running_hours)')} AS running_hours,
                     {_r('sum(idle_hours)')} AS idle_hours
              FROM fact_daily_vehicle_summary WHERE {chosen} AND {days}) d,
             (SELECT count(DISTINCT trip_id) AS total_trips,
                     {_r('sum(actual_distance_km)')} AS driver_distance_km
              FROM fact_trip_summary WHERE {chosen} AND {days} AND {drivers}) t,
             (SELECT count(*) AS total_anomalies,
                     count(*) FILTER (WHERE anomaly_type <> 'GPS_JUMP') AS driver_anomalies,
                     count(*) FILTER (WHERE anomaly_type = 'OVERSPEEDING'
                                        AND severity = 'HIGH') AS high
              FROM fact_anomaly_events WHERE {chosen} AND {days} AND {drivers}) a) m"""


def _pivoted(column: str, values: list[str]) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE {column} = '{v}') AS {v.lower()}" for v in values
    )


def statements() -> dict[str, str]:
    from roadpulse.model import FOREIGN_KEYS, MODEL_TABLES, PRIMARY_KEYS
    from roadpulse.plans.reports import DAY_NAMES
    from roadpulse.settings import ANOMALY_TYPES

    flags = (
        "is_after_range, is_duplicate, is_bad_gps, is_neg_speed, is_orphan_vehicle, "
        "is_orphan_driver, is_orphan_trip, is_null_trip, is_bad_battery"
    )
    run_columns = (
        "vehicle_id, driver_id, trip_id, start_time, end_time, latitude, longitude, point_count"
    )
    finals = {
        "dq_flags": f"SELECT event_id, event_timestamp, {flags} FROM flagged",
        "dq_reject_reason": """
            SELECT w.reason AS reject_reason,
                   (SELECT count(*) FROM judged
                    WHERE ifnull(verdict, 'accepted') = w.reason) AS row_count
            FROM (VALUES ('out_of_range_date'), ('duplicate_event_id'), ('invalid_gps'),
                         ('negative_speed'), ('orphan_vehicle'), ('accepted')) w(reason)""",
        "dq_log": "SELECT * FROM dq_log",
        "dq_report": """
            SELECT step_no, check_name, records_affected, action, detail
            FROM dq_log ORDER BY step_no""",
        "dq_reconciliation": """
            SELECT r AS rows_read, x AS rows_rejected, a AS rows_accepted,
                   r - x - a AS unaccounted
            FROM (SELECT count(*) AS r, count(verdict) AS x FROM judged) j,
                 (SELECT count(*) AS a FROM clean) c""",
        "clean_telemetry": "SELECT * FROM clean",
        "dim_customer": "SELECT * FROM dim_customer",
        "dim_vehicle": "SELECT * FROM dim_vehicle",
        "dim_driver": "SELECT * FROM dim_driver",
        "dim_date": "SELECT * FROM dim_date",
        "dim_time": """
            SELECT d.*, (SELECT count(*) FROM fact_anomaly_events a
                         WHERE a.time_key = d.time_key) AS total_anomalies
            FROM dim_time d""",
        "tel_ordered": "SELECT * FROM points",
        "tel_pairs": """
            SELECT vehicle_id, driver_id, trip_id, prev_trip, event_timestamp, prev_ts,
                   speed_kmph, prev_speed, ignition_status, prev_ign, leg_day AS date_key,
                   raw_sec AS raw_dt_sec, sec AS dt_sec, ROUND(km, 6) AS effective_km
            FROM legs""",
        "anomaly_overspeed": f"""
            SELECT {run_columns}, peak AS max_speed, CAST(threshold AS INTEGER) AS speed_limit
            FROM runs WHERE kind = 'OVERSPEEDING'""",
        "anomaly_idle": f"""
            SELECT {run_columns}, duration_secs FROM runs WHERE kind = 'EXCESSIVE_IDLING'""",
        "anomaly_gpsjump": f"""
            SELECT {run_columns}, ROUND(peak, 6) AS implied_speed_kmph
            FROM runs WHERE kind = 'GPS_JUMP'""",
        "fact_anomaly_events": "SELECT * FROM fact_anomaly_events",
        "fact_daily_vehicle_summary": "SELECT * FROM fact_daily_vehicle_summary",
        "fact_trip_summary": "SELECT * FROM fact_trip_summary",
        "pk_violations": " UNION ALL ".join(_unique(t, c) for t, c in PRIMARY_KEYS),
        "fk_violations": " UNION ALL ".join(_refers(*edge) for edge in FOREIGN_KEYS),
        "table_row_counts": " UNION ALL ".join(_count(t) for t in MODEL_TABLES),
        "kpi_fleet": _kpis(),
        "kpi_filtered": _kpis(
            "customer_name = 'ASIA' AND vehicle_type = 'LCV'",
            "date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
        ),
        "kpi_driver": _kpis(driver="driver_name = 'Customer#000000005'"),
        "distance_by_vehicle_type": f"""
            SELECT vehicle_type, {_r('sum(total_distance_km)')} AS total_distance_km
            FROM fact_daily_vehicle_summary JOIN dim_vehicle USING (vehicle_id)
            GROUP BY vehicle_type""",
        "daily_active_vs_anomalies": """
            SELECT date_key, date,
                   (SELECT count(DISTINCT vehicle_id) FROM fact_daily_vehicle_summary f
                    WHERE f.date_key = d.date_key AND total_distance_km > 0)
                     AS active_vehicles,
                   (SELECT count(*) FROM fact_anomaly_events a
                    WHERE a.date_key = d.date_key) AS total_anomalies
            FROM dim_date d""",
        "anomalies_by_type": """
            SELECT anomaly_type, count(*) AS total_anomalies,
                   ROUND(count(*) / (SELECT count(*) FROM fact_anomaly_events), 4) AS share
            FROM fact_anomaly_events GROUP BY anomaly_type""",
        "customer_anomaly_matrix": f"""
            SELECT customer_name, {_pivoted('anomaly_type', ANOMALY_TYPES)}
            FROM fact_anomaly_events JOIN dim_vehicle USING (vehicle_id)
                 JOIN dim_customer USING (customer_id)
            GROUP BY customer_name""",
        "top_vehicles": """
            SELECT vehicle_number, count(*) AS total_anomalies
            FROM fact_anomaly_events JOIN dim_vehicle USING (vehicle_id)
            GROUP BY vehicle_number ORDER BY total_anomalies DESC, vehicle_number LIMIT 10""",
        "heatmap_hour_weekday": f"""
            SELECT hour, {_pivoted('day_name', DAY_NAMES)}
            FROM fact_anomaly_events JOIN dim_time USING (time_key)
                 JOIN dim_date USING (date_key)
            GROUP BY hour""",
        "heatmap_filtered": f"""
            SELECT hour, {_pivoted('day_name', DAY_NAMES)}
            FROM fact_anomaly_events JOIN dim_time USING (time_key)
                 JOIN dim_date USING (date_key)
            WHERE severity = 'HIGH' AND anomaly_type = 'OVERSPEEDING'
            GROUP BY hour""",
        "driver_scorecard": f"""
            SELECT driver_id, driver_name, total_trips, driver_distance_km, total_anomalies,
                   driver_anomalies, safety_score,
                   CASE WHEN safety_score >= 80 THEN 'green' WHEN safety_score >= 60 THEN 'amber'
                        WHEN safety_score IS NOT NULL THEN 'red' END AS score_band
            FROM (SELECT d.driver_id, d.driver_name, ifnull(t.n, 0) AS total_trips,
                         ifnull(t.km, 0) AS driver_distance_km,
                         ifnull(a.n, 0) AS total_anomalies, ifnull(a.own, 0) AS driver_anomalies,
                         if(t.km > 0, {_r('100 - least(100.0, ifnull(a.high, 0) / t.km * 300)', 0)},
                            NULL) AS safety_score
                  FROM dim_driver d
                  LEFT JOIN (SELECT driver_id, count(DISTINCT trip_id) AS n,
                                    {_r('sum(actual_distance_km)')} AS km
                             FROM fact_trip_summary GROUP BY driver_id) t
                         ON t.driver_id = d.driver_id
                  LEFT JOIN (SELECT driver_id, count(*) AS n,
                                    count(*) FILTER (WHERE anomaly_type <> 'GPS_JUMP') AS own,
                                    count(*) FILTER (WHERE anomaly_type = 'OVERSPEEDING'
                                                       AND severity = 'HIGH') AS high
                             FROM fact_anomaly_events GROUP BY driver_id) a
                         ON a.driver_id = d.driver_id) s""",
        "driver_daily_trend": f"""
            SELECT driver_id, date_key, {_r('ifnull(sum(km), 0)')} AS driver_distance_km,
                   count(event) AS total_anomalies
            FROM (SELECT driver_id, date_key, actual_distance_km AS km, NULL AS event
                  FROM fact_trip_summary
                  UNION ALL
                  SELECT driver_id, date_key, NULL, anomaly_key FROM fact_anomaly_events) u
            GROUP BY driver_id, date_key""",
        "driver_report_filtered": f"""
            SELECT driver_id, date_key, {_r('ifnull(sum(km), 0)')} AS driver_distance_km,
                   count(event) AS total_anomalies
            FROM (SELECT driver_id, date_key, actual_distance_km AS km, NULL AS event
                  FROM fact_trip_summary
                  UNION ALL
                  SELECT driver_id, date_key, NULL, anomaly_key FROM fact_anomaly_events) u
            WHERE driver_id IN ('DRV_5', 'DRV_9')
            GROUP BY driver_id, date_key""",
        "recent_anomalies": """
            SELECT driver_id, row_number() OVER latest AS recency, start_time, anomaly_type,
                   severity, metric_value, duration_secs
            FROM fact_anomaly_events
            WINDOW latest AS (PARTITION BY driver_id
                              ORDER BY start_time DESC NULLS LAST, vehicle_id, anomaly_type,
                                       end_time)
            QUALIFY recency <= 20""",
        "anomaly_breakdown": """
            SELECT anomaly_type, severity, count(*) AS n FROM fact_anomaly_events
            GROUP BY anomaly_type, severity ORDER BY anomaly_type, severity""",
    }
    # the same tables, through files
    finals |= {
        "raw_folder_trip_summary": "SELECT * FROM fact_trip_summary",
        "csv_round_trip": "SELECT * FROM fact_trip_summary",
        "parquet_by_day_round_trip": "SELECT * FROM fact_daily_vehicle_summary",
        # the delivered set holds the list of speed limits too
        "delivered_row_counts": finals["table_row_counts"]
        + f" UNION ALL SELECT 'ref_speed_limit', {len(SPEED_LIMITS)}::BIGINT",
    }
    return {name: ask(final) for name, final in finals.items()}
