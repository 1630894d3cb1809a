"""Telemetry-shaped views over the driver's tables.

The texts below are plain SQL that Spark and DuckDB both run, so a query and its
oracle start from identical rows. Every table is used whole. Defects are seeded
on the telemetry side: ids with an ``X`` (vehicles, drivers, trips) are in no
master, every 67th event is sent twice, some coordinates are zero, missing or
out of bounds, some speeds are negative, and some ids, times, speeds and battery levels
are missing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from roadpulse.session import configure
from roadpulse.settings import Settings
from roadpulse.sources import schemas
from roadpulse.sources.raw import RawTables, conform, speed_limits

TELEMETRY_SQL = """
SELECT CASE WHEN event_id % 1999 <> 0 THEN CAST(event_id AS STRING) END AS event_id,
       CONCAT('VH_', CASE WHEN user_id % 13 = 12 THEN 'X' ELSE '' END,
              CAST(user_id % 13 AS STRING)) AS vehicle_id,
       CONCAT('DRV_', CASE WHEN user_id % 40 % 13 = 11 THEN 'X' ELSE '' END,
              CAST(user_id % 40 AS STRING)) AS driver_id,
       CASE WHEN event_id % 7 = 0 THEN NULL
            ELSE CONCAT('TRIP_', CASE WHEN user_id % 10 = 7 THEN 'X' ELSE '' END,
                        CAST(user_id AS STRING)) END AS trip_id,
       CASE WHEN event_id % 1511 <> 0 THEN ts END AS event_timestamp,
       CASE WHEN event_id % 199 = 0 THEN CAST(0 AS DOUBLE)
            WHEN event_id % 97 = 0 THEN CAST(30 AS DOUBLE)
            ELSE 12 + CAST(user_id % 13 AS DOUBLE) / 4
                 + CAST(event_id % 10 AS DOUBLE) / 1000 END AS latitude,
       CASE WHEN event_id % 211 = 0 THEN NULL
            ELSE 77 + CAST(event_id % 10 AS DOUBLE) / 1000 END AS longitude,
       CASE WHEN event_id % 503 = 0 THEN -value
            WHEN event_id % 307 = 0 THEN NULL
            WHEN event_type = 'view' THEN CAST(0 AS DOUBLE)
            ELSE LEAST(value, CAST(120 AS DOUBLE)) END AS speed_kmph,
       CAST(event_id % 360 AS DOUBLE) AS heading,
       CAST(event_id % 15 AS DOUBLE) AS gps_accuracy,
       CASE WHEN event_type = 'error' THEN 'OFF' ELSE 'ON' END AS ignition_status,
       CASE WHEN event_id % 101 <> 0 THEN CAST(event_id % 110 - 3 AS INT) END AS battery_level
FROM (SELECT event_id, ts, user_id, event_type, value FROM {events}
      UNION ALL
      SELECT event_id, ts + INTERVAL 1 SECOND AS ts, user_id, event_type, value
      FROM {events} WHERE event_id % 67 = 0) sent
"""

CUSTOMERS_SQL = """
SELECT CONCAT('CUST_', CAST(r_regionkey AS STRING)) AS customer_id,
       r_name AS customer_name,
       CONCAT('CITY_', CAST(r_regionkey AS STRING)) AS city,
       CASE WHEN r_regionkey % 2 = 0 THEN 'Retail' ELSE 'FMCG' END AS industry
FROM {region}
"""

VEHICLES_SQL = """
SELECT CONCAT('VH_', CAST(n_nationkey AS STRING)) AS vehicle_id,
       n_name AS vehicle_number,
       CASE n_nationkey % 4 WHEN 0 THEN 'BIKE' WHEN 1 THEN '3W'
                            WHEN 2 THEN 'LCV' ELSE 'HCV' END AS vehicle_type,
       CONCAT('CUST_', CAST(n_regionkey AS STRING)) AS customer_id,
       CAST('2023-01-01' AS DATE) AS registration_date
FROM {nation}
"""

DRIVERS_SQL = """
SELECT CONCAT('DRV_', CAST(c_custkey AS STRING)) AS driver_id,
       c_name AS driver_name,
       CONCAT('+91', CAST(9000000000 + c_custkey AS STRING)) AS phone,
       CONCAT('LIC', CAST(c_custkey AS STRING)) AS license_number,
       CONCAT('VH_', CAST(c_custkey % 12 AS STRING)) AS vehicle_id,
       CAST('2023-06-01' AS DATE) AS joining_date
FROM {customer}
"""

TRIPS_SQL = """
SELECT CONCAT('TRIP_', CAST(user_id AS STRING)) AS trip_id,
       CONCAT('VH_', CAST(user_id % 13 AS STRING)) AS vehicle_id,
       CONCAT('DRV_', CAST(user_id % 40 AS STRING)) AS driver_id,
       MIN(ts) AS planned_start,
       MAX(ts) AS planned_end,
       CONCAT('CITY_', CAST(user_id % 5 AS STRING)) AS origin_city,
       CONCAT('CITY_', CAST(user_id % 7 AS STRING)) AS destination_city,
       CASE WHEN user_id % 10 = 0 THEN 'IN_PROGRESS' ELSE 'COMPLETED' END AS status
FROM {events}
GROUP BY user_id
"""

# The columns read from each table; declaring them saves a look at every footer.
COLUMNS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE",
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING",
}

# Points of one test vehicle are minutes apart, not seconds, hence the longer
# run gap. The calendar starts on the first day found in the data.
TESTBED_SETTINGS = Settings(
    first_day=None, window_end=datetime(2024, 1, 30), run_gap_sec=7200
)


def load_testbed(spark: SparkSession, sf_dir: str) -> RawTables:
    configure(spark)

    def view(text: str, table: str, schema) -> DataFrame:
        columns = spark.read.schema(COLUMNS[table]).parquet(
            f"{sf_dir.rstrip('/')}/{table}.parquet"
        )
        return conform(spark.sql(text, **{table: columns}), schema)

    return RawTables(
        telemetry=view(TELEMETRY_SQL, "events", schemas.TELEMETRY),
        vehicles=view(VEHICLES_SQL, "nation", schemas.VEHICLES),
        drivers=view(DRIVERS_SQL, "customer", schemas.DRIVERS),
        customers=view(CUSTOMERS_SQL, "region", schemas.CUSTOMERS),
        trips=view(TRIPS_SQL, "events", schemas.TRIPS),
        speed_limits=speed_limits(spark),
    )
