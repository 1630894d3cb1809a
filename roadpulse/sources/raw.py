"""Raw inputs: one telemetry Parquet data set and four master CSV files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.session import configure
from roadpulse.settings import SPEED_LIMITS
from roadpulse.sources import schemas


@dataclass(frozen=True)
class RawTables:
    telemetry: DataFrame
    vehicles: DataFrame
    drivers: DataFrame
    customers: DataFrame
    trips: DataFrame
    speed_limits: DataFrame


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a declared schema, casting only where the type differs, so that
    column pruning and filter pushdown still reach the scan."""
    found = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        [
            f.name if found[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The declared columns of a CSV file, bound by the names in its header.

    Other columns are ignored. A declared column that is missing, a part file with another
    header and a cell that does not parse raise an error.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in schema.names if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    declared = {f.name: f.dataType for f in schema.fields}
    found = T.StructType(
        [T.StructField(c, declared.get(c, T.StringType())) for c in header]
    )
    reader = spark.read.schema(found).option("header", True)
    return reader.option("mode", "FAILFAST").option("enforceSchema", False).csv(path).select(
        *schema.names
    )


def speed_limits(spark: SparkSession) -> DataFrame:
    """The fixed list as a literal relation, whose size the optimizer knows."""
    rows = ", ".join(f"('{kind}', {limit})" for kind, limit in SPEED_LIMITS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(vehicle_type, speed_limit)")


def load_raw(spark: SparkSession, root: str) -> RawTables:
    """Read the raw folder. Any file may also be a folder of part files."""
    configure(spark)
    root = root.rstrip("/")
    return RawTables(
        telemetry=conform(
            spark.read.parquet(f"{root}/telemetry_events.parquet"), schemas.TELEMETRY
        ),
        vehicles=read_csv(spark, f"{root}/vehicles.csv", schemas.VEHICLES),
        drivers=read_csv(spark, f"{root}/drivers.csv", schemas.DRIVERS),
        customers=read_csv(spark, f"{root}/customers.csv", schemas.CUSTOMERS),
        trips=read_csv(spark, f"{root}/trips.csv", schemas.TRIPS),
        speed_limits=speed_limits(spark),
    )
