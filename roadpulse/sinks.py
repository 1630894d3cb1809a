"""Delivery of the model: CSV, Parquet, catalog tables, relational database."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.model import MODEL_TABLES

Star = Mapping[str, DataFrame]

READ_OPTIONS = ("url", "driver", "user", "password")


def _in_load_order(star: Star) -> list[tuple[str, DataFrame]]:
    return [(name, star[name]) for name in MODEL_TABLES if name in star] + [
        (name, df) for name, df in star.items() if name not in MODEL_TABLES
    ]


def _clustered(df: DataFrame, partition_by: str | None) -> DataFrame:
    """Bring the rows of a day together before a partitioned write, with files of
    an even size: rebalancing splits a day that is too large for one task."""
    return df if partition_by is None else df.hint("rebalance", partition_by)


def _write_all(writes: list[Callable[[], None]], at_once: int) -> None:
    """Run independent write jobs side by side: a small table then does not hold
    up the executors that a large one leaves idle."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(write) for write in writes]:
            done.result()


def write_csv(star: Star, root: str, at_once: int = 4) -> None:
    """One folder per table with a header line; timestamps as plain text."""

    def write(name: str, df: DataFrame) -> None:
        plain = df.select(
            [
                F.col(f.name).cast("string").alias(f.name)
                if isinstance(f.dataType, T.TimestampNTZType)
                else f.name
                for f in df.schema.fields
            ]
        )
        plain.write.mode("overwrite").option("header", True).csv(f"{root}/{name}.csv")

    _write_all([partial(write, name, df) for name, df in _in_load_order(star)], at_once)


def write_parquet(star: Star, root: str, by_day: bool = False, at_once: int = 4) -> None:
    """One folder per table; ``by_day`` lays the facts out by date_key so that a
    date filter skips whole folders."""

    def write(name: str, df: DataFrame) -> None:
        day = "date_key" if by_day and name.startswith("fact_") else None
        writer = _clustered(df, day).write.mode("overwrite")
        if day:
            writer = writer.partitionBy(day)
        writer.parquet(f"{root}/{name}.parquet")

    _write_all([partial(write, name, df) for name, df in _in_load_order(star)], at_once)


def load_warehouse(
    spark: SparkSession, root: str, schemas: Mapping[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    """The written tables; known ``schemas`` spare a look at the file footers."""
    tables = {}
    for name in MODEL_TABLES:
        reader = spark.read if schemas is None else spark.read.schema(schemas[name])
        tables[name] = reader.parquet(f"{root}/{name}.parquet")
    return tables


def save_tables(star: Star, database: str, speed_limits: DataFrame | None = None) -> None:
    """Replace the model tables, and the speed-limit list, in a catalog database."""
    tables = dict(star)
    if speed_limits is not None:
        tables["ref_speed_limit"] = speed_limits
    for name, df in _in_load_order(tables):
        df.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")


def register_tables(
    spark: SparkSession, database: str, root: str, schemas: Mapping[str, T.StructType],
    by_day: bool = False,
) -> None:
    """Replace tables of a catalog database by external ones over written Parquet files,
    without a second write. ``by_day`` as in ``write_parquet``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in schemas.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        dated = by_day and name.startswith("fact_")
        days = "PARTITIONED BY (date_key)" if dated else ""
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(
            f"CREATE TABLE {database}.{name} ({columns}) USING parquet {days} "
            f"LOCATION '{root}/{name}.parquet'"
        )
        if dated:
            spark.sql(f"MSCK REPAIR TABLE {database}.{name}")


@dataclass(frozen=True)
class JdbcTarget:
    """A relational database, reached from the executors over JDBC."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = "org.postgresql.Driver"
    schema: str | None = None
    connections: int = 16
    batch_rows: int = 10_000
    # once foreign keys exist a table cannot be dropped; it is emptied instead
    keep_definitions: bool = False
    extra: dict[str, str] = field(default_factory=dict)

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name

    def options(self, name: str) -> dict[str, str]:
        chosen = {
            "url": self.url,
            "dbtable": self.table(name),
            "driver": self.driver,
            "batchsize": str(self.batch_rows),
            # a larger frame is coalesced to this many writing tasks
            "numPartitions": str(self.connections),
        }
        if self.user is not None:
            chosen["user"] = self.user
        if self.password is not None:
            chosen["password"] = self.password
        if self.keep_definitions:
            chosen |= {"truncate": "true", "cascadeTruncate": "true"}
        return chosen | self.extra

    def writer(self, name: str, df: DataFrame) -> DataFrameWriter:
        return df.write.format("jdbc").mode("overwrite").options(**self.options(name))

    def count(self, spark: SparkSession, name: str) -> int:
        """Rows of a table, counted by the database."""
        query = f"SELECT COUNT(*) AS n FROM {self.table(name)}"
        options = {k: v for k, v in self.options(name).items() if k in READ_OPTIONS}
        reader = spark.read.format("jdbc").options(**options | self.extra, query=query)
        return int(reader.load().first()["n"])


def publish(
    spark: SparkSession,
    star: Star,
    target: JdbcTarget,
    report: Callable[[str, int], None] | None = None,
) -> dict[str, int]:
    """Load every table, dimensions first, and check the arrived row counts.

    ``star`` should be a written warehouse: each table is read twice here.
    """
    loaded = {}
    for name, df in _in_load_order(star):
        target.writer(name, df).save()
        arrived, expected = target.count(spark, name), df.count()
        if arrived != expected:
            raise RuntimeError(f"{name}: {arrived} rows arrived, {expected} were sent")
        loaded[name] = arrived
        if report:
            report(name, arrived)
    return loaded
