"""Full rebuild: raw folder in, exported star schema out."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from roadpulse.model import Fleet
from roadpulse.sinks import load_warehouse, register_tables, write_csv, write_parquet
from roadpulse.versions import Versions

SPEED_LIMITS = "ref_speed_limit"


def build_warehouse(
    fleet: Fleet,
    out: str,
    csv: bool = True,
    by_day: bool = False,
    database: str | None = None,
) -> dict[str, DataFrame]:
    """Write all model tables as Parquet (and CSV) and return the written star.

    All or nothing: the set is written to a folder of its own, and only when every table is
    there do readers of ``out`` (see ``open_warehouse``) change over to it; the set before
    stays for those that still read it.

    Needs a staged fleet. The rollup, the events, and the dimensions with the log
    are independent of each other and are computed side by side. The CSV export
    reads the finished Parquet files, not the plans behind them. If a database is named,
    its tables (with the list of speed limits) are registered over the Parquet files.
    """
    if not fleet.staged:
        raise ValueError("open the fleet with staged=True to write its tables")
    star, spark = fleet.star(), fleet.spark
    facts = [name for name in star if name.startswith("fact_")]
    others = {name: star[name] for name in star if name not in (*facts, "dq_log")}
    limits = {SPEED_LIMITS: fleet.raw.speed_limits}
    versions = Versions(spark, out)
    try:
        with versions.new() as folder, ThreadPoolExecutor() as pool:
            parquet = f"{folder}/parquet"
            jobs = [pool.submit(write_parquet, others | limits, parquet)]
            # the step that everything below waits for
            fleet.ordered  # noqa: B018
            jobs += [
                pool.submit(lambda: fleet.rollup),
                pool.submit(lambda: fleet.fact_anomaly_events),
                pool.submit(lambda: write_parquet({"dq_log": star["dq_log"]}, parquet)),
            ]
            for job in jobs:
                job.result()
            write_parquet({name: star[name] for name in facts}, parquet, by_day)
            schemas = {name: df.schema for name, df in {**star, **limits}.items()}
            written = load_warehouse(spark, parquet, schemas)
            if csv:
                write_csv(written, f"{folder}/csv")
    finally:
        fleet.release()
    if database is not None:
        register_tables(spark, database, parquet, schemas, by_day)
    versions.prune()
    return written


def open_warehouse(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of the last rebuild that ended well."""
    return load_warehouse(spark, f"{Versions(spark, out).current()}/parquet")
