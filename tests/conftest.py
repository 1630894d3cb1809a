from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fleet_points import START  # noqa: E402
from roadpulse import Fleet, RawTables, Settings  # noqa: E402
from roadpulse.sources import schemas, speed_limits  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("roadpulse-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        # the inputs are tiny: interpreting beats compiling hundreds of plans
        .config("spark.sql.codegen.wholeStage", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_fleet(spark):
    """Build a fleet from hand-written points. V1..V4 are BIKE, 3W, LCV, HCV and V5
    has a type without a limit; drivers D1, D2 and trips T1..T3 exist."""

    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    day = START.date()
    types = ["BIKE", "3W", "LCV", "HCV", "TRAM"]

    def build(points: list[dict], settings: Settings = Settings(), **options) -> Fleet:
        names = schemas.TELEMETRY.names
        raw = RawTables(
            telemetry=frame([tuple(p[c] for c in names) for p in points], schemas.TELEMETRY),
            vehicles=frame(
                [(f"V{i}", f"MH{i}", t, "C1", day) for i, t in enumerate(types, 1)],
                schemas.VEHICLES,
            ),
            drivers=frame(
                [(f"D{i}", f"Name {i}", f"+9190{i}", f"L{i}", "V1", day) for i in (1, 2)],
                schemas.DRIVERS,
            ),
            customers=frame([("C1", "Acme", "Pune", "Retail")], schemas.CUSTOMERS),
            trips=frame(
                [
                    (f"T{i}", "V1", "D1", START, START, "Pune", "Goa", "COMPLETED")
                    for i in (1, 2, 3)
                ],
                schemas.TRIPS,
            ),
            speed_limits=speed_limits(spark),
        )
        return Fleet(spark, raw, settings, **options)

    return build
