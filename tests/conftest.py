from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from punctual.schema import DERIVED_COLUMNS, FLIGHT_COLUMNS, struct  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("punctual-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.debug.maxToStringFields", "200")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture
def make_flights(spark):
    """A fact table from partial rows; what a row leaves out is an on-time flight AAA-BBB in January 2024."""
    import datetime

    usual = {
        "Year": 2024,
        "Month": 1,
        "DayofMonth": 1,
        "DayOfWeek": 1,
        "FlightDate": datetime.date(2024, 1, 1),
        "Reporting_Airline": "AA",
        "Flight_Number_Reporting_Airline": "1",
        "Origin": "AAA",
        "OriginCityName": "Alpha, AL",
        "OriginState": "AL",
        "Dest": "BBB",
        "DestCityName": "Beta, BE",
        "DestState": "BE",
        "CRSDepTime": 900.0,
        "DepDelay": 0.0,
        "DepDelayMinutes": 0.0,
        "DepDel15": 0.0,
        "ArrDelay": 0.0,
        "ArrDelayMinutes": 0.0,
        "ArrDel15": 0.0,
        "Cancelled": 0.0,
        "Diverted": 0.0,
        "CRSElapsedTime": 60.0,
        "AirTime": 40.0,
        "Distance": 100.0,
        "Dep_Hour": 9,
        "Route": "AAA-BBB",
    }
    schema = struct({**FLIGHT_COLUMNS, **DERIVED_COLUMNS})

    def build(*rows: dict):
        return spark.createDataFrame(
            [tuple({**usual, **row}.get(f.name) for f in schema) for row in rows], schema
        )

    return build
