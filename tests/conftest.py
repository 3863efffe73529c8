from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripforge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.debug.maxToStringFields": "1000",
            "spark.checkpoint.dir": str(folder / "checkpoints"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set SQL settings for one test."""
    before = {}

    def change(**values: str) -> None:
        for key, value in values.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


GOOD_TRIP = {
    "VendorID": 1,
    "pickup_datetime": "2021-01-05 10:00:00",
    "dropoff_datetime": "2021-01-05 10:20:30",
    "store_and_fwd_flag": "N",
    "RatecodeID": 1,
    "PULocationID": 10,
    "DOLocationID": 20,
    "passenger_count": 2,
    "trip_distance": 3.5,
    "fare_amount": 12.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 15.3,
    "payment_type": 1,
    "congestion_surcharge": 2.5,
    "service_type": "green",
}

TRIP_DDL = (
    "VendorID int, pickup_datetime string, dropoff_datetime string, store_and_fwd_flag string, "
    "RatecodeID int, PULocationID int, DOLocationID int, passenger_count int, "
    "trip_distance double, fare_amount double, extra double, mta_tax double, tip_amount double, "
    "tolls_amount double, improvement_surcharge double, total_amount double, payment_type int, "
    "congestion_surcharge double, service_type string"
)


@pytest.fixture
def make_trips(spark):
    """Trips that differ from a good one in the given columns."""

    def make(*changes: dict):
        rows = [{**GOOD_TRIP, **change} for change in changes]
        names = list(GOOD_TRIP)
        df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], TRIP_DDL)
        return df.withColumns(
            {c: df[c].cast("timestamp") for c in ("pickup_datetime", "dropoff_datetime")}
        )

    return make
