from datetime import datetime

import pytest

from hailmeter import schemas
from hailmeter.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def at(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


_TRIP = dict(
    VendorID=1,
    pickup="2025-03-05 10:00:00",
    dropoff="2025-03-05 10:20:00",
    passenger_count=1.0,
    trip_distance=3.0,
    RatecodeID=1.0,
    store_and_fwd_flag="N",
    PULocationID=1,
    DOLocationID=2,
    payment_type=1,
    fare_amount=10.0,
    extra=0.0,
    mta_tax=0.5,
    tip_amount=2.0,
    tolls_amount=0.0,
    improvement_surcharge=1.0,
    total_amount=16.0,
    congestion_surcharge=2.5,
    cbd_congestion_fee=0.0,
    Airport_fee=0.0,
    ehail_fee=None,
    trip_type=1,
)


@pytest.fixture(scope="session")
def make_feed(spark):
    """Rows of one feed from a few overrides over a clean trip."""

    def make(feed: str, *overrides: dict):
        schema = schemas.YELLOW_FILE if feed == "yellow" else schemas.GREEN_FILE
        prefix = "tpep" if feed == "yellow" else "lpep"
        rows = []
        for override in overrides:
            row = {**_TRIP, **override}
            row[f"{prefix}_pickup_datetime"] = at(row["pickup"])
            row[f"{prefix}_dropoff_datetime"] = at(row["dropoff"])
            rows.append(tuple(row[name] for name in schema.fieldNames()))
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def make_weather(spark):
    """Hourly rows from (timestamp, code, snowfall, wind)."""

    def make(*rows):
        out = [
            (at(ts), 40.0, 38.0, 0.0, 0.0, snow, 0.25, code, "x", wind, 20.0, 50, 1000.0)
            for ts, code, snow, wind in rows
        ]
        return spark.createDataFrame(out, schemas.HOURLY_WEATHER)

    return make


@pytest.fixture(scope="session")
def make_zones(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), schemas.ZONE_FILE)

    return make
