"""Canonical schemas of the landed files and of the conformed tables.

Whole numbers of trip files are declared as long: files of different months
store int or long, and the wider declaration reads both.
"""

from __future__ import annotations

from pyspark.sql import types as T

_LONG = T.LongType()
_DOUBLE = T.DoubleType()
_STRING = T.StringType()
_NTZ = T.TimestampNTZType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


def _trip_file(prefix: str, **own: T.DataType) -> T.StructType:
    return _struct(
        VendorID=_LONG,
        **{f"{prefix}_pickup_datetime": _NTZ, f"{prefix}_dropoff_datetime": _NTZ},
        passenger_count=_DOUBLE,
        trip_distance=_DOUBLE,
        RatecodeID=_DOUBLE,
        store_and_fwd_flag=_STRING,
        PULocationID=_LONG,
        DOLocationID=_LONG,
        payment_type=_LONG,
        fare_amount=_DOUBLE,
        extra=_DOUBLE,
        mta_tax=_DOUBLE,
        tip_amount=_DOUBLE,
        tolls_amount=_DOUBLE,
        improvement_surcharge=_DOUBLE,
        total_amount=_DOUBLE,
        congestion_surcharge=_DOUBLE,
        cbd_congestion_fee=_DOUBLE,
        **own,
    )


YELLOW_FILE = _trip_file("tpep", Airport_fee=_DOUBLE)
GREEN_FILE = _trip_file("lpep", ehail_fee=_DOUBLE, trip_type=_LONG)

ZONE_FILE = _struct(LocationID=T.IntegerType(), Borough=_STRING, Zone=_STRING, service_zone=_STRING)

# Payload array -> column of the hourly table, in table order.
HOURLY_ARRAYS = {
    "time": "datetime_local",
    "temperature_2m": "temperature_f",
    "apparent_temperature": "apparent_temperature_f",
    "precipitation": "precipitation_inch",
    "rain": "rain_inch",
    "snowfall": "snowfall_inch",
    "snow_depth": "snow_depth_inch",
    "weather_code": "weather_code",
    "wind_speed_10m": "wind_speed_mph",
    "wind_gusts_10m": "wind_gusts_mph",
    "relative_humidity_2m": "relative_humidity_pct",
    "visibility": "visibility_ft",
}

HOURLY_WEATHER = _struct(
    datetime_local=_NTZ,
    temperature_f=_DOUBLE,
    apparent_temperature_f=_DOUBLE,
    precipitation_inch=_DOUBLE,
    rain_inch=_DOUBLE,
    snowfall_inch=_DOUBLE,
    snow_depth_inch=_DOUBLE,
    weather_code=T.IntegerType(),
    weather_description=_STRING,
    wind_speed_mph=_DOUBLE,
    wind_gusts_mph=_DOUBLE,
    relative_humidity_pct=T.IntegerType(),
    visibility_ft=_DOUBLE,
)


def _array_type(name: str) -> T.DataType:
    if name == "time":
        return _STRING
    return HOURLY_WEATHER[HOURLY_ARRAYS[name]].dataType


HOURLY_PAYLOAD = _struct(
    hourly=T.StructType(
        [T.StructField(name, T.ArrayType(_array_type(name)), True) for name in HOURLY_ARRAYS]
    )
)

# The 23 conformed columns of both feeds.
CONFORMED = _struct(
    taxi_type=_STRING,
    vendor_id=T.IntegerType(),
    pickup_at=_NTZ,
    dropoff_at=_NTZ,
    passenger_count=_DOUBLE,
    trip_distance=_DOUBLE,
    rate_code_id=_DOUBLE,
    store_and_fwd_flag=_STRING,
    pickup_zone_id=T.IntegerType(),
    dropoff_zone_id=T.IntegerType(),
    payment_type=T.IntegerType(),
    fare_amount=_DOUBLE,
    extra=_DOUBLE,
    mta_tax=_DOUBLE,
    tip_amount=_DOUBLE,
    tolls_amount=_DOUBLE,
    improvement_surcharge=_DOUBLE,
    total_amount=_DOUBLE,
    congestion_surcharge=_DOUBLE,
    airport_fee=_DOUBLE,
    cbd_congestion_fee=_DOUBLE,
    ehail_fee=_DOUBLE,
    trip_type=T.IntegerType(),
)
