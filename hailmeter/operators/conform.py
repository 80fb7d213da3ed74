"""Bronze to silver: conform both feeds, derive, flag; conform the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailmeter.functions import clock, rules, sky
from hailmeter.schemas import CONFORMED

# Conformed name -> file name where they differ; {p} is the feed's prefix.
_FILE_NAMES = {
    "vendor_id": "VendorID",
    "pickup_at": "{p}_pickup_datetime",
    "dropoff_at": "{p}_dropoff_datetime",
    "rate_code_id": "RatecodeID",
    "pickup_zone_id": "PULocationID",
    "dropoff_zone_id": "DOLocationID",
}


def _conform(df: DataFrame, feed: str, prefix: str, lacking: tuple[str, ...]) -> DataFrame:
    def column(field):
        if field.name == "taxi_type":
            value = F.lit(feed)
        elif field.name in lacking:
            value = F.lit(None)
        else:
            value = F.col(_FILE_NAMES.get(field.name, field.name).format(p=prefix))
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in CONFORMED.fields])


def conform_yellow(df: DataFrame) -> DataFrame:
    """23 conformed columns; this feed has no e-hail fee and no trip type."""
    return _conform(df, "yellow", "tpep", ("ehail_fee", "trip_type"))


def conform_green(df: DataFrame) -> DataFrame:
    """23 conformed columns; this feed has no airport fee."""
    return _conform(df, "green", "lpep", ("airport_fee",))


def union_trips(yellow: DataFrame, green: DataFrame) -> DataFrame:
    """UNION ALL of the raw feeds in conformed shape."""
    return conform_yellow(yellow).unionByName(conform_green(green))


def derive_trip_features(trips: DataFrame) -> DataFrame:
    """Add duration, calendar parts and the three time-of-day flags."""
    pickup = F.col("pickup_at")
    parts = trips.withColumns(
        {
            "trip_duration_minutes": clock.boundary_minutes(pickup, F.col("dropoff_at")),
            "pickup_year": F.year(pickup),
            "pickup_month": F.month(pickup),
            "pickup_dayofweek": clock.day_of_week(pickup),
            "pickup_hour": F.hour(pickup),
        }
    )
    dow, hour = F.col("pickup_dayofweek"), F.col("pickup_hour")
    return parts.withColumns(
        {
            "is_night": clock.is_night(hour),
            "is_weekend": clock.is_weekend(dow),
            "is_rush_hour": clock.is_rush_hour(dow, hour),
        }
    )


def flag_trips(trips: DataFrame, checks: list[rules.Rule] | None = None) -> DataFrame:
    """Flag, never delete: validity and the list of broken rules."""
    checks = checks or rules.trip_rules()
    return trips.withColumns(
        {"is_valid": rules.is_valid(checks), "dq_flag_reason": rules.flag_reason(checks)}
    )


def stage_trips(
    yellow: DataFrame, green: DataFrame, checks: list[rules.Rule] | None = None
) -> DataFrame:
    """The 33-column silver trip table. Works on batch and on stream frames."""
    return flag_trips(derive_trip_features(union_trips(yellow, green)), checks)


def stage_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        "service_zone",
    )


def stage_weather(hourly: DataFrame, **thresholds) -> DataFrame:
    """13 landed columns plus join keys, category and adverse flag (17)."""
    code, at = F.col("weather_code"), F.col("datetime_local")
    readings = [c for c in hourly.columns if c != "datetime_local"]
    return hourly.select(
        at,
        F.to_date(at).alias("weather_date"),
        F.hour(at).alias("weather_hour"),
        *readings,
        sky.category(code).alias("weather_category"),
        sky.is_adverse(
            code, F.col("snowfall_inch"), F.col("wind_speed_mph"), **thresholds
        ).alias("is_adverse_weather"),
    )


def dim_zones(staged_zones: DataFrame) -> DataFrame:
    return staged_zones.select("location_id", "borough", "zone_name", "service_zone")


def dim_weather(staged_weather: DataFrame) -> DataFrame:
    """The 16-column hourly dimension: the raw timestamp stays in silver."""
    return staged_weather.drop("datetime_local")
