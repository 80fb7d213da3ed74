"""Lay the given tables out as landed files, so that readers have files to read."""

from __future__ import annotations

from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailmeter import schemas
from hailmeter.catalog import fixtures
from hailmeter.catalog.fixtures import Bronze
from hailmeter.plans.pipeline import Landing
from hailmeter.session import work_dir
from hailmeter.sources.tables import overwrite_table

_SCHEMAS = {
    "yellow": schemas.YELLOW_FILE,
    "green": schemas.GREEN_FILE,
    "zones": schemas.ZONE_FILE,
    "weather": schemas.HOURLY_WEATHER,
}


def _schema(feed: str) -> T.StructType:
    return T.StructType(list(_SCHEMAS[feed].fields))


_stored: dict[tuple[str, str], str] = {}
_landed: dict[tuple[str, str], LazyLanding] = {}


def _rows_per_file(spark: SparkSession, rows: int) -> int:
    """Small tables still give every core a file; large ones get full-size files."""
    return max(20_000, min(5_000_000, rows // (2 * spark.sparkContext.defaultParallelism)))


def stored_bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    """The bronze tables as stored Parquet, written once per application.

    Queries then read plain columns, as they do after a real load, instead of
    repeating the reshaping expressions of the fixture in every filter.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    try:
        return _read_bronze(spark, _stored[key])
    except (KeyError, AnalysisException):  # not written yet, or cleaned away
        base, derived = work_dir(spark, "bronze"), fixtures.bronze(spark, sf_dir)
        rows = _rows_per_file(spark, fixtures.given(spark, sf_dir, "lineitem").count())
        for name in _SCHEMAS:
            overwrite_table(
                getattr(derived, name), f"{base}/{name}", rows_per_file=rows, compression="zstd"
            )
        _stored[key] = base
        return _read_bronze(spark, base)


def _read_bronze(spark: SparkSession, base: str) -> Bronze:
    return Bronze(
        **{
            name: spark.read.schema(schema).parquet(f"{base}/{name}")
            for name, schema in _SCHEMAS.items()
        }
    )


def land_trips(df: DataFrame, pickup: str, path: str) -> str:
    """Monthly folders of Parquet files: trips are brought together by month first.

    They aren't in time order, so every task would open a file per month otherwise; a
    month with very many trips is split over several tasks.
    """
    month = F.date_format(pickup, "yyyy-MM")
    monthly = df.withColumn("landed_month", month).hint("rebalance", "landed_month")
    monthly.write.mode("overwrite").partitionBy(
        "landed_month"
    ).parquet(path)
    return path


def land_zones(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)
    return path


def hourly_payload(weather: DataFrame) -> DataFrame:
    """One document of twelve parallel arrays per day (24 readings each)."""
    back = {column: name for name, column in schemas.HOURLY_ARRAYS.items()}
    reading = F.struct(
        *[
            (
                F.date_format(column, "yyyy-MM-dd'T'HH:mm")
                if column == "datetime_local"
                else F.col(column)
            ).alias(name)
            for column, name in back.items()
        ]
    )
    days = weather.groupBy(F.to_date("datetime_local").alias("day")).agg(
        F.sort_array(F.collect_list(reading)).alias("r")
    )
    return days.select(
        F.struct(*[F.col(f"r.{name}").alias(name) for name in schemas.HOURLY_ARRAYS]).alias(
            "hourly"
        )
    )


def land_weather(df: DataFrame, path: str) -> str:
    hourly_payload(df).write.mode("overwrite").json(path)
    return path


def land_in_order(spark: SparkSession, landed: str, schema: T.StructType, path: str) -> str:
    """The monthly folders again, one after the other, as a running feed leaves them.

    Stream sources read files by their time of change. Months are few; a month's files
    are written side by side.
    """
    whole = spark.read.schema(schema.add("landed_month", "string")).parquet(landed)
    months = [r[0] for r in whole.select("landed_month").distinct().collect()]
    for month in sorted(months, key=lambda m: m or ""):
        own = whole.filter(F.col("landed_month").eqNullSafe(F.lit(month))).drop("landed_month")
        own.write.mode("overwrite").parquet(f"{path}/landed={month or 'unknown'}")
    return f"{path}/landed=*"


class LazyLanding:
    """The folders of the four sources; a source is written when first asked for."""

    def __init__(self, base: str, source: Bronze):
        self._base = base
        self._source = source

    @cached_property
    def yellow(self) -> str:
        return land_trips(self._source.yellow, "tpep_pickup_datetime", f"{self._base}/yellow")

    @cached_property
    def green(self) -> str:
        return land_trips(self._source.green, "lpep_pickup_datetime", f"{self._base}/green")

    @cached_property
    def zones(self) -> str:
        return land_zones(self._source.zones, f"{self._base}/zones")

    @cached_property
    def weather(self) -> str:
        return land_weather(self._source.weather, f"{self._base}/weather")

    @cached_property
    def yellow_in_order(self) -> str:
        path = f"{self._base}/yellow-in-order"
        return land_in_order(self._source.yellow.sparkSession, self.yellow, _schema("yellow"), path)

    @cached_property
    def green_in_order(self) -> str:
        path = f"{self._base}/green-in-order"
        return land_in_order(self._source.yellow.sparkSession, self.green, _schema("green"), path)

    def all(self) -> Landing:
        return Landing(self.yellow, self.green, self.zones, self.weather)


def landed_files(spark: SparkSession, sf_dir: str, source: Bronze) -> LazyLanding:
    """One landing per application and folder of given tables, shared by its queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        _landed[key] = LazyLanding(work_dir(spark, "landing"), source)
    return _landed[key]


def land_all(spark: SparkSession, source: Bronze) -> Landing:
    return LazyLanding(work_dir(spark, "landing"), source).all()
