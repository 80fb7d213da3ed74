"""Readers for landed Parquet, CSV and JSON files, tolerant of drift and bad rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailmeter.functions import clock, sky
from hailmeter.schemas import HOURLY_ARRAYS, HOURLY_PAYLOAD, HOURLY_WEATHER, ZONE_FILE

REJECT_COLUMN = "_rejected"


def scan_trip_files(
    spark: SparkSession, path: str, schema: T.StructType | None = None, tolerant: bool = False
) -> DataFrame:
    """A Parquet folder; the schema is inferred unless declared.

    A declared schema matches file columns by name without regard to case,
    fills absent ones with NULL and reads int files as long. `tolerant` skips
    unreadable files, which `load_history` then reports.
    """
    reader = spark.read.option("ignoreCorruptFiles", str(tolerant).lower())
    if schema is None:
        return reader.parquet(path)
    return reader.schema(schema).parquet(path).select(*schema.fieldNames())


def align_columns_by_name(frames: Iterable[DataFrame], schema: T.StructType) -> DataFrame:
    """Union frames of differing shape under one schema.

    Columns match by name without regard to case or order, absent ones become
    NULL, and types are cast. Give one frame per group of files that share a
    layout when the drift is wider than a declared schema can read.
    """

    def aligned(df: DataFrame) -> DataFrame:
        present = {name.lower(): name for name in df.columns}
        return df.select(
            *[
                (
                    F.col(f"`{present[f.name.lower()]}`")
                    if f.name.lower() in present
                    else F.lit(None)
                )
                .cast(f.dataType)
                .alias(f.name)
                for f in schema.fields
            ]
        )

    return reduce(lambda a, b: a.unionByName(b), [aligned(df) for df in frames])


def tolerant_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects with their line and file); a bad line stops nothing."""
    rows = _csv_with_rejects(spark, path, schema, header)
    rejected = F.col(REJECT_COLUMN)
    names = schema.fieldNames()
    good = rows.filter(rejected.isNull()).select(*names)
    bad = rows.filter(rejected.isNotNull()).select(*names, "file", rejected.alias("line"))
    return good, bad


def _csv_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType, header: bool
) -> DataFrame:
    wide = T.StructType([*schema.fields, T.StructField(REJECT_COLUMN, T.StringType(), True)])
    rows = (
        spark.read.schema(wide)
        .option("header", str(header).lower())
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECT_COLUMN)
        # Parse every column, or a bad value in an unused one goes unnoticed.
        .option("columnPruning", "false")
        .csv(path)
    )
    # Spark refuses plans that read the rejected line alone. This comparison is
    # always true and makes the line depend on the parsed columns.
    parsed = F.xxhash64(*schema.fieldNames()) >= F.lit(-(2**63))
    return rows.select(
        *schema.fieldNames(),
        F.when(parsed, F.col(REJECT_COLUMN)).alias(REJECT_COLUMN),
        F.col("_metadata.file_path").alias("file"),
    )


def tolerant_cast(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, rows where some present value does not)."""
    lost = reduce(
        lambda a, b: a | b,
        [
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            for f in schema.fields
        ],
    )
    good = df.filter(~lost).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    return good, df.filter(lost)


def scan_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup: header skipped, optional quotes, N/A stays a string."""
    return tolerant_csv(spark, path, ZONE_FILE)[0]


def flatten_hourly_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Parallel hourly arrays -> one row per hour in the declared table layout."""
    payload = (
        spark.read.schema(HOURLY_PAYLOAD).option("multiLine", str(multi_line).lower()).json(path)
    )
    return flatten_hourly(payload)


def flatten_hourly(payload: DataFrame) -> DataFrame:
    zipped = F.arrays_zip(*[F.col(f"hourly.{name}").alias(name) for name in HOURLY_ARRAYS])
    hours = payload.select(F.explode(zipped).alias("h")).select("h.*")
    named = hours.withColumnsRenamed(HOURLY_ARRAYS).withColumns(
        {
            "datetime_local": clock.parse_local_timestamp(F.col("datetime_local")),
            "weather_description": sky.description(F.col("weather_code")),
        }
    )
    return named.select(*HOURLY_WEATHER.fieldNames())
