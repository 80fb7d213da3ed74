"""What landed: load history, inventory, schema drift, column profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailmeter.sources.files import REJECT_COLUMN, _csv_with_rejects, scan_trip_files


def _file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _folder_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def _unit(path: Column, by_folder: bool) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1) if by_folder else path


def _landed_files(spark: SparkSession, path: str, by_folder: bool) -> DataFrame:
    # The content column is never selected, so no file is opened. The path is the one
    # that data scans report too, escaped alike.
    files = spark.read.format("binaryFile").load(path)
    return files.select(_unit(F.col("_metadata.file_path"), by_folder).alias("file")).distinct()


def _history(files: DataFrame, counts: DataFrame, empty_is_failure: bool) -> DataFrame:
    parsed = F.coalesce(F.col("row_parsed"), F.lit(0))
    loaded = F.coalesce(F.col("row_count"), F.lit(0))
    # A file with bytes of which nothing was loaded is never a quiet success.
    failed = F.lit(empty_is_failure) & (loaded == 0)
    status = (
        F.when(failed, "LOAD_FAILED")
        .when(loaded < parsed, "PARTIALLY_LOADED")
        .otherwise("LOADED")
    )
    error = F.when(failed & (parsed == 0), F.lit("no readable rows")).otherwise(
        F.col("first_error_message")
    )
    return (
        files.join(counts, "file", "left")
        .select(
            F.url_decode(F.replace(_file_name(F.col("file")), F.lit("+"), F.lit("%2B"))).alias(
                "file_name"
            ),
            status.alias("status"),
            loaded.cast("bigint").alias("row_count"),
            parsed.cast("bigint").alias("row_parsed"),
            error.alias("first_error_message"),
        )
        .orderBy("file_name")
    )


def load_history_csv(
    spark: SparkSession, path: str, schema: T.StructType, by_folder: bool = False
) -> DataFrame:
    """Per file (or folder): status, good rows, parsed rows, first rejected line."""
    rejected = F.col(REJECT_COLUMN)
    counts = (
        _csv_with_rejects(spark, path, schema, header=True)
        .groupBy(_unit(F.col("file"), by_folder).alias("file"))
        .agg(
            F.count_if(rejected.isNull()).alias("row_count"),
            F.count(F.lit(1)).alias("row_parsed"),
            F.min(rejected).alias("first_error_message"),
        )
    )
    return _history(_landed_files(spark, path, by_folder), counts, empty_is_failure=False)


def load_history_parquet(
    spark: SparkSession, path: str, schema: T.StructType, by_folder: bool = False
) -> DataFrame:
    """The same for Parquet: rows that footers promise beside rows that could be read.

    A count that asks for no column reads footers alone; the other one decodes every column
    of the schema, and stops at the first page of a file that can't be. A file that breaks
    half way is partially loaded; one without a readable footer or row has failed.
    """
    unit = _unit(F.col("_metadata.file_path"), by_folder).alias("file")
    scan = scan_trip_files(spark, path, schema, tolerant=True)
    promised = scan.groupBy(unit).agg(F.count(F.lit(1)).alias("row_parsed"))
    # 1 for every row, but known only once all its columns are decoded
    one = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in scan.columns]), F.lit(1)) + 1
    read = scan.groupBy(unit).agg(F.sum(one).alias("row_count"))
    lost = F.col("row_parsed") - F.coalesce("row_count", F.lit(0))
    counts = promised.join(read, "file", "left").select(
        "file",
        "row_count",
        "row_parsed",
        F.when(
            lost > 0,
            F.concat(lost.cast("string"), F.lit(" of "), "row_parsed", F.lit(" rows unreadable")),
        ).alias("first_error_message"),
    )
    return _history(_landed_files(spark, path, by_folder), counts, empty_is_failure=True)


def file_inventory(df: DataFrame, pickup: str, by_folder: bool = False) -> DataFrame:
    """Rows and pickup-month span per landed file (or landing folder).

    `df` must come straight from a file scan.
    """
    path = F.col("_metadata.file_path")
    unit = _folder_name(path) if by_folder else _file_name(path)
    month = F.date_format(pickup, "yyyy-MM")
    return (
        df.select(unit.alias("landed"), month.alias("month"))
        .groupBy("landed")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("month").alias("first_month"),
            F.max("month").alias("last_month"),
        )
    )


def inventory_check(inventory: DataFrame, expected: int) -> DataFrame:
    """One row: how many files (or folders) landed, and whether that is right."""
    return inventory.agg(
        F.count(F.lit(1)).alias("landed_count"),
        F.lit(expected).cast("bigint").alias("expected_count"),
        (F.count(F.lit(1)) == expected).alias("as_expected"),
    )


def _non_null_rows(df: DataFrame, describe: Sequence[tuple[str, Sequence[Column]]]) -> DataFrame:
    """One pass of count(column) for all columns, unfolded to one row each."""
    counts = df.agg(
        *[F.count(F.col(f"`{name}`")).alias(f"_n{i}") for i, name in enumerate(df.columns)]
    )
    position = {name: i for i, name in enumerate(df.columns)}
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            *extra,
            (
                F.col(f"_n{position[name]}") if name in position else F.lit(None).cast("bigint")
            ).alias("non_null_count"),
        )
        for name, extra in describe
    ]
    return counts.select(F.inline(F.array(*rows)))


def schema_drift(df: DataFrame, canonical: T.StructType) -> DataFrame:
    """Landed columns against the canonical ones: ok, missing, extra, type_changed."""
    actual = {f.name.lower(): f for f in df.schema.fields}
    wanted = {f.name.lower(): f for f in canonical.fields}
    describe = []
    for key in dict.fromkeys([*wanted, *actual]):
        want, got = wanted.get(key), actual.get(key)
        if got is None:
            status = "missing"
        elif want is None:
            status = "extra"
        else:
            status = "ok" if want.dataType == got.dataType else "type_changed"
        kinds = [
            F.lit(f.dataType.simpleString() if f else None).cast("string").alias(name)
            for name, f in (("expected_type", want), ("actual_type", got))
        ]
        describe.append(((got or want).name, [*kinds, F.lit(status).alias("status")]))
    return _non_null_rows(df, describe)


def profile_columns(df: DataFrame) -> DataFrame:
    """Name, type, non-null count and the smallest value as sample, per column."""
    names = df.columns
    summary = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(names)],
        *[F.min(F.col(f"`{c}`")).cast("string").alias(f"_s{i}") for i, c in enumerate(names)],
    )
    rows = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.col(f"_n{i}").alias("non_null_count"),
            F.col(f"_s{i}").alias("sample_value"),
            F.col("_rows").alias("row_count"),
            F.lit(len(names)).alias("column_count"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return summary.select(F.inline(F.array(*rows)))


def sample_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows in a stated order, so the sample is repeatable."""
    return df.orderBy(*order).limit(n)
