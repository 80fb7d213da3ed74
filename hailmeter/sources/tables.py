"""Table writers: full refresh, partition refresh, append under a schema."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def overwrite_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    only_touched: bool = False,
    rows_per_file: int | None = None,
    compression: str | None = None,
) -> DataFrame:
    """Create or replace a Parquet table and return it as stored.

    `rebalance` asks Spark for even output files per partition value, for
    sources that are not already clustered by time; hot values are split.
    `only_touched` replaces just the partitions present in `df`.
    `rows_per_file` splits the output of a task without a shuffle, so that a
    table written by few tasks can be read by many.
    """
    out = df.hint("rebalance", *partition_by) if rebalance else df
    writer = out.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        mode = "dynamic" if only_touched else "static"
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", mode)
    writer.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.select(*df.columns)


def write_observed(
    df: DataFrame, path: str, metrics: Mapping[str, Column], **options
) -> tuple[DataFrame, dict]:
    """`publish_table`, and aggregates of the rows as they were written: no second scan."""
    observed = Observation(f"write-{uuid.uuid4().hex}")
    if options.pop("rebalance", False):
        # the aggregates stay in the writing tasks, behind the shuffle
        df = df.hint("rebalance", *options.get("partition_by", ()))
    watched = df.observe(observed, *[value.alias(name) for name, value in metrics.items()])
    return publish_table(watched, path, **options), observed.get


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def table_versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of a published table, oldest first: those Spark has committed."""
    files, where = _file_system(spark, path)
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()]
    done = [
        n
        for n in names
        if n.startswith("v-")
        and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))
    ]
    return [f"{path}/{n}" for n in sorted(done)]


def publish_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    keep: int = 2,
) -> DataFrame:
    """Create or replace a table in one step and return it as stored.

    Each write goes to a folder of its own, and what readers see switches when Spark puts
    its success marker there, as the last thing of a job: a single new file, on any store. A
    write that fails leaves the version before it in place. The last `keep` versions stay
    for those who still read them.
    """
    spark = df.sparkSession
    before = table_versions(spark, path)
    number = 1 + (int(before[-1].rpartition("/v-")[2].split("-")[0]) if before else 0)
    version = f"{path}/v-{number:010}-{uuid.uuid4().hex[:8]}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(version)
    for old in table_versions(spark, path)[:-keep]:
        files, where = _file_system(spark, old)
        files.delete(where, True)
    return spark.read.schema(df.schema).parquet(version).select(*df.columns)


def read_published(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest complete version of a published table."""
    versions = table_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete version in {path}")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(versions[-1])


def append_table(df: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    """Append under a declared schema: columns by name, values cast."""
    fitted = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    fitted.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def append_small_frame(
    spark: SparkSession, rows: Sequence[tuple], path: str, schema: T.StructType
) -> DataFrame:
    """Append a handful of literal rows, for example a hand-kept lookup."""
    return append_table(spark.createDataFrame(list(rows), schema), path, schema)
