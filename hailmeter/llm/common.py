"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hailmeter.session import materialize

__all__ = [
    "documents", "table", "stored", "fold", "shuffle_partitions", "unused_name", "bounded_batches"
]

#: Bytes of the Arrow batches that Spark sends to Python tasks.
BATCH_BYTES = "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, which also cuts the lineage."""
    return materialize(df, label)


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`."""
    return F.crc32(F.col(key).cast("string")) % F.lit(parts)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame doesn't have yet."""
    have = {c.lower() for c in df.columns}
    while wanted.lower() in have:
        wanted = f"_{wanted}"
    return wanted


def bounded_batches(spark: SparkSession) -> None:
    """Cut this session's Arrow batches by bytes, not by 10,000 rows of any length alone.

    A batch is held by Spark and by the Python worker at once, in every task.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
