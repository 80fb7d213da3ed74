"""Load only what is new: file-source streams run to the end of the backlog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hailmeter.functions import rules
from hailmeter.operators.conform import stage_trips


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def incremental_load(
    stream: DataFrame, table: str, checkpoint: str, partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """Append the backlog to a Parquet table, each file exactly once.

    The checkpoint remembers loaded files and the sink's own log drops output
    of failed attempts, so a rerun adds only files that landed since.
    """
    writer = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(table).awaitTermination()
    spark = stream.sparkSession
    return spark.read.schema(stream.schema).parquet(table).select(*stream.columns)


def stream_stage_trips(
    yellow: DataFrame,
    green: DataFrame,
    table: str,
    checkpoint: str,
    checks: list[rules.Rule] | None = None,
) -> DataFrame:
    """Both feeds through the silver expressions, stateless, exactly once."""
    return incremental_load(stage_trips(yellow, green, checks), table, checkpoint)
