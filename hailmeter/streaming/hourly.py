"""Trips per zone and hour, kept up to date as files land."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailmeter.functions import clock
from hailmeter.operators import conform
from hailmeter.operators.dimension import attach

EVENT_TIME = "_event_time"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _with_event_time(trips: DataFrame, delay: str) -> DataFrame:
    """Watermarks need the zoned type; under a UTC session the cast moves nothing."""
    return trips.withColumn(EVENT_TIME, F.col("pickup_at").cast("timestamp")).withWatermark(
        EVENT_TIME, delay
    )


def timed_trips(yellow: DataFrame, green: DataFrame, delay: str) -> DataFrame:
    """Silver trips of both feeds, each under its own watermark.

    The slower feed holds the common watermark back, so a feed that is read faster never
    makes the other one late.
    """
    both = _with_event_time(conform.conform_yellow(yellow), delay).unionByName(
        _with_event_time(conform.conform_green(green), delay)
    )
    return conform.flag_trips(conform.derive_trip_features(both))


def hourly_counts(staged: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Windowed counts per zone; works on a stream and on a batch frame."""
    if EVENT_TIME not in staged.columns:
        staged = _with_event_time(staged, delay)
    return (
        staged.groupBy(F.window(EVENT_TIME, "1 hour").alias("w"), "pickup_zone_id")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.sum("total_amount").alias("total_revenue"),
        )
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("hour_start"),
            "pickup_zone_id",
            "trip_count",
            "total_revenue",
        )
    )


@contextmanager
def _rocksdb(spark: SparkSession):
    """State on the executors' disks beside their heap, for queries started inside."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def run_backlog(counts: DataFrame, table: str, checkpoint: str) -> list[int]:
    """Run the backlog into `table`; returns the groups in state after each micro-batch.

    Update mode with an upsert by day: a micro-batch reads what the table holds of the days
    it touches, puts its changed groups over it, and writes those days anew as its own
    version, which a retried batch replaces. Readers take each day's newest version, so
    reading costs what the days hold and not how often they were touched. Groups whose
    hour the watermark has passed leave the state and stay in the table.
    """
    spark = counts.sparkSession

    def upsert(groups: DataFrame, batch_id: int) -> None:
        changed = groups.withColumn("day", F.to_date("hour_start")).withColumn(
            "batch_id", F.lit(batch_id).cast("bigint")
        )
        days = changed.select("day").distinct()
        # a batch that is tried again must not see what its first attempt left
        older = _entries(spark, table, counts, batch_id) if batch_id else None
        if older is not None:
            held = _current(older.join(days, "day", "left_semi"))
            changed = held.unionByName(changed)
        newest = (
            changed.groupBy("day", "hour_start", "pickup_zone_id")
            .agg(F.max_by(F.struct("trip_count", "total_revenue"), "batch_id").alias("v"))
            .select("day", "hour_start", "pickup_zone_id", "v.*")
        )
        newest.write.mode("overwrite").partitionBy("day").parquet(f"{table}/batch_id={batch_id}")

    with _rocksdb(spark):
        query = (
            counts.writeStream.outputMode("update")
            .foreachBatch(upsert)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return [
        sum(state["numRowsTotal"] for state in progress["stateOperators"])
        for progress in query.recentProgress
    ]


def _entries(
    spark: SparkSession, table: str, like: DataFrame, before: int | None = None
) -> DataFrame:
    """All versions of all days, or those of batches before one."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in like.schema.fields)
    found = spark.read.schema(f"{columns}, batch_id BIGINT, day DATE").parquet(table)
    return found if before is None else found.filter(F.col("batch_id") < before)


def _current(entries: DataFrame) -> DataFrame:
    """Each day's newest version; the list of days is as long as the calendar."""
    latest = entries.groupBy("day").agg(F.max("batch_id").alias("batch_id"))
    return entries.join(F.broadcast(latest), ["day", "batch_id"], "left_semi")


def hourly_table(spark: SparkSession, table: str, like: DataFrame) -> DataFrame:
    """Zone x hour groups as they stand."""
    return _current(_entries(spark, table, like)).select(*like.columns)


def stream_hourly_demand(
    staged: DataFrame,
    weather: DataFrame,
    table: str,
    checkpoint: str,
    delay: str = "2 hours",
    weather_small: bool | None = None,
) -> DataFrame:
    """Run the backlog and return zone x hour demand with the hour's weather.

    Files must land in time order up to `delay`; hours the watermark still holds open are
    present too.
    """
    counts = hourly_counts(staged, delay)
    run_backlog(counts, table, checkpoint)
    return attach_hour(hourly_table(staged.sparkSession, table, counts), weather, weather_small)


def attach_hour(
    demand: DataFrame, weather: DataFrame, weather_small: bool | None = None
) -> DataFrame:
    """Join the static weather table on the hour."""
    keyed = demand.withColumn("_start_index", clock.hour_index(F.col("hour_start")))
    hours = weather.select(
        clock.hour_index_of(F.col("weather_date"), F.col("weather_hour")).alias("_hour_index"),
        "weather_category",
        "is_adverse_weather",
    )
    on = [("_start_index", "_hour_index")]
    return attach(keyed, hours, on, small=weather_small).drop("_start_index")
