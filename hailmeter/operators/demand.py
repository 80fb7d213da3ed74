"""The demand mart, its coarser roll-ups, and grids without missing cells."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailmeter.operators.enrich import UnzonedTrips, grouped_sums

EXCLUDED_BOROUGHS = ("Unknown", "N/A", "EWR")

MART_KEYS = (
    "pickup_borough", "weather_category", "is_adverse_weather",
    "pickup_year", "pickup_month", "pickup_hour",
    "is_rush_hour", "is_night", "is_weekend", "payment_type",
)
# Mart measure -> summed fact column.
MART_SUMS = {
    "total_revenue": "total_amount",
    "total_fares": "fare_amount",
    "total_tips": "tip_amount",
    "total_tolls": "tolls_amount",
    "total_congestion_surcharge": "congestion_surcharge",
    "total_cbd_fee": "cbd_congestion_fee",
}
# Mart measure -> averaged fact column.
MART_AVERAGES = {
    "avg_fare_total": "total_amount",
    "avg_tip": "tip_amount",
    "avg_duration_minutes": "trip_duration_minutes",
    "avg_distance": "trip_distance",
}


def city_boroughs(df: DataFrame, excluded: Sequence[str] = EXCLUDED_BOROUGHS) -> DataFrame:
    """Rows with a known borough inside the city."""
    borough = F.col("pickup_borough")
    return df.filter(borough.isNotNull() & ~borough.isin(*excluded))


def mart_weather_demand(fact: DataFrame | UnzonedTrips) -> DataFrame:
    """10 keys and 11 measures; one shuffle behind map-side partial sums.

    From `UnzonedTrips` it is groups that meet the zones, and two small shuffles.
    """
    return _mart(fact, {})


def _mart(fact: DataFrame | UnzonedTrips, more: dict[str, str]) -> DataFrame:
    """`more` counts the known values of columns."""
    if isinstance(fact, UnzonedTrips):
        return _eager_mart(fact, more)
    return (
        city_boroughs(fact)
        .groupBy(*MART_KEYS)
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            *[F.sum(source).alias(name) for name, source in MART_SUMS.items()],
            *[F.avg(source).alias(name) for name, source in MART_AVERAGES.items()],
            *[F.count(source).alias(name) for name, source in more.items()],
        )
    )


def known(column: str) -> Column:
    """1 where a value is known: its sum is the count behind an average."""
    return F.when(F.col(column).isNotNull(), 1).otherwise(0).cast("bigint")


def average(total: str, count: str) -> Column:
    """The mean of known values from their total and number; NULL where there is none."""
    return F.col(total) / F.nullif(F.col(count), F.lit(0))


def _eager_mart(trips: UnzonedTrips, more: dict[str, str]) -> DataFrame:
    """Averages don't add up, so their totals and counts go through both steps."""
    sums = {"trip_count": F.lit(1).cast("bigint")}
    sums |= {name: F.col(source) for name, source in MART_SUMS.items()}
    for name, source in MART_AVERAGES.items():
        sums |= {f"_{name}_total": F.col(source), f"_{name}_known": known(source)}
    sums |= {name: known(source) for name, source in more.items()}
    return grouped_sums(trips, MART_KEYS, sums, city_boroughs).select(
        *MART_KEYS,
        "trip_count",
        *MART_SUMS,
        *[average(f"_{name}_total", f"_{name}_known").alias(name) for name in MART_AVERAGES],
        *more,
    )


# Weight of a mart average -> the fact column whose known values it counts.
MART_WEIGHTS = {"known_durations": "trip_duration_minutes", "known_distances": "trip_distance"}


def weighted_mart(fact: DataFrame | UnzonedTrips) -> DataFrame:
    """The mart with the number of known values behind two of its averages.

    An average leaves unknown values out, so it can be averaged again only with the
    number of known ones as its weight, not with the number of trips.
    """
    return _mart(fact, MART_WEIGHTS)


def as_demand(frame: DataFrame) -> DataFrame:
    """Rows that sum up to demand, from the mart or straight from the fact.

    Reports re-aggregate either one to a handful of groups. From the fact they
    need a single shuffle of those few groups and no 10-key mart in between;
    from a stored mart they read a small table. Averages of the mart cannot
    be averaged again, so they come back as totals and numbers of known values:
    exact from `weighted_mart`; from the plain mart every trip of a group with
    an average has to count as known.
    """
    if "trip_count" in frame.columns:
        for average, weight in (
            ("avg_duration_minutes", "known_durations"),
            ("avg_distance", "known_distances"),
        ):
            if weight not in frame.columns:
                trips = F.when(F.col(average).isNotNull(), F.col("trip_count")).otherwise(0)
                frame = frame.withColumn(weight, trips)
        return frame.withColumns(
            {
                "duration_total": F.col("avg_duration_minutes") * F.col("known_durations"),
                "distance_total": F.col("avg_distance") * F.col("known_distances"),
            }
        )
    return city_boroughs(frame).select(
        *MART_KEYS, *[value.alias(name) for name, value in _trip_measures().items()]
    )


def _trip_measures() -> dict[str, Column]:
    """What one trip adds to each measure."""
    return {
        "trip_count": F.lit(1).cast("bigint"),
        **{name: F.col(source) for name, source in MART_SUMS.items()},
        "duration_total": F.col("trip_duration_minutes"),
        "distance_total": F.col("trip_distance"),
        **{name: known(source) for name, source in MART_WEIGHTS.items()},
    }


def rollup(
    frame: DataFrame | UnzonedTrips, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Sum measures of the mart, the fact or trips without zones over fewer keys."""
    if isinstance(frame, UnzonedTrips):
        each = _trip_measures()
        return grouped_sums(frame, keys, {m: each[m] for m in measures}, city_boroughs)
    return as_demand(frame).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


@dataclass(frozen=True)
class Cell:
    """One output row per entity: literal labels and conditional sums."""

    labels: dict[str, object]
    sums: dict[str, tuple[str, Column]]


def grid(groups: DataFrame, entity: Sequence[str], cells: Sequence[Cell]) -> DataFrame:
    """One row per entity and cell, 0 where the groups have nothing.

    `groups` is an aggregated frame. All cells are conditional sums of one
    pass, unfolded afterwards, so absent combinations appear without a join
    against a skeleton.
    """
    sums = [
        F.coalesce(
            F.sum(F.when(condition, F.col(source))), F.lit(0).cast(groups.schema[source].dataType)
        ).alias(f"_{i}_{name}")
        for i, cell in enumerate(cells)
        for name, (source, condition) in cell.sums.items()
    ]
    rows = F.array(
        *[
            F.struct(
                *[F.lit(value).alias(name) for name, value in cell.labels.items()],
                *[F.col(f"_{i}_{name}").alias(name) for name in cell.sums],
            )
            for i, cell in enumerate(cells)
        ]
    )
    return groups.groupBy(*entity).agg(*sums).select(*entity, F.inline(rows))
