"""Silver to gold: the enriched fact table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailmeter.functions import clock, money
from hailmeter.operators import conform
from hailmeter.operators.dimension import (
    Lookup,
    attach,
    attach_all,
    counted_heavy_keys,
    fits_broadcast,
    measured,
)

FACT_COLUMNS = (
    "taxi_type", "pickup_at", "dropoff_at",
    "pickup_year", "pickup_month", "pickup_dayofweek", "pickup_hour",
    "is_night", "is_weekend", "is_rush_hour",
    "trip_duration_minutes", "trip_distance", "passenger_count", "payment_type",
    *[c for c in money.FEE_COLUMNS], "total_amount",
    "pickup_zone_id", "dropoff_zone_id",
    "pickup_borough", "pickup_zone_name", "dropoff_borough", "dropoff_zone_name",
    "weather_category", "is_adverse_weather",
    "temperature_f", "precipitation_inch", "wind_speed_mph",
)


def valid_trips(staged: DataFrame, years: tuple[int, ...] | None = None) -> DataFrame:
    """Rows with no broken rule, whatever rules flagged them.

    `years` are those of the rules that flagged the rows, where they are known:
    then a pickup range that every valid row satisfies is added, which changes no
    result, but reaches the Parquet scan and prunes row groups.
    """
    kept = staged.filter(F.col("is_valid"))
    if years:
        at = F.col("pickup_at")
        start, stop = datetime(min(years), 1, 1), datetime(max(years) + 1, 1, 1)
        lower = F.lit(start.isoformat(" ")).cast("timestamp_ntz")
        upper = F.lit(stop.isoformat(" ")).cast("timestamp_ntz")
        kept = kept.filter(at.isNull() | ((at >= lower) & (at < upper)))
    return kept


def _zone_columns(zones: DataFrame, role: str) -> DataFrame:
    return zones.select(
        "location_id",
        F.col("borough").alias(f"{role}_borough"),
        F.col("zone_name").alias(f"{role}_zone_name"),
    )


def enrich_zone(trips: DataFrame, zones: DataFrame, role: str, **join) -> DataFrame:
    """Add borough and zone name for one role of the zone dimension."""
    return attach(
        trips, _zone_columns(zones, role), [(f"{role}_zone_id", "location_id")], **join
    )


def _with_hour(trips: DataFrame) -> DataFrame:
    return trips.withColumn("_pickup_hour_index", clock.hour_index(F.col("pickup_at")))


def enrich_weather(trips: DataFrame, weather: DataFrame, **join) -> DataFrame:
    """Exact match on the pickup's date and hour, compared as one long."""
    on = [("_pickup_hour_index", "_hour_index")]
    joined = attach(_with_hour(trips), _hourly_columns(weather), on, **join)
    return joined.drop("_pickup_hour_index")


def _hourly_columns(weather: DataFrame) -> DataFrame:
    return weather.select(
        clock.hour_index_of(F.col("weather_date"), F.col("weather_hour")).alias("_hour_index"),
        "weather_category", "is_adverse_weather",
        "temperature_f", "precipitation_inch", "wind_speed_mph",
    )


def derived_columns(trips: DataFrame) -> list[str]:
    """Those columns that `derive_trip_features` gives again, all or none of them."""
    own = trips.select("pickup_at", "dropoff_at")
    names = [c for c in conform.derive_trip_features(own).columns if c not in own.columns]
    if any(c not in trips.columns for c in names):
        return []
    kept = trips.select(*own.columns, *[F.col(c).alias(f"_{c}") for c in names])
    again = conform.derive_trip_features(kept)
    if any(again.schema[c].dataType != trips.schema[c].dataType for c in names):
        return []
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    return [] if again.filter(~reduce(lambda a, b: a & b, same)).take(1) else names


def _labelled(trips: DataFrame) -> DataFrame:
    trips = trips.withColumn("payment_type", money.payment_label(F.col("payment_type")))
    return trips.select(*[c for c in FACT_COLUMNS if c in trips.columns])


def fact_trips(
    staged: DataFrame,
    zones: DataFrame,
    weather: DataFrame,
    zones_small: bool | None = None,
    weather_small: bool | None = None,
    years: tuple[int, ...] | None = None,
    roles: tuple[str, ...] = ("pickup", "dropoff"),
) -> DataFrame:
    """Valid trips with both zone roles and the hour's weather: 35 columns.

    `zones_small` and `weather_small` choose the joins as in `attach`; `years`
    as in `valid_trips`. The heavy keys of all joins with large dimensions come from
    one scan of the valid trips.
    Demand reports never look at the dropoff zone. They can leave that role
    out and save a join per trip: an outer join on a key that is merely
    expected to be unique is not removed by the optimizer. Where zones are large they
    take `UnzonedTrips` instead.
    """
    if zones_small is None:
        zones_small = fits_broadcast(zones)  # one check for both roles
    if weather_small is None:
        weather_small = fits_broadcast(weather)
    trips = valid_trips(staged, years)
    joins = {} if zones_small else {role: [f"{role}_zone_id"] for role in roles}
    if not weather_small:
        joins["hour"] = ["_pickup_hour_index"]
    heavy, n_trips = counted_heavy_keys(_with_hour(trips), joins)
    # what isn't in the fact doesn't move, but for the keys
    trips = trips.select(*[c for c in FACT_COLUMNS if c in trips.columns])
    large = []
    if not zones_small:
        size = measured(zones)
        for role in roles:
            key = f"{role}_zone_id"
            named = _zone_columns(zones, role)
            large.append(Lookup(named, key, "location_id", heavy[role], *size))
    if not weather_small:
        hourly = _hourly_columns(weather)
        own = ("_pickup_hour_index", "_hour_index")
        large.append(Lookup(hourly, *own, heavy["hour"], *measured(hourly)))
    if large:
        known = derived_columns(trips)
        derive = conform.derive_trip_features if known else lambda df: df
        trips = attach_all(
            trips.drop(*known), large, n_trips, lambda df: _with_hour(derive(df))
        ).drop("_pickup_hour_index")
    if zones_small:
        for role in roles:
            trips = enrich_zone(trips, zones, role, small=True)
    if weather_small:
        trips = enrich_weather(trips, weather, small=True)
    return _labelled(trips)


@dataclass(frozen=True)
class UnzonedTrips:
    """Valid trips with their weather, and zones that are too many to be sent to them.

    Reports sum the trips to groups of zone and report keys first; only groups meet the
    zones (see `grouped_sums`).
    """

    trips: DataFrame
    zones: DataFrame

    def filter(self, condition: Column) -> UnzonedTrips:
        """Rows by columns that don't come from a zone."""
        return replace(self, trips=self.trips.filter(condition))


def unzoned_trips(
    staged: DataFrame,
    zones: DataFrame,
    weather: DataFrame,
    weather_small: bool | None = None,
    years: tuple[int, ...] | None = None,
) -> UnzonedTrips:
    """What `fact_trips` joins, with the zones still apart."""
    trips = enrich_weather(valid_trips(staged, years), weather, small=weather_small)
    return UnzonedTrips(_labelled(trips), zones)


def grouped_sums(
    frame: DataFrame | UnzonedTrips,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Sums of expressions over groups of the fact; `keep` filters by zone columns.

    From `UnzonedTrips`, trips are summed by zone and the other keys (map-side first), the
    groups are joined to the zones, and are summed again without the zone: trips are never
    shuffled. Only roles whose attributes are asked for are joined; there a zone that is listed
    twice counts its groups twice, as it would its trips.
    """
    if isinstance(frame, DataFrame):
        return keep(frame).groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    added = {
        role: [c for c in keys if c in (f"{role}_borough", f"{role}_zone_name")]
        for role in ("pickup", "dropoff")
    }
    roles = [role for role, columns in added.items() if columns]
    own = [c for c in keys if c not in added["pickup"] + added["dropoff"]]
    ids = [f"{role}_zone_id" for role in roles if f"{role}_zone_id" not in own]
    groups = frame.trips.groupBy(*own, *ids).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    done = list(own)
    for role in roles:
        named = _zone_columns(frame.zones, role).withColumnRenamed("location_id", "_zone")
        groups = groups.join(named, F.col(f"{role}_zone_id") == F.col("_zone"), "left")
        done += added[role]
        ids = [c for c in ids if c != f"{role}_zone_id"]
        if role == roles[-1]:
            groups = keep(groups)
        groups = groups.groupBy(*done, *ids).agg(*[F.sum(n).alias(n) for n in sums])
    return groups.select(*keys, *sums)
