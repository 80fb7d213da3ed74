"""Dashboard calculations. `demand` is the stored mart, the fact, or `UnzonedTrips`.

Ratios come back unrounded; rounding is left to whoever prints them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from hailmeter.functions import clock, money, sky
from hailmeter.operators.demand import Cell, average, grid, rollup
from hailmeter.operators.enrich import grouped_sums

YEARS = (2025, 2026)


def monthly_volume(demand: DataFrame) -> DataFrame:
    """Trips per borough, year and month, with the month's label."""
    return rollup(demand, ["pickup_borough", "pickup_year", "pickup_month"], ["trip_count"]).select(
        "pickup_borough",
        "pickup_year",
        "pickup_month",
        clock.month_label(F.col("pickup_month")).alias("month_label"),
        "trip_count",
    )


def weekpart_days(weather: DataFrame) -> DataFrame:
    """Distinct calendar days on weekdays and on weekends (two rows at most)."""
    weekend = clock.is_weekend(clock.day_of_week(F.col("weather_date")))
    return weather.groupBy(weekend.alias("is_weekend")).agg(
        F.countDistinct("weather_date").alias("days")
    )


def hourly_demand_weekpart(demand: DataFrame, weather: DataFrame) -> DataFrame:
    """Average trips per borough, hour and part of the week."""
    trips = rollup(demand, ["pickup_borough", "pickup_hour", "is_weekend"], ["trip_count"])
    return trips.join(F.broadcast(weekpart_days(weather)), "is_weekend").select(
        "pickup_borough",
        "pickup_hour",
        "is_weekend",
        "trip_count",
        (F.col("trip_count") / F.col("days")).alias("avg_trips"),
    )


def avg_trip_cost(demand: DataFrame, years: Sequence[int] = YEARS) -> DataFrame:
    """(revenue - tips) / trips per category, borough and year; 0 for an empty year."""
    measures = ["total_revenue", "total_tips", "trip_count"]
    groups = rollup(
        demand.filter(F.col("weather_category").isNotNull()),
        ["weather_category", "pickup_borough", "pickup_year"],
        measures,
    )
    cells = [
        Cell(
            {"pickup_year": year},
            {m: (m, F.col("pickup_year") == year) for m in measures},
        )
        for year in years
    ]
    return grid(groups, ["weather_category", "pickup_borough"], cells).select(
        "weather_category",
        "pickup_borough",
        "pickup_year",
        money.guarded_ratio(
            F.col("total_revenue") - F.col("total_tips"), F.col("trip_count")
        ).alias("avg_cost"),
    )


def exposure(
    demand: DataFrame,
    weather: DataFrame,
    measure: str,
    demand_keys: Sequence[str],
    weather_keys: dict[str, Column],
    cells: Sequence[tuple[dict[str, object], dict[str, tuple[Column, Column]]]],
) -> DataFrame:
    """Demand and exposure hours side by side, every borough x cell present.

    Numerators come from the trips, denominators from the rows of the weather
    table. Each cell is (labels, {condition: (trip filter, hour filter)}) and
    yields `<condition>_<measure>` and `<condition>_hours`. Trips shrink to
    `demand_keys` groups first; the hours side has one row per cell, so its
    broadcast is bounded by the cell list.
    """
    trips = rollup(demand, ["pickup_borough", *demand_keys], [measure])
    hours = weather.groupBy(*[c.alias(name) for name, c in weather_keys.items()]).agg(
        F.count(F.lit(1)).alias("hours")
    )
    trip_cells = [
        Cell(labels, {f"{name}_{measure}": (measure, pair[0]) for name, pair in parts.items()})
        for labels, parts in cells
    ]
    hour_cells = [
        Cell(labels, {f"{name}_hours": ("hours", pair[1]) for name, pair in parts.items()})
        for labels, parts in cells
    ]
    labels = list(cells[0][0])
    return grid(trips, ["pickup_borough"], trip_cells).join(
        F.broadcast(grid(hours, [], hour_cells)), labels
    )


def _per_hour(name: str, measure: str) -> Column:
    return money.guarded_ratio(F.col(f"{name}_{measure}"), F.col(f"{name}_hours"))


def _hour_keys() -> dict[str, Column]:
    return {
        "pickup_year": F.year("weather_date"),
        "is_night": clock.is_night(F.col("weather_hour")),
        "is_adverse_weather": F.col("is_adverse_weather"),
    }


def adverse_demand_change(
    demand: DataFrame, weather: DataFrame, years: Sequence[int] = YEARS
) -> DataFrame:
    """% change of trips per hour, adverse against not adverse hours.

    One row per borough, year and scope (all, day, night); 0 where a borough
    or year has no basis.
    """
    year, night, adverse = F.col("pickup_year"), F.col("is_night"), F.col("is_adverse_weather")
    scopes = {"all": F.lit(True), "day": ~night, "night": night}
    cells = []
    for y in years:
        for scope, inside in scopes.items():
            bad = (year == y) & inside & adverse
            calm = (year == y) & inside & ~adverse
            cells.append(
                (
                    {"pickup_year": y, "scope": scope},
                    {"adverse": (bad, bad), "clear": (calm, calm)},
                )
            )
    table = exposure(
        demand,
        weather,
        "trip_count",
        ["pickup_year", "is_night", "is_adverse_weather"],
        _hour_keys(),
        cells,
    )
    return table.select(
        "pickup_borough",
        "pickup_year",
        "scope",
        "adverse_trip_count",
        "adverse_hours",
        "clear_trip_count",
        "clear_hours",
        money.pct_change(_per_hour("adverse", "trip_count"), _per_hour("clear", "trip_count")).alias(
            "pct_change"
        ),
    )


def weather_type_demand_change(
    demand: DataFrame,
    weather: DataFrame,
    years: Sequence[int] = YEARS,
    types: Sequence[str] = ("Rain", "Snow"),
    baseline: str = "Clear",
) -> DataFrame:
    """% change of trips per hour, each weather type against the clear category."""
    year, kind = F.col("pickup_year"), F.col("weather_category")
    cells = []
    for y in years:
        for t in types:
            hit, base = (year == y) & (kind == t), (year == y) & (kind == baseline)
            cells.append(
                ({"pickup_year": y, "weather_type": t}, {"type": (hit, hit), "clear": (base, base)})
            )
    table = exposure(
        demand,
        weather,
        "trip_count",
        ["pickup_year", "weather_category"],
        {"pickup_year": F.year("weather_date"), "weather_category": kind},
        cells,
    )
    return table.select(
        "pickup_borough",
        "pickup_year",
        "weather_type",
        money.pct_change(_per_hour("type", "trip_count"), _per_hour("clear", "trip_count")).alias(
            "pct_change"
        ),
    )


def adverse_revenue_delta(
    demand: DataFrame,
    weather: DataFrame,
    years: Sequence[int] = YEARS,
    strict: bool = False,
) -> DataFrame:
    """Revenue per adverse hour minus revenue per clear hour, rush and off-peak.

    The trips' rush flag covers weekdays only, while the hours counted as rush
    are 7, 8, 17 and 18 of every day. `strict` takes weekday hours only on
    both sides.
    """
    rush_hour = F.col("weather_hour").isin(*clock.RUSH_HOURS)
    if strict:
        rush_hour = clock.is_rush_hour(
            clock.day_of_week(F.col("weather_date")), F.col("weather_hour")
        )
    year, rush, adverse = F.col("pickup_year"), F.col("is_rush_hour"), F.col("is_adverse_weather")
    cells = []
    for y in years:
        for period, inside in (("Rush Hour", rush), ("Off-Peak", ~rush)):
            bad = (year == y) & inside & adverse
            calm = (year == y) & inside & ~adverse
            cells.append(
                (
                    {"pickup_year": y, "period": period},
                    {"adverse": (bad, bad), "clear": (calm, calm)},
                )
            )
    table = exposure(
        demand,
        weather,
        "total_revenue",
        ["pickup_year", "is_rush_hour", "is_adverse_weather"],
        {
            "pickup_year": F.year("weather_date"),
            "is_rush_hour": rush_hour,
            "is_adverse_weather": adverse,
        },
        cells,
    )
    return table.select(
        "pickup_borough",
        "pickup_year",
        "period",
        (_per_hour("adverse", "total_revenue") - _per_hour("clear", "total_revenue")).alias("delta"),
    )


def rush_revenue_swing(
    demand: DataFrame, weather: DataFrame, years: tuple[int, int] = YEARS, strict: bool = False
) -> DataFrame:
    """Change of the revenue delta from the first year to the second."""
    delta = adverse_revenue_delta(demand, weather, years, strict)
    first, second = (
        F.sum(F.when(F.col("pickup_year") == y, F.col("delta"))) for y in years
    )
    return delta.groupBy("pickup_borough", "period").agg(
        first.alias("first_delta"), second.alias("second_delta"), (second - first).alias("swing")
    )


def borough_share_shift(demand: DataFrame, years: Sequence[int] = YEARS) -> DataFrame:
    """A borough's share of adverse trips minus its share of the other trips.

    In percentage points, per year. The definition is inferred: the finding is
    published without its query.
    """
    year, adverse = F.col("pickup_year"), F.col("is_adverse_weather")
    groups = rollup(
        demand, ["pickup_borough", "pickup_year", "is_adverse_weather"], ["trip_count"]
    )
    cells = [
        Cell(
            {"pickup_year": y},
            {
                "adverse_trips": ("trip_count", (year == y) & adverse),
                "clear_trips": ("trip_count", (year == y) & ~adverse),
            },
        )
        for y in years
    ]
    # At most boroughs x years rows reach the window.
    whole = Window.partitionBy("pickup_year")

    def share(name: str) -> Column:
        return money.guarded_ratio(F.col(name), F.sum(name).over(whole)) * 100

    return grid(groups, ["pickup_borough"], cells).select(
        "pickup_borough",
        "pickup_year",
        share("adverse_trips").alias("adverse_share"),
        share("clear_trips").alias("clear_share"),
        (share("adverse_trips") - share("clear_trips")).alias("shift_pp"),
    )


def yoy_change(
    demand: DataFrame, keys: Sequence[str] = ("pickup_borough",), years: tuple[int, int] = YEARS
) -> DataFrame:
    """Trips of both years and the change in percent."""
    groups = rollup(demand, [*keys, "pickup_year"], ["trip_count"])
    before, after = (
        F.coalesce(F.sum(F.when(F.col("pickup_year") == y, F.col("trip_count"))), F.lit(0))
        for y in years
    )
    return groups.groupBy(*keys).agg(
        before.alias("first_trips"),
        after.alias("second_trips"),
        money.pct_change(after, before).alias("pct_change"),
    )


def pickup_flows(fact: DataFrame) -> DataFrame:
    """Trips and revenue from borough to borough; unknown zones stay as NULL."""
    sums = {"trip_count": F.lit(1).cast("bigint"), "total_revenue": F.col("total_amount")}
    return grouped_sums(fact, ["pickup_borough", "dropoff_borough"], sums)


def domain_values(df: DataFrame, column: str) -> DataFrame:
    """The sorted distinct values a selector offers; NULL is not offered."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def filter_dimensions(df: DataFrame, chosen: dict[str, Sequence]) -> DataFrame:
    """Keep rows whose columns hold one of the chosen values."""
    for column, values in chosen.items():
        df = df.filter(F.col(column).isin(*values))
    return df


# --- documented analyses ------------------------------------------------------

CONDITIONS = ("Clear/Normal", "Rain", "Snow")


def revenue_per_active_minute(demand: DataFrame) -> DataFrame:
    """Tip-free revenue per trip over average duration, by borough and condition.

    The average leaves unknown durations out, so it is their total over the number
    of known ones (see `as_demand`).
    """
    measures = ("total_revenue", "total_tips", "trip_count", "duration_total", "known_durations")
    groups = rollup(
        demand,
        ["pickup_borough", "weather_category"],
        measures,
    ).withColumn("condition", sky.condition_bucket(F.col("weather_category")))
    cells = [
        Cell({"condition": c}, {m: (m, F.col("condition") == c) for m in measures})
        for c in CONDITIONS
    ]
    rate = money.guarded_ratio(
        money.guarded_ratio(F.col("total_revenue") - F.col("total_tips"), F.col("trip_count")),
        F.col("duration_total") / F.nullif(F.col("known_durations"), F.lit(0)),
    )
    per_borough = Window.partitionBy("pickup_borough")
    normal = F.max(F.when(F.col("condition") == CONDITIONS[0], F.col("per_minute"))).over(
        per_borough
    )
    return (
        grid(groups, ["pickup_borough"], cells)
        .select("pickup_borough", "condition", rate.alias("per_minute"))
        .withColumn("pct_vs_normal", money.pct_change(F.col("per_minute"), normal))
    )


def trips_per_hour(demand: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips per exposure hour and tip-free fare, by borough and condition."""
    bucket = sky.condition_bucket(F.col("weather_category"))
    trips = rollup(
        demand,
        ["pickup_borough", "weather_category"],
        ["trip_count", "total_revenue", "total_tips"],
    ).withColumn("condition", bucket)
    hours = weather.groupBy("weather_category").agg(F.count(F.lit(1)).alias("hours"))
    hours = hours.withColumn("condition", bucket)
    measures = ("trip_count", "total_revenue", "total_tips")
    trip_cells = [
        Cell({"condition": c}, {m: (m, F.col("condition") == c) for m in measures})
        for c in CONDITIONS
    ]
    hour_cells = [
        Cell({"condition": c}, {"hours": ("hours", F.col("condition") == c)}) for c in CONDITIONS
    ]
    per_borough = Window.partitionBy("pickup_borough")
    normal = F.max(F.when(F.col("condition") == CONDITIONS[0], F.col("trips_per_hour"))).over(
        per_borough
    )
    return (
        grid(trips, ["pickup_borough"], trip_cells)
        .join(F.broadcast(grid(hours, [], hour_cells)), "condition")
        .select(
            "pickup_borough",
            "condition",
            "hours",
            money.guarded_ratio(F.col("trip_count"), F.col("hours")).alias("trips_per_hour"),
            money.guarded_ratio(
                F.col("total_revenue") - F.col("total_tips"), F.col("trip_count")
            ).alias("avg_fare"),
        )
        .withColumn("pct_vs_normal", money.pct_change(F.col("trips_per_hour"), normal))
    )


def weather_hour_share(weather: DataFrame) -> DataFrame:
    """Hours per condition and their share of all hours."""
    counts = weather.groupBy(
        sky.condition_bucket(F.col("weather_category")).alias("condition")
    ).agg(F.count(F.lit(1)).alias("hours"))
    total = F.sum("hours").over(Window.partitionBy())  # a handful of rows
    return counts.withColumn("pct", F.col("hours") * 100 / total)


def trip_shape_by_condition(fact: DataFrame) -> DataFrame:
    """Average duration and distance per borough, year and adverse flag."""
    keys = ["pickup_borough", "pickup_year", "is_adverse_weather"]
    measures = ["duration_total", "known_durations", "distance_total", "known_distances"]
    return rollup(fact, keys, measures).select(
        *keys,
        average("duration_total", "known_durations").alias("avg_duration"),
        average("distance_total", "known_distances").alias("avg_distance"),
    )


def longest_run(weather: DataFrame, category: str = "Snow") -> DataFrame:
    """Longest stretch of consecutive hours of one category, per year.

    Gaps and islands: within a run, the hour minus its row number is constant.
    Doubled hours count once.
    """
    at = F.col("datetime_local")
    hits = (
        weather.filter(F.col("weather_category") == category)
        .select(F.year(at).alias("weather_year"), at)
        .distinct()
    )
    ordered = Window.partitionBy("weather_year").orderBy("datetime_local")
    island = at - F.make_dt_interval(hours=F.row_number().over(ordered))
    return (
        hits.withColumn("island", island)
        .groupBy("weather_year", "island")
        .agg(F.count(F.lit(1)).alias("hours"))
        .groupBy("weather_year")
        .agg(F.max("hours").alias("longest_hours"))
    )


def storm_severity(weather: DataFrame) -> DataFrame:
    """Snow and rain load per year, including the longest snow stretch.

    Snow depth is averaged over snow hours, rain intensity over rain hours.
    """
    kind, month = F.col("weather_category"), F.month("datetime_local")
    snow, rain = kind == "Snow", kind == "Rain"
    loads = weather.groupBy(F.year("datetime_local").alias("weather_year")).agg(
        F.count_if(snow).alias("snow_hours"),
        F.sum("snowfall_inch").alias("total_snowfall"),
        F.avg(F.when(snow, F.col("snow_depth_inch"))).alias("avg_snow_depth"),
        F.max(F.when(snow, F.col("snow_depth_inch"))).alias("max_snow_depth"),
        F.count_if(snow & (month == 1)).alias("january_snow_hours"),
        F.count_if(snow & (month == 3)).alias("march_snow_hours"),
        F.count_if(rain).alias("rain_hours"),
        F.avg(F.when(rain, F.col("rain_inch"))).alias("rain_intensity"),
        F.sum("rain_inch").alias("total_rainfall"),
    )
    return loads.join(longest_run(weather), "weather_year", "left").withColumn(
        "longest_hours", F.coalesce("longest_hours", F.lit(0).cast("bigint"))
    )


def storm_severity_change(weather: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """The severity table turned around: one row per metric, both years, change."""
    severity = storm_severity(weather)
    metrics = [c for c in severity.columns if c != "weather_year"]
    tall = severity.select(
        "weather_year",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                    for m in metrics
                ]
            )
        ),
    )
    before, after = (F.max(F.when(F.col("weather_year") == y, F.col("value"))) for y in years)
    return tall.groupBy("metric").agg(
        before.alias("first_value"),
        after.alias("second_value"),
        money.pct_change(after, before).alias("pct_change"),
    )
