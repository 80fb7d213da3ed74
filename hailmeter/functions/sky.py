"""Weather code labels, categories and the adverse flag."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# WMO code -> description.
DESCRIPTIONS = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Foggy",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    56: "Light freezing drizzle",
    57: "Dense freezing drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    66: "Light freezing rain",
    67: "Heavy freezing rain",
    71: "Slight snowfall",
    73: "Moderate snowfall",
    75: "Heavy snowfall",
    77: "Snow grains",
    80: "Slight rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    85: "Slight snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm with slight hail",
    99: "Thunderstorm with heavy hail",
}

# Category, lowest code, highest code (both included).
CATEGORY_BANDS = (
    ("Clear", 0, 1),
    ("Cloudy", 2, 3),
    ("Fog", 45, 45),
    ("Fog", 48, 48),
    ("Drizzle", 51, 57),
    ("Rain", 61, 67),
    ("Snow", 71, 77),
    ("Rain Showers", 80, 82),
    ("Snow Showers", 85, 86),
    ("Thunderstorm", 95, 99),
)
OTHER_CATEGORY = "Other"
CATEGORIES = tuple(dict.fromkeys(band[0] for band in CATEGORY_BANDS)) + (OTHER_CATEGORY,)

ADVERSE_FROM_CODE = 61
ADVERSE_SNOWFALL = 0.0
ADVERSE_WIND = 25.0

# Three baselines the reports compare against.
NORMAL_CATEGORIES = ("Clear", "Cloudy", "Drizzle")


def description(code: Column) -> Column:
    pairs = [F.lit(x) for item in DESCRIPTIONS.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit("Unknown"))


def category(code: Column) -> Column:
    first, *rest = CATEGORY_BANDS
    start = F.when(code.between(first[1], first[2]), first[0])
    chain = reduce(lambda acc, band: acc.when(code.between(band[1], band[2]), band[0]), rest, start)
    return chain.otherwise(OTHER_CATEGORY)


def is_adverse(
    code: Column,
    snowfall: Column,
    wind: Column,
    from_code: int = ADVERSE_FROM_CODE,
    snowfall_over: float = ADVERSE_SNOWFALL,
    wind_over: float = ADVERSE_WIND,
) -> Column:
    """Any one known term is enough; with no known term the hour is not adverse."""
    hit = (code >= from_code) | (snowfall > snowfall_over) | (wind > wind_over)
    return F.when(hit, True).otherwise(False)


def condition_bucket(weather_category: Column) -> Column:
    """Clear/Normal, Rain, Snow; the remaining categories stay visible as Other."""
    return (
        F.when(weather_category.isin(*NORMAL_CATEGORIES), "Clear/Normal")
        .when(weather_category.isin("Rain", "Snow"), weather_category)
        .when(weather_category.isNotNull(), "Other")
    )
