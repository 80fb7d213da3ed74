"""Quality rules of a trip: one ordered list feeds the flag and the reason."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

VALID_YEARS = (2025, 2026)
VALID_MONTHS = (1, 5)
MAX_DISTANCE = 100.0
REASON_SEPARATOR = ", "


@dataclass(frozen=True)
class Rule:
    """`broken` is true for a bad row; unknown means the rule does not apply."""

    name: str
    broken: Column


def trip_rules(
    years: tuple[int, ...] = VALID_YEARS,
    months: tuple[int, int] = VALID_MONTHS,
    max_distance: float = MAX_DISTANCE,
) -> list[Rule]:
    distance = F.col("trip_distance")
    return [
        Rule("dropoff_before_pickup", F.col("trip_duration_minutes") < 0),
        Rule("negative_fare", F.col("fare_amount") < 0),
        Rule("negative_total", F.col("total_amount") < 0),
        Rule("negative_distance", distance < 0),
        Rule("extreme_distance", distance > max_distance),
        Rule("out_of_range_year", ~F.col("pickup_year").isin(*years)),
        Rule("out_of_range_month", ~F.col("pickup_month").between(*months)),
    ]


def is_valid(rules: list[Rule]) -> Column:
    """False only where some rule is known to be broken."""
    any_broken = reduce(lambda a, b: a | b, [rule.broken for rule in rules])
    return F.when(any_broken, False).otherwise(True)


def flag_reason(rules: list[Rule]) -> Column:
    """Every broken rule in list order; the empty string for a clean row."""
    return F.concat_ws(REASON_SEPARATOR, *[F.when(rule.broken, rule.name) for rule in rules])
