"""Counts, audits and reconciliations over bronze, silver and gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from hailmeter.functions import money, rules
from hailmeter.operators.enrich import enrich_weather


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled row count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def pickup_range(feeds: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Earliest and latest timestamp and number of years, per feed."""
    ranges = [
        df.agg(
            F.min(column).alias("earliest"),
            F.max(column).alias("latest"),
            F.countDistinct(F.year(column)).alias("distinct_years"),
        ).select(F.lit(name).alias("feed"), "earliest", "latest", "distinct_years")
        for name, (df, column) in feeds.items()
    ]
    return reduce(DataFrame.unionByName, ranges)


def weather_hours_by_year(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy(F.year("datetime_local").alias("yr"))
        .agg(F.count(F.lit(1)).alias("hours"))
        .orderBy("yr")
    )


def trips_by(staged: DataFrame, *keys: str) -> DataFrame:
    """Trips per key, ordered by the keys."""
    return staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips")).orderBy(*keys)


def validity_share(staged: DataFrame) -> DataFrame:
    """Valid and invalid rows and their percentage."""
    counts = staged.groupBy("is_valid").agg(F.count(F.lit(1)).alias("row_count"))
    total = F.sum("row_count").over(Window.partitionBy())  # two rows
    return counts.withColumn("pct", F.round(F.col("row_count") * 100.0 / total, 2))


def dq_reason_topk(staged: DataFrame, k: int = 20) -> DataFrame:
    """The most frequent reason strings; ties break by the string."""
    return (
        staged.filter(~F.col("is_valid"))
        .groupBy("dq_flag_reason")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), "dq_flag_reason")
        .limit(k)
    )


def dq_rule_counts(staged: DataFrame, checks: list[rules.Rule] | None = None) -> DataFrame:
    """Rows per single rule, in one pass; a row may break several."""
    checks = checks or rules.trip_rules()
    counts = staged.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(rule.broken).alias(rule.name) for rule in checks],
    )
    rows = [
        F.struct(
            F.lit(rule.name).alias("rule_name"),
            F.col(rule.name).alias("row_count"),
            money.guarded_ratio(F.col(rule.name) * 100, F.col("_all")).alias("pct"),
        )
        for rule in checks
    ]
    return counts.select(F.inline(F.array(*rows)))


def no_passengers() -> Column:
    return F.col("passenger_count").isNull() | (F.col("passenger_count") == 0)


def very_long(minutes: int = 240) -> Column:
    return F.col("trip_duration_minutes") > minutes


def very_short() -> Column:
    return (F.col("trip_duration_minutes") >= 0) & (F.col("trip_duration_minutes") < 1)


def free_distance(fare_over: float = 5.0) -> Column:
    return (F.col("trip_distance") == 0) & (F.col("fare_amount") > fare_over)


def dq_exploratory_counts(staged: DataFrame) -> DataFrame:
    """The four unflagged oddities, counted in one pass."""
    return staged.agg(
        F.count_if(no_passengers()).alias("zero_or_null_passengers"),
        F.count_if(very_long()).alias("very_long_trips"),
        F.count_if(very_short()).alias("very_short_trips"),
        F.count_if(free_distance()).alias("zero_dist_with_fare"),
    )


def catch_all_zones(zones: DataFrame, ids: Sequence[int] = (264, 265)) -> DataFrame:
    """The zones that stand for an unknown place."""
    return zones.filter(F.col("location_id").isin(*ids))


def layer_reconciliation(yellow: DataFrame, green: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze against silver in one row; the difference should be 0."""
    counts = table_counts({"yellow": yellow, "green": green, "silver": silver})

    def of(name: str) -> Column:
        return F.sum(F.when(F.col("table_name") == name, F.col("row_count")))

    expected = of("yellow") + of("green")
    return counts.agg(
        of("yellow").alias("bronze_yellow"),
        of("green").alias("bronze_green"),
        of("silver").alias("silver_total"),
        expected.alias("expected_total"),
        (of("silver") - expected).alias("difference"),
    )


def _gap(tolerance: float) -> tuple[Column, Column]:
    gap = F.round(money.total_gap(), 2)
    return gap, F.abs(money.total_gap()) > tolerance


def total_mismatch(fact: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Rows whose total is not the sum of its components, and their share."""
    _, off = _gap(tolerance)
    return fact.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(off).alias("mismatched"),
    ).withColumn("pct", money.guarded_ratio(F.col("mismatched") * 100, F.col("row_count")))


def top_gaps(fact: DataFrame, k: int = 10, tolerance: float = 0.005) -> DataFrame:
    """The most frequent gaps between total and components."""
    gap, off = _gap(tolerance)
    return (
        fact.filter(off)
        .groupBy(gap.alias("gap"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy(F.desc("trips"), "gap")
        .limit(k)
    )


def surcharge_by_month(fact: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Per month and feed: how many totals leave out a fee, and the mean gap."""
    _, off = _gap(tolerance)
    gap = money.total_gap()
    return fact.groupBy("taxi_type", "pickup_year", "pickup_month").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(off).alias("mismatched"),
        F.avg(F.when(off, gap)).alias("avg_gap"),
        (F.count_if(off) / F.count(F.lit(1))).alias("mismatched_share"),
    )


def unknown_payment_profile(staged: DataFrame) -> DataFrame:
    """Undocumented type 0 by year: rows, share, mean total against cards."""
    code, total = F.col("payment_type"), F.col("total_amount")
    return staged.groupBy("pickup_year").agg(
        F.count_if(code == 0).alias("type0_trips"),
        (F.count_if(code == 0) * 100 / F.count(F.lit(1))).alias("type0_pct"),
        F.avg(F.when(code == 0, total)).alias("type0_avg_total"),
        F.avg(F.when(code == 1, total)).alias("card_avg_total"),
    )


def payment0_by_vendor(staged: DataFrame) -> DataFrame:
    """Does type 0 come from one vendor?"""
    zero = F.col("payment_type") == 0
    return staged.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(zero).alias("type0_trips"),
        (F.count_if(zero) * 100 / F.count(F.lit(1))).alias("type0_pct"),
    )


def tip_audit(fact: DataFrame) -> DataFrame:
    """Average tip and zero-tip trips per payment label."""
    tip = F.col("tip_amount")
    return fact.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("trips"),
        F.avg(tip).alias("avg_tip"),
        F.count_if(tip == 0).alias("zero_tip_trips"),
    )


def left_in_defects(fact: DataFrame) -> DataFrame:
    """Oddities kept in the fact: one row per defect."""
    borough, total = F.col("pickup_borough"), F.col("total_amount")
    defects = {
        "zero_distance_with_fare": (F.col("trip_distance") == 0) & (F.col("fare_amount") > 0),
        "zero_total": total == 0,
        "zero_total_no_charge_or_dispute": (total == 0)
        & F.col("payment_type").isin("No Charge", "Dispute"),
        "unknown_borough": borough.isNull() | borough.isin("Unknown", "N/A"),
        "airport_outside_city": borough == "EWR",
    }
    counts = fact.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(condition).alias(name) for name, condition in defects.items()],
    )
    rows = [
        F.struct(
            F.lit(name).alias("defect"),
            F.col(name).alias("trips"),
            money.guarded_ratio(F.col(name) * 100, F.col("_all")).alias("pct"),
        )
        for name in defects
    ]
    return counts.select(F.inline(F.array(*rows)))


def zero_totals_by_payment(fact: DataFrame) -> DataFrame:
    """Trips and zero totals per payment label."""
    zero = F.col("total_amount") == 0
    return fact.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(zero).alias("zero_total_trips"),
        (F.count_if(zero) * 100 / F.count(F.lit(1))).alias("zero_total_pct"),
    )


DUPLICATE_KEYS = ("pickup_at", "pickup_zone_id", "dropoff_zone_id", "fare_amount")


def duplicate_trips(staged: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS) -> DataFrame:
    """Key groups that hold more than one trip; NULL keys group together."""
    return (
        staged.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def drop_duplicate_trips(staged: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS) -> DataFrame:
    """One trip per key: of several, the least by all other columns in order.

    So the surviving row doesn't depend on how the input lies. Copies collapse map-side
    before the shuffle.
    """
    others = [c for c in staged.columns if c not in keys]
    least = F.min(F.struct(*others)).alias("_least")
    return staged.groupBy(*keys).agg(least).select(*keys, "_least.*").select(*staged.columns)


def invalid_share_by_weather(
    staged: DataFrame, weather: DataFrame, small: bool | None = None
) -> DataFrame:
    """Is exclusion related to the weather? Invalid share per adverse flag."""
    joined = enrich_weather(staged, weather, small=small)
    invalid = F.when(~F.col("is_valid"), 1.0).otherwise(0.0)
    return joined.groupBy("is_adverse_weather").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(~F.col("is_valid")).alias("invalid_trips"),
        F.avg(invalid).alias("invalid_share"),
    )


def weather_match(fact: DataFrame) -> DataFrame:
    """How many fact rows found their hour."""
    matched = F.count("weather_category")
    return fact.agg(
        F.count(F.lit(1)).alias("trips"),
        matched.alias("matched"),
        money.guarded_ratio(matched * 100, F.count(F.lit(1))).alias("match_pct"),
    )
