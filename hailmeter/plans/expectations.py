"""Declarative table checks, each answered by a count of failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailmeter.functions import sky


class ExpectationError(AssertionError):
    """Raised when a check of severity `error` has failures."""


@dataclass(frozen=True)
class Expectation:
    """`kind` is not_null, unique, accepted_values or relationship.

    `values` belongs to accepted_values; `parent` = (table, column) to
    relationship. NULL passes every kind but not_null.
    """

    table: str
    column: str
    kind: str
    severity: str = "error"
    values: tuple = ()
    parent: tuple[str, str] | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.table}.{self.column}"


def _not_null(table: str, *columns: str) -> list[Expectation]:
    return [Expectation(table, c, "not_null") for c in columns]


FEEDS = ("yellow", "green")
DOCUMENTED_PAYMENTS = (1, 2, 3, 4, 5, 6)

SUITE: list[Expectation] = [
    # bronze
    Expectation("zone_lookup", "LocationID", "unique"),
    *_not_null("zone_lookup", "LocationID"),
    # silver
    *_not_null("stg_trips", "taxi_type", "pickup_at", "dropoff_at", "is_valid"),
    Expectation("stg_trips", "taxi_type", "accepted_values", values=FEEDS),
    Expectation(
        "stg_trips", "payment_type", "accepted_values", "warn", values=DOCUMENTED_PAYMENTS
    ),
    Expectation(
        "stg_trips", "pickup_zone_id", "relationship", "warn", parent=("zone_lookup", "LocationID")
    ),
    Expectation("stg_zones", "location_id", "unique"),
    *_not_null("stg_zones", "location_id", "borough"),
    *_not_null("stg_weather", "weather_date", "weather_hour", "weather_category"),
    Expectation("stg_weather", "weather_category", "accepted_values", values=sky.CATEGORIES),
    # gold
    *_not_null("fct_trips", "pickup_at", "taxi_type", "total_amount"),
    Expectation("fct_trips", "pickup_borough", "not_null", "warn"),
    Expectation("fct_trips", "taxi_type", "accepted_values", values=FEEDS),
    Expectation(
        "fct_trips", "pickup_zone_id", "relationship", "warn", parent=("dim_zones", "location_id")
    ),
    *_not_null(
        "mart_weather_demand", "pickup_borough", "pickup_year", "trip_count", "total_revenue"
    ),
    Expectation("dim_zones", "location_id", "unique"),
    *_not_null("dim_zones", "location_id", "borough"),
    *_not_null("dim_weather", "weather_date", "weather_hour", "weather_category"),
]

# Not in the original suite: a doubled hour would fan trips out.
HOUR_IS_UNIQUE = Expectation("dim_weather", "weather_date,weather_hour", "unique")


def not_null_failures(column: str) -> Column:
    """Rows without a value."""
    return F.count_if(F.col(column).isNull())


def accepted_values_failures(column: str, values: Sequence) -> Column:
    """Rows whose value is known and not listed."""
    return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def unique_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: keys that occur more than once."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return (
        df.filter(present)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.count_if(F.col("copies") > 1).alias("failures"))
    )


def relationship_failures(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """One row: child rows whose key has no parent.

    Child rows shrink to one per key before the join, so a hot key is one row
    by then.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    parents = parent.select(F.col(parent_column).alias("_key")).distinct()
    orphans = keys.join(parents, "_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("copies"), F.lit(0).cast("bigint")).alias("failures"))


def _is_rowwise(check: Expectation) -> bool:
    return check.kind in ("not_null", "accepted_values")


def _failures(check: Expectation) -> Column:
    if check.kind == "not_null":
        return not_null_failures(check.column)
    return accepted_values_failures(check.column, check.values)


def rowwise_metrics(suite: Sequence[Expectation], table: str) -> dict[str, Column]:
    """The row-wise checks of a table as aggregates, for whoever passes over its rows."""
    return {e.name: _failures(e) for e in suite if e.table == table and _is_rowwise(e)}


def run_expectations(
    tables: Mapping[str, DataFrame],
    suite: Sequence[Expectation] = tuple(SUITE),
    counted: Mapping[str, int] | None = None,
) -> DataFrame:
    """(name, failures, severity, status) per check.

    All row-wise checks of a table share one scan of it; the scan is unfolded
    into one result row per check. `counted` has the failures of checks that were
    observed while a table was written: those scan nothing.
    """
    results = []
    seen = counted or {}
    rows = [(e.name, int(seen[e.name]), e.severity) for e in suite if e.name in seen]
    if rows:
        spark = next(iter(tables.values())).sparkSession
        results.append(spark.createDataFrame(rows, "name string, failures long, severity string"))
    suite = [e for e in suite if e.name not in seen]
    for table in dict.fromkeys(e.table for e in suite):
        own = [e for e in suite if e.table == table]
        rowwise = [e for e in own if _is_rowwise(e)]
        if rowwise:
            results.append(_one_scan(tables[table], rowwise))
        for check in own:
            if check.kind == "unique":
                counted = unique_failures(tables[table], check.column.split(","))
            elif check.kind == "relationship":
                parent, parent_column = check.parent
                counted = relationship_failures(
                    tables[table], check.column, tables[parent], parent_column
                )
            else:
                continue
            results.append(
                counted.select(
                    F.lit(check.name).alias("name"),
                    "failures",
                    F.lit(check.severity).alias("severity"),
                )
            )
    status = F.when(F.col("failures") == 0, "pass").when(
        F.col("severity") == "warn", "warn"
    )
    return reduce(DataFrame.unionByName, results).withColumn("status", status.otherwise("fail"))


def _one_scan(df: DataFrame, checks: Sequence[Expectation]) -> DataFrame:
    counted = df.agg(
        *[_failures(c).alias(f"_c{i}") for i, c in enumerate(checks)]
    )
    rows = [
        F.struct(
            F.lit(c.name).alias("name"),
            F.col(f"_c{i}").alias("failures"),
            F.lit(c.severity).alias("severity"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def enforce(results: DataFrame) -> DataFrame:
    """Raise when a check failed; warnings pass. Reads one row per check."""
    failed = results.filter(F.col("status") == "fail").collect()
    if failed:
        raise ExpectationError(
            "; ".join(f"{row['name']}: {row['failures']} failures" for row in failed)
        )
    return results


@dataclass(frozen=True)
class RowGate:
    """Smallest acceptable row count per table."""

    minimum: dict[str, int] = field(default_factory=dict)

    def check(self, counts: DataFrame) -> DataFrame:
        """Label each count of `table_counts`; a table without a gate passes."""
        pairs = [F.lit(x) for item in self.minimum.items() for x in item]
        least = F.lit(0)
        if pairs:
            least = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("table_name")), F.lit(0))
        return counts.select(
            "table_name",
            "row_count",
            least.cast("bigint").alias("minimum"),
            (F.col("row_count") >= least).alias("passed"),
        )

    def enforce(self, counts: DataFrame) -> list:
        """Raise on the first table that is too small; returns the counts."""
        rows = self.check(counts).collect()
        for row in rows:
            if not row["passed"]:
                raise ExpectationError(
                    f"{row['table_name']}: {row['row_count']} rows, expected {row['minimum']}"
                )
        return rows


# Gates of a full production load.
PRODUCTION_GATE = RowGate(
    {
        "yellow_raw": 38_000_000,
        "green_raw": 400_000,
        "zone_lookup": 265,
        "weather_hourly": 7_000,
    }
)
