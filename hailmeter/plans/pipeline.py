"""Landing files to gold tables in one idempotent run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailmeter import schemas
from hailmeter.functions import rules
from hailmeter.operators import conform
from hailmeter.operators.demand import mart_weather_demand
from hailmeter.operators.enrich import fact_trips
from hailmeter.plans.expectations import (
    SUITE,
    RowGate,
    enforce,
    rowwise_metrics,
    run_expectations,
)
from hailmeter.plans.quality import table_counts
from hailmeter.session import pin_clock
from hailmeter.sources.files import flatten_hourly_json, scan_trip_files, scan_zone_csv
from hailmeter.sources.tables import publish_table, write_observed


@dataclass(frozen=True)
class Landing:
    """Folders (or files) of the four sources."""

    yellow: str
    green: str
    zones: str
    weather: str


@dataclass(frozen=True)
class Settings:
    """Knobs of a run; the defaults are the published rules."""

    gate: RowGate = field(default_factory=RowGate)
    years: tuple[int, ...] = rules.VALID_YEARS
    months: tuple[int, int] = rules.VALID_MONTHS
    max_distance: float = rules.MAX_DISTANCE
    # Shuffle the fact into even files per month; not needed when the landed
    # files are already monthly.
    rebalance: bool = False
    # Skip unreadable Parquet files instead of stopping. A storage hiccup looks
    # like a corrupt file, so compare with `load_history_parquet` afterwards.
    skip_unreadable: bool = False


LAYERS = {
    "yellow_raw": "bronze",
    "green_raw": "bronze",
    "zone_lookup": "bronze",
    "weather_hourly": "bronze",
    "stg_trips": "silver",
    "stg_zones": "silver",
    "stg_weather": "silver",
    "fct_trips": "gold",
    "mart_weather_demand": "gold",
    "dim_zones": "gold",
    "dim_weather": "gold",
}


def run_pipeline(
    spark: SparkSession, landing: Landing, out: str, settings: Settings = Settings()
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(stored tables, layer summary, test results); stops at the first failure.

    Every table is written once and read back, so nothing downstream repeats
    upstream work. Row counts and row-wise checks are observed by the tasks that write.
    Rerunning publishes new versions of the tables (see `publish_table`).
    """
    pin_clock(spark)
    tables: dict[str, DataFrame] = {}
    counts: dict[str, int] = {}
    failures: dict[str, int] = {}

    def store(name: str, df: DataFrame, **options) -> DataFrame:
        metrics = {"row_count": F.count(F.lit(1)), **rowwise_metrics(SUITE, name)}
        tables[name], seen = write_observed(
            df, f"{out}/{LAYERS[name]}/{name}", metrics, **options
        )
        counts[name] = seen.pop("row_count")
        failures.update(seen)
        return tables[name]

    skip = settings.skip_unreadable
    store("yellow_raw", scan_trip_files(spark, landing.yellow, schemas.YELLOW_FILE, skip))
    store("green_raw", scan_trip_files(spark, landing.green, schemas.GREEN_FILE, skip))
    store("zone_lookup", scan_zone_csv(spark, landing.zones))
    store("weather_hourly", flatten_hourly_json(spark, landing.weather, multi_line=False))
    settings.gate.enforce(_as_counts(spark, counts))

    checks = rules.trip_rules(settings.years, settings.months, settings.max_distance)
    store("stg_trips", conform.stage_trips(tables["yellow_raw"], tables["green_raw"], checks))
    store("stg_zones", conform.stage_zones(tables["zone_lookup"]))
    store("stg_weather", conform.stage_weather(tables["weather_hourly"]))

    store("dim_zones", conform.dim_zones(tables["stg_zones"]))
    store("dim_weather", conform.dim_weather(tables["stg_weather"]))
    store(
        "fct_trips",
        fact_trips(
            tables["stg_trips"], tables["dim_zones"], tables["dim_weather"], years=settings.years
        ),
        partition_by=("pickup_year", "pickup_month"),
        rebalance=settings.rebalance,
    )
    store("mart_weather_demand", mart_weather_demand(tables["fct_trips"]))

    # Stored before it is judged: the checks run once and leave a record.
    results = publish_table(
        run_expectations(tables, counted=failures), f"{out}/checks/expectations"
    )
    return tables, _with_layer(_as_counts(spark, counts)), enforce(results)


def _as_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


def layer_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every table with its layer, counted where nobody has."""
    return _with_layer(table_counts(tables))


def _with_layer(counts: DataFrame) -> DataFrame:
    pairs = [F.lit(x) for item in LAYERS.items() for x in item]
    layer = F.create_map(*pairs)[F.col("table_name")]
    return counts.select(layer.alias("layer"), "table_name", "row_count")
