"""Named queries: each takes (spark, folder of given tables) and returns a frame.

Dates come out as ISO text, so that both engines print them alike.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailmeter import schemas
from hailmeter.catalog import fixtures, landing
from hailmeter.functions import clock, money, rules, sky
from hailmeter.operators import conform, demand, enrich
from hailmeter.operators.dimension import fits_broadcast
from hailmeter.plans import expectations, pipeline, quality, reports, segments
from hailmeter.session import pin_clock, work_dir
from hailmeter.sources import files, tables
from hailmeter.sources import reports as landed
from hailmeter.streaming import hourly, incremental


class Scene:
    """The tables of one folder, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        pin_clock(spark)
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def bronze(self) -> fixtures.Bronze:
        return landing.stored_bronze(self.spark, self.sf_dir)

    @cached_property
    def staged(self) -> DataFrame:
        return conform.stage_trips(self.bronze.yellow, self.bronze.green)

    @cached_property
    def zones(self) -> DataFrame:
        return conform.dim_zones(conform.stage_zones(self.bronze.zones))

    @cached_property
    def zones_small(self) -> bool:
        return fits_broadcast(self.zones)

    @cached_property
    def weather_small(self) -> bool:
        return fits_broadcast(self.weather)

    @cached_property
    def hours(self) -> DataFrame:
        return conform.stage_weather(self.bronze.weather)

    @cached_property
    def weather(self) -> DataFrame:
        return conform.dim_weather(self.hours)

    @cached_property
    def fact(self) -> DataFrame:
        return enrich.fact_trips(
            self.staged,
            self.zones,
            self.weather,
            self.zones_small,
            self.weather_small,
            years=rules.VALID_YEARS,
        )

    @cached_property
    def trips(self) -> DataFrame:
        """The fact without the dropoff role, which most reports never read."""
        return enrich.fact_trips(
            self.staged,
            self.zones,
            self.weather,
            self.zones_small,
            self.weather_small,
            years=rules.VALID_YEARS,
            roles=("pickup",),
        )

    @cached_property
    def unzoned(self) -> enrich.UnzonedTrips:
        """Trips for reports that meet the zones as groups."""
        return enrich.unzoned_trips(
            self.staged, self.zones, self.weather, self.weather_small, rules.VALID_YEARS
        )

    @cached_property
    def demand(self) -> DataFrame | enrich.UnzonedTrips:
        """What reports sum up: joined trips, or groups where the zones are too large."""
        return self.trips if self.zones_small else self.unzoned

    @cached_property
    def mart(self) -> DataFrame:
        return demand.mart_weather_demand(self.demand)

    @cached_property
    def landed(self) -> landing.LazyLanding:
        """Landed files by source, each written when it is first asked for."""
        return landing.landed_files(self.spark, self.sf_dir, self.bronze)

    def folder(self, label: str) -> str:
        return work_dir(self.spark, label)


QUERIES: dict[str, Callable[[Scene], DataFrame]] = {}


def query(build: Callable[[Scene], DataFrame]) -> Callable[[Scene], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def iso_dates(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, T.DateType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- eager aggregation below a large dimension: same rows as the plain queries ------------------


@query
def mart_weather_demand_eager(s: Scene) -> DataFrame:
    return demand.mart_weather_demand(s.unzoned)


@query
def pickup_flows_eager(s: Scene) -> DataFrame:
    return reports.pickup_flows(s.unzoned)


@query
def adverse_demand_change_eager(s: Scene) -> DataFrame:
    return reports.adverse_demand_change(s.unzoned, s.weather)


@query
def revenue_per_active_minute_eager(s: Scene) -> DataFrame:
    return reports.revenue_per_active_minute(s.unzoned)


@query
def trip_shape_by_condition_eager(s: Scene) -> DataFrame:
    return reports.trip_shape_by_condition(s.unzoned)


# --- sources and sinks ----------------------------------------------------------


def _months(path: str) -> str:
    return f"{path}/landed_month=*"


@query
def scan_yellow_files(s: Scene) -> DataFrame:
    """Landed Parquet with a declared schema, matched by name."""
    return files.scan_trip_files(s.spark, _months(s.landed.yellow), schemas.YELLOW_FILE)


@query
def scan_green_files(s: Scene) -> DataFrame:
    """Landed Parquet with an inferred schema."""
    return files.scan_trip_files(s.spark, _months(s.landed.green))


# Files of the first year come from the older writer; all others, those of trips without
# a pickup time among them, from the newer one.
def _older() -> Column:
    return F.coalesce(F.year("tpep_pickup_datetime") == 2025, F.lit(False))


def _old_layout(s: Scene, rows: Column | None = None) -> DataFrame:
    """Files as an older writer left them: other case, order, types."""
    first = s.bronze.yellow if rows is None else s.bronze.yellow.filter(rows)
    names = [c for c in reversed(first.columns) if c != "cbd_congestion_fee"]
    return first.select(
        *[
            F.col(c).cast("int" if c.endswith("LocationID") else first.schema[c].dataType).alias(
                c.upper()
            )
            for c in names
        ]
    )


@query
def align_columns_by_name(s: Scene) -> DataFrame:
    """Two file layouts under one schema."""
    folder = s.folder("drift")
    later = s.bronze.yellow.filter(~_older())
    _old_layout(s, _older()).write.mode("overwrite").parquet(f"{folder}/old")
    later.write.mode("overwrite").parquet(f"{folder}/new")
    groups = [files.scan_trip_files(s.spark, f"{folder}/{g}") for g in ("old", "new")]
    return files.align_columns_by_name(groups, schemas.YELLOW_FILE)


@query
def schema_drift(s: Scene) -> DataFrame:
    """All rows in the older layout against the canonical one."""
    extra = _old_layout(s).withColumn("SURGE", F.col("FARE_AMOUNT"))
    return landed.schema_drift(extra, schemas.YELLOW_FILE)


RECEIPT = T.StructType(
    [
        T.StructField("vendor", T.IntegerType()),
        T.StructField("zone", T.StringType()),
        T.StructField("fare", T.DoubleType()),
    ]
)


def _land_receipts(s: Scene) -> str:
    """CSV receipts; in March of the first year vendor 2 writes broken fares."""
    folder = s.folder("receipts")
    at, vendor = F.col("tpep_pickup_datetime"), F.col("VendorID")
    month = F.date_format(at, "yyyy-MM")
    broken = (month == "2025-03") & (vendor == 2)
    s.bronze.yellow.select(
        vendor.alias("vendor"),
        F.concat(F.lit('zone "'), F.col("PULocationID"), F.lit('", N/A')).alias("zone"),
        F.when(broken, "n/a?").otherwise(F.col("fare_amount").cast("string")).alias("fare"),
        month.alias("landed_month"),
    ).hint("rebalance", "landed_month").write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).partitionBy("landed_month").csv(folder)
    return _months(folder)


@query
def tolerant_load(s: Scene) -> DataFrame:
    """Good rows of receipts with broken lines among them."""
    good, _ = files.tolerant_csv(s.spark, _land_receipts(s), RECEIPT)
    return good.groupBy("vendor").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("fare").alias("fares")
    )


@query
def tolerant_load_rejects(s: Scene) -> DataFrame:
    """Rejected receipts per vendor."""
    _, bad = files.tolerant_csv(s.spark, _land_receipts(s), RECEIPT)
    return bad.groupBy("vendor").agg(F.count("line").alias("rejected"))


@query
def load_history(s: Scene) -> DataFrame:
    """Per-file load history, rolled up by status."""
    history = landed.load_history_csv(s.spark, _land_receipts(s), RECEIPT)
    return history.groupBy("status").agg(
        F.sum("row_count").alias("row_count"), F.sum("row_parsed").alias("row_parsed")
    )


@query
def load_history_by_folder(s: Scene) -> DataFrame:
    """Each monthly folder with its status, rows and first rejected line, in order."""
    return landed.load_history_csv(s.spark, _land_receipts(s), RECEIPT, by_folder=True)


def _land_with_a_broken_file(s: Scene) -> str:
    """Green trips as Parquet, and a folder whose files only claim to be Parquet."""
    folder = s.folder("broken")
    s.bronze.green.write.mode("overwrite").parquet(f"{folder}/landed=good")
    text = s.bronze.zones.select(F.col("Zone").alias("value"))
    text.write.mode("overwrite").text(f"{folder}/landed=broken")
    return f"{folder}/landed=*"


@query
def tolerant_load_parquet(s: Scene) -> DataFrame:
    """Trips of the readable files; the unreadable one stops nothing."""
    path = _land_with_a_broken_file(s)
    return files.scan_trip_files(s.spark, path, schemas.GREEN_FILE, tolerant=True)


@query
def load_history_parquet(s: Scene) -> DataFrame:
    """Which folder was read and which was not."""
    path = _land_with_a_broken_file(s)
    return landed.load_history_parquet(s.spark, path, schemas.GREEN_FILE, by_folder=True)


@query
def tolerant_cast(s: Scene) -> DataFrame:
    """Text columns cast to a declared schema; rows that do not fit are left out."""
    text = s.bronze.yellow.select(
        F.col("VendorID").cast("string").alias("vendor"),
        F.lit("z").alias("zone"),
        F.when(F.col("payment_type") == 3, "unknown")
        .otherwise(F.col("fare_amount").cast("string"))
        .alias("fare"),
    )
    good, bad = files.tolerant_cast(text, RECEIPT)
    return quality.table_counts({"good": good, "rejected": bad})


@query
def scan_zone_csv(s: Scene) -> DataFrame:
    return files.scan_zone_csv(s.spark, s.landed.zones)


@query
def flatten_hourly_json(s: Scene) -> DataFrame:
    """Daily documents of parallel arrays back to hourly rows."""
    return files.flatten_hourly_json(s.spark, s.landed.weather, multi_line=False)


@query
def weather_code_description(s: Scene) -> DataFrame:
    return (
        s.bronze.weather.groupBy("weather_code")
        .agg(F.count(F.lit(1)).alias("hours"))
        .withColumn("weather_description", sky.description(F.col("weather_code")))
    )


@query
def parse_local_timestamp(s: Scene) -> DataFrame:
    """Pickup written as text and read back as wall-clock time."""
    text = F.date_format("pickup_at", "yyyy-MM-dd'T'HH:mm")
    return s.staged.select(clock.parse_local_timestamp(text).alias("at")).groupBy("at").agg(
        F.count(F.lit(1)).alias("trips")
    )


@query
def publish_table(s: Scene) -> DataFrame:
    """Two versions one after the other; readers find the second one."""
    folder = s.folder("published")
    trips = conform.conform_green(s.bronze.green)
    tables.publish_table(trips.filter("vendor_id = 1"), folder)
    tables.publish_table(trips, folder)
    return tables.read_published(s.spark, folder, trips.schema)


@query
def overwrite_table(s: Scene) -> DataFrame:
    """A full refresh run twice leaves one copy."""
    folder = s.folder("refresh")
    trips = conform.conform_green(s.bronze.green)
    tables.overwrite_table(trips, folder)
    return tables.overwrite_table(trips, folder)


@query
def append_table(s: Scene) -> DataFrame:
    """Two appends under the declared weather schema."""
    folder = s.folder("append")
    first = F.coalesce(F.year("datetime_local") == 2025, F.lit(False))
    tables.append_table(s.bronze.weather.filter(first), folder, schemas.HOURLY_WEATHER)
    return tables.append_table(s.bronze.weather.filter(~first), folder, schemas.HOURLY_WEATHER)


@query
def append_small_frame(s: Scene) -> DataFrame:
    """Two hand-kept zones appended to the stored zone table."""
    folder = s.folder("small-frame")
    tables.append_table(s.bronze.zones, folder, schemas.ZONE_FILE)
    rows = [(9001, "Queens", "New Yard", "Boro Zone"), (9002, None, "Unnamed", None)]
    return tables.append_small_frame(s.spark, rows, folder, schemas.ZONE_FILE)


@query
def file_inventory(s: Scene) -> DataFrame:
    """Rows and pickup span per landing folder."""
    scan = files.scan_trip_files(s.spark, s.landed.yellow, schemas.YELLOW_FILE)
    return landed.file_inventory(scan, "tpep_pickup_datetime", by_folder=True)


@query
def inventory_check(s: Scene) -> DataFrame:
    """Ten monthly folders expected; stray months land in folders of their own."""
    return landed.inventory_check(file_inventory(s), expected=10)


@query
def sample_rows(s: Scene) -> DataFrame:
    order = ["pickup_at", "pickup_zone_id", "dropoff_zone_id", "fare_amount", "trip_distance"]
    return landed.sample_rows(s.trips, 1000, order).select(*order, "total_amount")


# --- projection and conforming ----------------------------------------------------


@query
def conform_yellow(s: Scene) -> DataFrame:
    return conform.conform_yellow(s.bronze.yellow)


@query
def conform_green(s: Scene) -> DataFrame:
    return conform.conform_green(s.bronze.green)


@query
def stg_trips(s: Scene) -> DataFrame:
    return s.staged


@query
def stg_zones(s: Scene) -> DataFrame:
    return conform.stage_zones(s.bronze.zones)


@query
def stg_weather(s: Scene) -> DataFrame:
    return iso_dates(s.hours)


@query
def dim_zones(s: Scene) -> DataFrame:
    return s.zones


@query
def dim_weather(s: Scene) -> DataFrame:
    return iso_dates(s.weather)


@query
def payment_label(s: Scene) -> DataFrame:
    code = F.col("payment_type")
    return s.staged.groupBy(code, money.payment_label(code).alias("payment_label")).agg(
        F.count(F.lit(1)).alias("trips")
    )


@query
def month_label(s: Scene) -> DataFrame:
    month = F.col("pickup_month")
    return s.staged.groupBy(month, clock.month_label(month).alias("month_label")).agg(
        F.count(F.lit(1)).alias("trips")
    )


@query
def trip_duration_minutes(s: Scene) -> DataFrame:
    """Minute boundaries crossed, per duration."""
    return s.staged.groupBy("trip_duration_minutes").agg(F.count(F.lit(1)).alias("trips"))


@query
def time_flags(s: Scene) -> DataFrame:
    """Weekday, hour and the three flags that follow from them."""
    keys = ["pickup_dayofweek", "pickup_hour", "is_night", "is_weekend", "is_rush_hour"]
    return s.staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"))


@query
def weather_category(s: Scene) -> DataFrame:
    keys = ["weather_code", "weather_category", "is_adverse_weather"]
    return s.hours.groupBy(*keys).agg(F.count(F.lit(1)).alias("hours"))


# --- filters ------------------------------------------------------------------------


@query
def valid_trips(s: Scene) -> DataFrame:
    return enrich.valid_trips(s.staged).select(
        "taxi_type", "pickup_at", "dropoff_at", "trip_distance", "total_amount", "dq_flag_reason"
    )


@query
def city_boroughs(s: Scene) -> DataFrame:
    return demand.city_boroughs(s.trips).groupBy("pickup_borough").agg(
        F.count(F.lit(1)).alias("trips")
    )


@query
def catch_all_zones(s: Scene) -> DataFrame:
    return quality.catch_all_zones(s.zones, fixtures.CATCH_ALL_IDS)


@query
def very_long_trips(s: Scene) -> DataFrame:
    return s.staged.filter(quality.very_long()).select(
        "pickup_at", "dropoff_at", "trip_duration_minutes"
    )


@query
def zero_distance_with_fare(s: Scene) -> DataFrame:
    return s.staged.filter(quality.free_distance()).select(
        "pickup_at", "trip_distance", "fare_amount"
    )


@query
def filter_dimensions(s: Scene) -> DataFrame:
    """Interactive selection on the mart."""
    chosen = {
        "pickup_borough": ["Manhattan", "Queens"],
        "weather_category": ["Rain", "Snow"],
        "pickup_year": [2026],
        "payment_type": ["Credit Card"],
    }
    return reports.filter_dimensions(s.mart, chosen)


# --- joins ----------------------------------------------------------------------------


@query
def enrich_pickup_zone(s: Scene) -> DataFrame:
    return enrich.enrich_zone(s.staged, s.zones, "pickup", small=s.zones_small).select(
        "pickup_at", "pickup_zone_id", "pickup_borough", "pickup_zone_name"
    )


@query
def enrich_dropoff_zone(s: Scene) -> DataFrame:
    return enrich.enrich_zone(s.staged, s.zones, "dropoff", small=s.zones_small).select(
        "pickup_at", "dropoff_zone_id", "dropoff_borough", "dropoff_zone_name"
    )


@query
def enrich_weather(s: Scene) -> DataFrame:
    return enrich.enrich_weather(
        s.staged, s.weather, small=s.weather_small
    ).select(
        "pickup_at", "weather_category", "is_adverse_weather",
        "temperature_f", "precipitation_inch", "wind_speed_mph",
    )


@query
def fact_trips(s: Scene) -> DataFrame:
    return s.fact


@query
def fact_trips_salted(s: Scene) -> DataFrame:
    """The same fact with every dimension treated as too large to broadcast."""
    return enrich.fact_trips(
        s.staged, s.zones, s.weather, zones_small=False, weather_small=False
    )


@query
def pickup_flows(s: Scene) -> DataFrame:
    return reports.pickup_flows(s.fact)


@query
def referential_check(s: Scene) -> DataFrame:
    """Trips whose pickup zone is unknown."""
    return expectations.relationship_failures(s.staged, "pickup_zone_id", s.zones, "location_id")


@query
def weather_match(s: Scene) -> DataFrame:
    return quality.weather_match(s.trips)


# --- aggregations -----------------------------------------------------------------------


@query
def mart_weather_demand(s: Scene) -> DataFrame:
    return s.mart


@query
def table_counts(s: Scene) -> DataFrame:
    b = s.bronze
    return quality.table_counts(
        {
            "yellow_raw": b.yellow,
            "green_raw": b.green,
            "zone_lookup": b.zones,
            "weather_hourly": b.weather,
        }
    )


@query
def pickup_range(s: Scene) -> DataFrame:
    b = s.bronze
    return quality.pickup_range(
        {
            "yellow": (b.yellow, "tpep_pickup_datetime"),
            "green": (b.green, "lpep_pickup_datetime"),
            "weather": (b.weather, "datetime_local"),
        }
    )


@query
def weather_hours_by_year(s: Scene) -> DataFrame:
    return quality.weather_hours_by_year(s.bronze.weather)


@query
def trips_by_taxi_type(s: Scene) -> DataFrame:
    return quality.trips_by(s.staged, "taxi_type")


@query
def trips_by_month(s: Scene) -> DataFrame:
    return quality.trips_by(s.staged, "pickup_year", "pickup_month")


@query
def validity_share(s: Scene) -> DataFrame:
    return quality.validity_share(s.staged)


@query
def dq_reason_topk(s: Scene) -> DataFrame:
    return quality.dq_reason_topk(s.staged)


@query
def dq_rule_counts(s: Scene) -> DataFrame:
    return quality.dq_rule_counts(s.staged)


@query
def dq_exploratory_counts(s: Scene) -> DataFrame:
    return quality.dq_exploratory_counts(s.staged)


@query
def mart_reaggregate(s: Scene) -> DataFrame:
    """The stored mart summed up again over fewer keys."""
    return demand.rollup(
        s.mart,
        ["pickup_borough", "payment_type"],
        ["trip_count", "total_revenue", "total_tips"],
    )


@query
def weekpart_days(s: Scene) -> DataFrame:
    return reports.weekpart_days(s.weather)


@query
def zone_features(s: Scene) -> DataFrame:
    return segments.zone_features(s.demand)


@query
def layer_reconciliation(s: Scene) -> DataFrame:
    return quality.layer_reconciliation(s.bronze.yellow, s.bronze.green, s.staged)


@query
def domain_values(s: Scene) -> DataFrame:
    return reports.domain_values(s.trips, "weather_category")


# --- reports ------------------------------------------------------------------------------


@query
def monthly_volume(s: Scene) -> DataFrame:
    return reports.monthly_volume(s.demand)


@query
def hourly_demand_weekpart(s: Scene) -> DataFrame:
    return reports.hourly_demand_weekpart(s.demand, s.weather)


@query
def avg_trip_cost(s: Scene) -> DataFrame:
    return reports.avg_trip_cost(s.demand)


@query
def adverse_demand_change(s: Scene) -> DataFrame:
    return reports.adverse_demand_change(s.demand, s.weather)


@query
def weather_type_demand_change(s: Scene) -> DataFrame:
    return reports.weather_type_demand_change(s.demand, s.weather)


@query
def adverse_revenue_delta(s: Scene) -> DataFrame:
    return reports.adverse_revenue_delta(s.demand, s.weather)


@query
def adverse_revenue_delta_strict(s: Scene) -> DataFrame:
    return reports.adverse_revenue_delta(s.demand, s.weather, strict=True)


@query
def rush_revenue_swing(s: Scene) -> DataFrame:
    return reports.rush_revenue_swing(s.demand, s.weather)


@query
def borough_share_shift(s: Scene) -> DataFrame:
    return reports.borough_share_shift(s.demand)


@query
def yoy_change(s: Scene) -> DataFrame:
    return reports.yoy_change(s.demand)


@query
def profile_columns(s: Scene) -> DataFrame:
    return landed.profile_columns(s.fact)


# --- documented analyses --------------------------------------------------------------------


@query
def revenue_per_active_minute(s: Scene) -> DataFrame:
    return reports.revenue_per_active_minute(s.demand)


@query
def trips_per_hour(s: Scene) -> DataFrame:
    return reports.trips_per_hour(s.demand, s.weather)


@query
def weather_hour_share(s: Scene) -> DataFrame:
    return reports.weather_hour_share(s.weather)


@query
def total_mismatch(s: Scene) -> DataFrame:
    return quality.total_mismatch(s.trips)


@query
def top_gaps(s: Scene) -> DataFrame:
    return quality.top_gaps(s.trips)


@query
def unknown_payment_profile(s: Scene) -> DataFrame:
    return quality.unknown_payment_profile(s.staged)


@query
def tip_audit(s: Scene) -> DataFrame:
    return quality.tip_audit(s.trips)


@query
def storm_severity(s: Scene) -> DataFrame:
    return reports.storm_severity(s.hours)


@query
def storm_severity_change(s: Scene) -> DataFrame:
    return reports.storm_severity_change(s.hours)


@query
def longest_run(s: Scene) -> DataFrame:
    return reports.longest_run(s.hours)


@query
def trip_shape_by_condition(s: Scene) -> DataFrame:
    return reports.trip_shape_by_condition(s.demand)


@query
def left_in_defects(s: Scene) -> DataFrame:
    return quality.left_in_defects(s.trips)


def _resent(s: Scene) -> DataFrame:
    """Trips of payment type 2 arrive a second time."""
    return s.staged.unionByName(s.staged.filter(F.col("payment_type") == 2))


@query
def zero_totals_by_payment(s: Scene) -> DataFrame:
    """Charged totals of zero, per payment label."""
    return quality.zero_totals_by_payment(s.trips)


@query
def duplicate_trips(s: Scene) -> DataFrame:
    return quality.duplicate_trips(_resent(s))


@query
def drop_duplicate_trips(s: Scene) -> DataFrame:
    """Every column of the trip that stays, for each key."""
    return quality.drop_duplicate_trips(_resent(s))


@query
def surcharge_by_month(s: Scene) -> DataFrame:
    return quality.surcharge_by_month(s.trips)


@query
def invalid_share_by_weather(s: Scene) -> DataFrame:
    return quality.invalid_share_by_weather(s.staged, s.weather, small=s.weather_small)


@query
def payment0_by_vendor(s: Scene) -> DataFrame:
    return quality.payment0_by_vendor(s.staged)


# --- segmentation -----------------------------------------------------------------------------


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals, and no negative zero."""
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in columns})


@query
def standardize_features(s: Scene) -> DataFrame:
    scores = segments.standardize_features(segments.zone_features(s.demand))
    return _rounded(scores, *segments.FEATURES)


@query
def zone_features_eager(s: Scene) -> DataFrame:
    """Features by zone and borough with zones that are too large to be sent to trips."""
    return segments.zone_features(s.unzoned, ("pickup_zone_id", "pickup_borough"))


@query
def davies_bouldin(s: Scene) -> DataFrame:
    """The index of a known assignment: every zone belongs to its borough."""
    keys = ("pickup_zone_id", "pickup_borough")
    scores = segments.standardize_features(segments.zone_features(s.demand, keys))
    index = segments.davies_bouldin(scores, "pickup_borough", segments.FEATURES)
    return _rounded(index, "davies_bouldin_index")


def _segments(s: Scene, counts: tuple[int, ...]) -> segments.Segmentation:
    return segments.fit_segments(segments.zone_features(s.demand), counts)


def _borough_scores(s: Scene) -> DataFrame:
    keys = ("pickup_zone_id", "pickup_borough")
    scores = segments.standardize_features(segments.zone_features(s.demand, keys))
    return scores.filter("pickup_borough IS NOT NULL")


@query
def assign_to_centres(s: Scene) -> DataFrame:
    """Each zone with the borough whose mean zone is nearest."""
    scores = _borough_scores(s)
    centres = segments.lloyd_step(scores, "pickup_borough", segments.FEATURES)
    return segments.assign_to_centres(
        scores, centres, "pickup_borough", segments.FEATURES, "nearest"
    ).select("pickup_zone_id", "pickup_borough", "nearest")


@query
def lloyd_step(s: Scene) -> DataFrame:
    """One exact step from the boroughs' centres: the centres of the new assignment."""
    scores = _borough_scores(s)
    centres = segments.lloyd_step(scores, "pickup_borough", segments.FEATURES)
    moved = segments.assign_to_centres(
        scores, centres, "pickup_borough", segments.FEATURES, "nearest"
    )
    return _rounded(
        segments.lloyd_step(moved, "nearest", segments.FEATURES), *segments.FEATURES
    )


@query
def centroid_pivot(s: Scene) -> DataFrame:
    """Feature x group in original units, for groups of zones by number."""
    features = segments.zone_features(s.demand).withColumn("g", F.col("pickup_zone_id") % 4)
    pivot = segments.centroid_pivot(features, "g", segments.FEATURES, (0, 1, 2, 3))
    return _rounded(pivot, *[f"cluster_{i}" for i in range(1, 5)])


@query
def k_comparison_of_fixed(s: Scene) -> DataFrame:
    """Index, rank and gain of four fixed assignments: zones by their number modulo k."""
    scores = segments.standardize_features(segments.zone_features(s.demand))
    choices = F.array(
        *[
            F.struct(F.lit(k).alias("k"), (F.col("pickup_zone_id") % k).alias("cluster"))
            for k in segments.CLUSTER_COUNTS
        ]
    )
    tall = scores.select(F.inline(choices), *segments.FEATURES)
    index = segments.davies_bouldin(tall, "cluster", segments.FEATURES, by=["k"])
    named = index.select(F.concat(F.lit("k="), "k").alias("model"), "k", "davies_bouldin_index")
    return _rounded(segments.k_comparison(named), "davies_bouldin_index", "gain")


@query
def davies_bouldin_by_k(s: Scene) -> DataFrame:
    return segments.davies_bouldin_by_k(_segments(s, segments.CLUSTER_COUNTS))


@query
def k_comparison(s: Scene) -> DataFrame:
    indices = segments.davies_bouldin_by_k(_segments(s, segments.CLUSTER_COUNTS))
    return segments.k_comparison(indices)


@query
def centroid_table_k4(s: Scene) -> DataFrame:
    return segments.centroid_table(_segments(s, (4,)), 4)


@query
def centroid_table_k6(s: Scene) -> DataFrame:
    return segments.centroid_table(_segments(s, (6,)), 6)


@query
def assign_clusters(s: Scene) -> DataFrame:
    return segments.assign_clusters(_segments(s, (4,)), 4)


# --- streaming ----------------------------------------------------------------------------------


def _streams(s: Scene) -> tuple[DataFrame, DataFrame]:
    return (
        incremental.read_landing(s.spark, _months(s.landed.yellow), schemas.YELLOW_FILE, 12),
        incremental.read_landing(s.spark, _months(s.landed.green), schemas.GREEN_FILE, 12),
    )


@query
def incremental_load(s: Scene) -> DataFrame:
    """One year lands and is loaded, then all the rest; a rerun adds nothing."""
    folder = s.folder("incremental")
    table, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
    first = F.coalesce(F.year("lpep_pickup_datetime") == 2025, F.lit(False))
    for rows in (first, ~first):
        chosen = s.bronze.green.filter(rows)
        chosen.write.mode("append").parquet(f"{folder}/landing")
        for _ in range(2):
            stream = incremental.read_landing(s.spark, f"{folder}/landing", schemas.GREEN_FILE)
            loaded = incremental.incremental_load(stream, table, checkpoint)
    return loaded


@query
def stream_stage_trips(s: Scene) -> DataFrame:
    folder = s.folder("stream-silver")
    return incremental.stream_stage_trips(
        *_streams(s), f"{folder}/table", f"{folder}/checkpoint"
    )


@query
def stream_hourly_demand(s: Scene) -> DataFrame:
    """Feeds that land month by month; hours more than 40 days behind leave the state."""
    folder = s.folder("stream-hourly")
    delay = "40 days"
    streams = (
        incremental.read_landing(s.spark, s.landed.yellow_in_order, schemas.YELLOW_FILE, 12),
        incremental.read_landing(s.spark, s.landed.green_in_order, schemas.GREEN_FILE, 12),
    )
    return hourly.stream_hourly_demand(
        enrich.valid_trips(hourly.timed_trips(*streams, delay)),
        s.weather,
        f"{folder}/table",
        f"{folder}/checkpoint",
        delay=delay,
        weather_small=s.weather_small,
    )


# --- checks and pipeline ------------------------------------------------------------------------


class _Tables(Mapping):
    """Every layer by name, built when it is asked for; nothing is written for it.

    Row-wise checks and counts of a table are one pass over the stored bronze tables.
    """

    def __init__(self, s: Scene):
        self._build = {
            "yellow_raw": lambda: s.bronze.yellow,
            "green_raw": lambda: s.bronze.green,
            "zone_lookup": lambda: s.bronze.zones,
            "weather_hourly": lambda: s.bronze.weather,
            "stg_trips": lambda: s.staged,
            "stg_zones": lambda: conform.stage_zones(s.bronze.zones),
            "stg_weather": lambda: s.hours,
            "fct_trips": lambda: s.fact,
            "mart_weather_demand": lambda: s.mart,
            "dim_zones": lambda: s.zones,
            "dim_weather": lambda: s.weather,
        }

    def __getitem__(self, name: str) -> DataFrame:
        return self._build[name]()

    def __iter__(self):
        return iter(self._build)

    def __len__(self) -> int:
        return len(self._build)


@query
def expectations_suite(s: Scene) -> DataFrame:
    """All 32 checks, plus uniqueness of the hour."""
    suite = [*expectations.SUITE, expectations.HOUR_IS_UNIQUE]
    return expectations.run_expectations(_Tables(s), suite)


def _of_kind(s: Scene, kind: str) -> DataFrame:
    suite = [e for e in expectations.SUITE if e.kind == kind]
    return expectations.run_expectations(_Tables(s), suite)


@query
def expect_not_null(s: Scene) -> DataFrame:
    return _of_kind(s, "not_null")


@query
def expect_unique(s: Scene) -> DataFrame:
    return _of_kind(s, "unique")


@query
def expect_unique_of_repeated_trips(s: Scene) -> DataFrame:
    """A check that fails: trips are there twice by their four identifying columns."""
    key = ",".join(quality.DUPLICATE_KEYS)
    check = expectations.Expectation("stg_trips", key, "unique", "warn")
    return expectations.run_expectations(_Tables(s), [check])


@query
def observed_write(s: Scene) -> DataFrame:
    """Silver is written; its checks and row count come out of the writing tasks."""
    metrics = expectations.rowwise_metrics(expectations.SUITE, "stg_trips")
    metrics["row_count"] = F.count(F.lit(1))
    _, seen = tables.write_observed(s.staged, s.folder("observed"), metrics)
    return s.spark.createDataFrame(
        [(k, int(v)) for k, v in seen.items()], "name string, failures long"
    )


@query
def expect_accepted_values(s: Scene) -> DataFrame:
    return _of_kind(s, "accepted_values")


@query
def expect_relationship(s: Scene) -> DataFrame:
    return _of_kind(s, "relationship")


@query
def min_row_count(s: Scene) -> DataFrame:
    gate = expectations.RowGate({"yellow_raw": 1000, "green_raw": 10**18, "zone_lookup": 1})
    return gate.check(table_counts(s))


@query
def layer_counts(s: Scene) -> DataFrame:
    return pipeline.layer_summary(_Tables(s))


@query
def run_pipeline(s: Scene) -> DataFrame:
    """Landed files to gold; the summary of every layer."""
    return pipeline.run_pipeline(s.spark, s.landed.all(), s.folder("tables"))[1]
