"""Joins, the mart and the reports on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from hailmeter.functions import rules
from hailmeter.operators import conform, demand, enrich
from hailmeter.operators.dimension import (
    CELL_BYTES,
    Lookup,
    attach,
    attach_all,
    fits_broadcast,
    heavy_keys,
    measured,
    measured_bytes,
    shares,
)
from hailmeter.plans import quality, reports, segments


def _sorted(df):
    return sorted(df.collect(), key=str)


@pytest.fixture(scope="module")
def zones(make_zones):
    return conform.stage_zones(
        make_zones(
            (1, "Manhattan", "A", "Yellow Zone"),
            (2, "Queens", "B", "Boro Zone"),
            (3, "N/A", "C", "N/A"),
        )
    )


@pytest.fixture(scope="module")
def weather(make_weather):
    """Clear 10:00, rain 11:00 on one day of each year; the second year has no rain."""
    return conform.stage_weather(
        make_weather(
            ("2025-03-05 10:00:00", 0, 0.0, 0.0),
            ("2025-03-05 11:00:00", 61, 0.0, 0.0),
            ("2025-03-05 12:00:00", 61, 0.0, 0.0),
            ("2026-03-05 10:00:00", 0, 0.0, 0.0),
            ("2026-03-05 11:00:00", 1, 0.0, 0.0),
        )
    )


def _trip(year, hour, zone=1, **more):
    stamp = f"{year}-03-05 {hour:02}"
    return dict(pickup=f"{stamp}:05:00", dropoff=f"{stamp}:25:00", PULocationID=zone, **more)


@pytest.fixture(scope="module")
def staged(make_feed):
    trips = [
        _trip(2025, 10),
        _trip(2025, 10, payment_type=0),
        _trip(2025, 11, payment_type=5),
        _trip(2025, 11),
        _trip(2025, 12),
        _trip(2025, 12),
        _trip(2025, 12),
        _trip(2026, 10),
        _trip(2025, 10, zone=2),
        _trip(2025, 10, zone=3),
        _trip(2025, 10, zone=99),
        _trip(2025, 10, fare_amount=-1.0),
    ]
    return conform.stage_trips(make_feed("yellow", *trips), make_feed("green"))


@pytest.fixture(scope="module")
def fact(staged, zones, weather):
    return enrich.fact_trips(staged, zones, weather).cache()


def test_fact_keeps_every_valid_trip(staged, fact):
    assert len(fact.columns) == 35
    assert fact.count() == staged.filter("is_valid").count() == 11
    assert fact.filter("pickup_borough IS NULL").count() == 1


def test_salted_join_gives_the_same_rows(staged, zones, weather, fact):
    salted = enrich.fact_trips(staged, zones, weather, zones_small=False, weather_small=False)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 3 and "BroadcastHashJoin" not in plan
    assert _sorted(salted) == _sorted(fact)


def test_salted_join_spreads_a_hot_key(spark):
    facts = spark.range(0, 4000, 1, 16).withColumn("k", F.when(F.col("id") % 3 > 0, 7).otherwise(8))
    dim = spark.createDataFrame([(7, "hot"), (8, "cold"), (9, "none")], "key int, label string")
    on = [("k", "key")]
    small = attach(facts, dim, on)
    large = attach(facts, dim, on, small=False)
    assert _sorted(small) == _sorted(large)
    assert large.columns == ["id", "k", "label"]


def test_heavy_keys_of_all_joins_come_from_one_scan(spark):
    facts = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 7, id) AS a", "CAST(if(id % 2 = 0, null, if(id % 100 = 1, 5, id)) AS INT) AS b",
        "id AS c",
    )
    found = heavy_keys(facts, {"a": ["a"], "b": ["b"], "both": ["a", "c"]})
    hashes = spark.sql("SELECT xxhash64(7L), xxhash64(5L)").first()
    assert found == {"a": [hashes[0]], "b": [hashes[1]], "both": []}
    assert heavy_keys(facts.limit(0), {"a": ["a"]}) == {"a": []}
    assert heavy_keys(facts, {}) == {}


REPORTS = [
    demand.mart_weather_demand,
    demand.weighted_mart,
    segments.zone_features,
    lambda f: segments.zone_features(f, ("pickup_zone_id", "pickup_borough")),
    lambda f: segments.zone_features(f, ("dropoff_borough", "dropoff_zone_id", "pickup_year")),
    reports.monthly_volume,
    reports.avg_trip_cost,
    reports.borough_share_shift,
    reports.yoy_change,
    reports.revenue_per_active_minute,
    reports.trip_shape_by_condition,
    reports.pickup_flows,
]


@pytest.mark.parametrize("report", REPORTS)
def test_groups_meet_large_zones(spark, staged, zones, weather, fact, report):
    """The same rows as from the fact, and what is shuffled are groups, never trips."""
    unzoned = enrich.unzoned_trips(staged, zones, weather)
    assert _sorted(report(unzoned)) == _sorted(report(fact))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = _shuffled_columns(report(unzoned)._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert shuffled and not shuffled & {"pickup_at", "total_amount", "trip_duration_minutes"}


def test_a_doubled_zone_doubles_its_groups(staged, zones, weather):
    twice = zones.unionByName(zones.filter("location_id = 1"))
    joined = enrich.fact_trips(staged, twice, weather, roles=("pickup",))
    unzoned = enrich.unzoned_trips(staged, twice, weather)
    for report in (demand.mart_weather_demand, reports.monthly_volume, reports.yoy_change):
        assert _sorted(report(unzoned)) == _sorted(report(joined))
    # features by zone ask for no attribute of a zone, so zones play no part
    assert segments.zone_features(unzoned).agg(F.sum("trip_count")).first()[0] == 11


def _shuffled_columns(node):
    """Columns of all rows that are shuffled, whatever they come from."""
    own = set()
    if "Exchange" in node.nodeName() and "Broadcast" not in node.nodeName():
        out = node.output()
        own |= {out.apply(i).name() for i in range(out.size())}
    for i in range(node.children().size()):
        own |= _shuffled_columns(node.children().apply(i))
    return own


@pytest.mark.parametrize(
    "report",
    [
        reports.hourly_demand_weekpart,
        reports.adverse_demand_change,
        reports.weather_type_demand_change,
        reports.adverse_revenue_delta,
        reports.rush_revenue_swing,
        reports.trips_per_hour,
    ],
)
def test_exposure_reports_from_groups(staged, zones, weather, fact, report):
    unzoned = enrich.unzoned_trips(staged, zones, weather)
    assert _sorted(report(unzoned, weather)) == _sorted(report(fact, weather))


def test_size_check_counts_rows_and_text(spark):
    dim = spark.createDataFrame([(1, "ab"), (2, None)], "key int, label string")
    assert measured_bytes(dim) == 2 * (32 + 16) + 2
    assert fits_broadcast(dim, 98) and not fits_broadcast(dim, 97)
    assert fits_broadcast(dim.limit(0), 0)


def test_doubled_hour_fans_out_in_both_joins(staged, zones, weather):
    doubled = weather.unionByName(weather.filter("weather_hour = 10 AND weather_date < '2026-01-01'"))
    broadcast = enrich.fact_trips(staged, zones, doubled)
    salted = enrich.fact_trips(staged, zones, doubled, zones_small=False, weather_small=False)
    assert broadcast.count() == 11 + 5
    assert _sorted(broadcast) == _sorted(salted)


def test_year_pruning_changes_nothing(staged):
    pruned = enrich.valid_trips(staged, years=rules.VALID_YEARS)
    assert _sorted(enrich.valid_trips(staged)) == _sorted(pruned)


def test_valid_trips_follow_the_rules_that_flagged_them(make_feed):
    times = ["2024-02-05 10:00:00", "2025-02-05 10:00:00", "2026-02-05 10:00:00"]
    trips = [dict(pickup=t, dropoff=t) for t in times]
    checks = rules.trip_rules(years=(2024, 2025, 2026))
    staged = conform.stage_trips(make_feed("yellow", *trips), make_feed("green"), checks)
    kept = enrich.valid_trips(staged)
    assert kept.count() == staged.filter("is_valid").count() == 3


def test_hot_key_of_one_input_partition_is_spread(spark):
    facts = spark.range(0, 20000, 1, 1).withColumn("k", F.lit(7))
    dim = spark.createDataFrame([(7, "hot"), (8, "cold")], "key int, label string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        large = attach(facts, dim, [("k", "key")], small=False)
        tasks = large.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1
    assert large.filter("label = 'hot'").count() == 20000


def test_averages_leave_unknown_durations_out(fact):
    """Mart and fact agree with AVG where part of a group is unknown."""
    odd = fact.withColumn(
        "trip_duration_minutes",
        F.when(F.col("total_amount") % 2 == 0, F.col("trip_duration_minutes")),
    ).withColumn("trip_distance", F.when(F.col("pickup_hour") != 10, F.col("trip_distance")))
    keys = ["pickup_borough", "pickup_year", "is_adverse_weather"]
    direct = demand.city_boroughs(odd).groupBy(*keys).agg(
        F.avg("trip_duration_minutes").alias("avg_duration"),
        F.avg("trip_distance").alias("avg_distance"),
    )
    assert _sorted(reports.trip_shape_by_condition(odd)) == _sorted(direct)
    weighted = demand.weighted_mart(odd)
    assert _sorted(reports.trip_shape_by_condition(weighted)) == _sorted(direct)


def test_pruning_reaches_the_scan(spark, make_feed, tmp_path):
    path = str(tmp_path / "yellow")
    make_feed("yellow", {}).write.parquet(path)
    feed = spark.read.parquet(path)
    staged = conform.stage_trips(feed, make_feed("green"))
    plan = enrich.valid_trips(staged, rules.VALID_YEARS)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan


def test_mart_merges_unknown_payments(fact):
    mart = demand.mart_weather_demand(fact)
    assert len(mart.columns) == 21
    assert mart.agg(F.sum("trip_count")).first()[0] == 9
    unknown = mart.filter("payment_type = 'Unknown'")
    assert unknown.agg(F.sum("trip_count")).first()[0] == 2


@pytest.mark.parametrize(
    "report",
    [
        reports.monthly_volume,
        reports.avg_trip_cost,
        reports.borough_share_shift,
        reports.yoy_change,
        reports.revenue_per_active_minute,
        reports.trip_shape_by_condition,
    ],
)
def test_reports_agree_on_mart_and_fact(fact, report):
    assert _sorted(report(demand.mart_weather_demand(fact))) == _sorted(report(fact))


@pytest.mark.parametrize(
    "report",
    [
        reports.hourly_demand_weekpart,
        reports.adverse_demand_change,
        reports.weather_type_demand_change,
        reports.adverse_revenue_delta,
        reports.rush_revenue_swing,
        reports.trips_per_hour,
    ],
)
def test_exposure_reports_agree_on_mart_and_fact(fact, weather, report):
    mart = demand.mart_weather_demand(fact)
    assert _sorted(report(mart, weather)) == _sorted(report(fact, weather))


def test_adverse_change_per_exposure_hour(fact, weather):
    rows = {
        (r.pickup_borough, r.pickup_year, r.scope): r.pct_change
        for r in reports.adverse_demand_change(fact, weather).collect()
    }
    assert len(rows) == 2 * 2 * 3
    # 5 trips in 2 rain hours against 2 trips in 1 clear hour.
    assert rows[("Manhattan", 2025, "all")] == pytest.approx((2.5 - 2) / 2 * 100)
    assert rows[("Manhattan", 2025, "day")] == rows[("Manhattan", 2025, "all")]
    # No adverse hour in the second year, and no trips of Queens there.
    assert rows[("Manhattan", 2026, "all")] == -100.0
    assert rows[("Queens", 2026, "all")] == 0.0
    assert rows[("Manhattan", 2025, "night")] == 0.0


def test_revenue_delta_counts_all_days_unless_strict(spark, fact, weather):
    loose = reports.adverse_revenue_delta(fact, weather)
    assert loose.count() == 2 * 2 * 2
    strict = reports.adverse_revenue_delta(fact, weather, strict=True)
    assert strict.columns == loose.columns


def test_longest_run_breaks_at_gaps_and_years(make_weather):
    hours = ["2025-01-01 22", "2025-01-01 23", "2025-01-02 00", "2025-01-02 02", "2026-01-01 00"]
    staged = conform.stage_weather(
        make_weather(*[(f"{h}:00:00", 73, 0.5, 0.0) for h in [*hours, hours[0]]])
    )
    runs = {r.weather_year: r.longest_hours for r in reports.longest_run(staged).collect()}
    assert runs == {2025: 3, 2026: 1}


def test_storm_severity_without_snow(make_weather):
    staged = conform.stage_weather(make_weather(("2025-01-01 00:00:00", 0, 0.0, 0.0)))
    row = reports.storm_severity(staged).first()
    assert (row.snow_hours, row.longest_hours, row.avg_snow_depth) == (0, 0, None)


def test_totals_and_components(fact):
    assert quality.total_mismatch(fact).first().mismatched == 0
    gapped = fact.withColumn("total_amount", F.col("total_amount") - 2.5)
    assert [tuple(r) for r in quality.top_gaps(gapped).collect()] == [(-2.5, 11)]


def test_duplicates(staged):
    doubled = staged.unionByName(staged)
    assert quality.drop_duplicate_trips(doubled).count() == (
        staged.select(*quality.DUPLICATE_KEYS).distinct().count()
    )
    copies = quality.duplicate_trips(doubled).agg(F.sum("copies")).first()[0]
    assert copies == 2 * staged.count()


def test_empty_facts_give_empty_reports(fact, weather):
    none = fact.limit(0)
    assert reports.adverse_demand_change(none, weather).count() == 0
    assert demand.mart_weather_demand(none).count() == 0


def _zoned(spark, n=4000, zones=60):
    """Facts with a hot and an absent key, and dimensions with repeated and absent keys."""
    facts = spark.range(0, n, 1, 7).select(
        "id",
        F.expr(f"if(id % 3 = 0, 7, if(id % 17 = 0, null, id % {zones}))").alias("a"),
        F.expr(f"cast(if(id % 5 > 1, 9, id % {zones + 9}) as int)").alias("b"),
    )
    dim = spark.range(zones).selectExpr("cast(id as int) AS key", "concat('z', id) AS label")
    twice = dim.filter("key IN (5, 7)").withColumn("label", F.lit("again"))
    none = spark.createDataFrame([(None, "none")], "key int, label string")
    return facts, dim.unionAll(twice).unionAll(none)


def _lookups(facts, dim):
    heavy = heavy_keys(facts, {"a": ["a"], "b": ["b"], "c": ["c"]})
    assert heavy["a"] and heavy["b"]
    size = measured(dim)
    return [
        Lookup(dim.withColumnRenamed("label", f"{k}_label"), k, "key", heavy[k], *size)
        for k in "abc"
    ]


def test_large_dimensions_are_joined_in_one_shuffle_of_the_facts(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "12")
    facts, dim = _zoned(session)
    derive = lambda df: df.withColumn("c", F.expr("if(id % 7 = 0, null, id % 13)"))
    lookups = _lookups(derive(facts), dim)
    assert shares(lookups, 12) == [3, 2, 2]
    out = attach_all(facts, lookups, 10**9, derive)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 3 and "BroadcastHashJoin" not in plan
    assert plan.count("Exchange hashpartitioning(_cell#") == 1
    assert plan.count("Exchange hashpartitioning(") == 4
    assert out.columns == ["id", "a", "b", "c", "a_label", "b_label", "c_label"]
    want = derive(facts)
    for x in lookups:
        want = attach(want, x.dim, [(x.left, x.right)], small=True)
    assert _sorted(out) == _sorted(want)
    assert _sorted(attach_all(facts, lookups, 0, derive)) == _sorted(want)


def test_a_hot_key_of_a_joint_shuffle_is_spread(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "64")
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    facts = session.range(0, 20_000, 1, 7).selectExpr(
        "id", "if(id % 2 = 0, 7, id) AS a", "7 AS b", "cast(null AS long) AS c"
    )
    _, dim = _zoned(session)
    out = attach_all(facts, _lookups(facts, dim), 10**9).select(F.spark_partition_id().alias("p"))
    assert out.count() == 60_004  # keys 5 and 7 are there twice
    assert out.groupBy("p").count().agg(F.max("count")).first()[0] < 60_000 / 6


def test_larger_dimensions_have_more_parts():
    small, large, huge = (Lookup(None, "a", "b", [], 0, n) for n in (10, 10**6, 10**9))
    assert shares([large, large, small], 600) == [25, 24, 1]
    assert shares([large, small], 8) == [8, 1]
    assert shares([huge, small], 2)[0] >= 10**9 / CELL_BYTES


def test_derived_columns_that_were_changed_are_moved(staged, zones, weather):
    assert len(enrich.derived_columns(staged)) == 8
    other = staged.withColumn("pickup_hour", F.lit(3))
    assert enrich.derived_columns(other) == []
    assert enrich.derived_columns(staged.drop("is_night")) == []
    large = enrich.fact_trips(other, zones, weather, zones_small=False, weather_small=False)
    assert _sorted(large) == _sorted(enrich.fact_trips(other, zones, weather))
