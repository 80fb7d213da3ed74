"""Edge rows of the silver layer."""

import pytest
from pyspark.sql import functions as F

from hailmeter.functions import clock, money, rules, sky
from hailmeter.operators import conform
from hailmeter.plans import quality


@pytest.fixture(scope="module")
def stage(make_feed):
    def run(*overrides):
        return conform.stage_trips(make_feed("yellow", *overrides), make_feed("green")).collect()

    return run


@pytest.mark.parametrize(
    "pickup, dropoff, minutes, valid",
    [
        ("2025-03-05 10:00:59", "2025-03-05 10:01:00", 1, True),
        ("2025-03-05 10:00:59", "2025-03-05 10:00:01", 0, True),
        ("2025-03-05 10:01:00", "2025-03-05 10:00:59", -1, False),
        ("2025-03-05 23:59:59", "2025-03-06 00:00:00", 1, True),
        ("1969-12-31 23:58:30", "1969-12-31 23:59:10", 1, False),
    ],
)
def test_duration_counts_minute_boundaries(stage, pickup, dropoff, minutes, valid):
    (row,) = stage(dict(pickup=pickup, dropoff=dropoff))
    assert row.trip_duration_minutes == minutes
    assert row.is_valid is valid


def test_reasons_keep_their_order(stage):
    (row,) = stage(dict(fare_amount=-5.0, total_amount=-5.0, trip_distance=150.0))
    assert row.dq_flag_reason == "negative_fare, negative_total, extreme_distance"
    assert row.is_valid is False


def test_clean_row_has_an_empty_reason(stage):
    (row,) = stage({})
    assert (row.is_valid, row.dq_flag_reason) == (True, "")


def test_unknown_values_break_no_rule(stage):
    (row,) = stage(
        dict(pickup=None, dropoff=None, fare_amount=None, total_amount=None, trip_distance=None)
    )
    assert (row.is_valid, row.dq_flag_reason) == (True, "")
    assert (row.is_night, row.is_weekend, row.is_rush_hour) == (False, False, False)


@pytest.mark.parametrize(
    "distance, reason",
    [(100.0, ""), (0.0, ""), (-1.0, "negative_distance"), (100.1, "extreme_distance")],
)
def test_distance_limits(stage, distance, reason):
    (row,) = stage(dict(trip_distance=distance))
    assert row.dq_flag_reason == reason


def test_out_of_range_periods(stage):
    rows = stage(
        dict(pickup="2024-03-05 10:00:00", dropoff="2024-03-05 10:05:00"),
        dict(pickup="2025-06-05 10:00:00", dropoff="2025-06-05 10:05:00"),
    )
    assert [r.dq_flag_reason for r in rows] == ["out_of_range_year", "out_of_range_month"]


def test_rules_take_parameters(make_feed):
    checks = rules.trip_rules(years=(2024,), months=(6, 6), max_distance=5.0)
    feed = make_feed(
        "yellow",
        dict(pickup="2024-06-05 10:00:00", dropoff="2024-06-05 10:05:00", trip_distance=6.0),
    )
    (row,) = conform.stage_trips(feed, make_feed("green"), checks).collect()
    assert row.dq_flag_reason == "extreme_distance"


def test_weekday_flags(stage):
    # Saturday 08:00 and Sunday 17:00 are weekend, so not rush.
    rows = stage(
        dict(pickup="2025-03-08 08:00:00", dropoff="2025-03-08 08:05:00"),
        dict(pickup="2025-03-09 17:00:00", dropoff="2025-03-09 17:05:00"),
    )
    assert [(r.pickup_dayofweek, r.is_weekend, r.is_rush_hour) for r in rows] == [
        (6, True, False),
        (0, True, False),
    ]


def test_rush_and_night_edges(stage):
    times = ["06:59", "07:00", "08:59", "09:00", "17:00", "18:59", "19:00"]
    rows = stage(*[dict(pickup=f"2025-03-03 {t}:00", dropoff="2025-03-03 23:00:00") for t in times])
    assert [r.is_rush_hour for r in rows] == [False, True, True, False, True, True, False]
    rows = stage(
        *[dict(pickup=f"2025-03-03 {h:02}:30:00", dropoff="2025-03-04 00:00:00") for h in (5, 6, 19, 20)]
    )
    assert [r.is_night for r in rows] == [True, False, False, True]


def test_skipped_dst_hour_stays(stage):
    (row,) = stage(dict(pickup="2025-03-09 02:30:00", dropoff="2025-03-09 03:10:00"))
    assert (row.pickup_hour, row.trip_duration_minutes) == (2, 40)


def test_feeds_fill_each_other_with_null(make_feed):
    staged = conform.stage_trips(make_feed("yellow", {}), make_feed("green", {}))
    assert len(staged.columns) == 33
    yellow, green = sorted(staged.collect(), key=lambda r: r.taxi_type, reverse=True)
    assert (yellow.airport_fee, yellow.trip_type) == (0.0, None)
    assert (green.airport_fee, green.trip_type) == (None, 1)


def test_payment_labels(spark):
    df = spark.createDataFrame([(c,) for c in (0, 1, 2, 3, 4, 5, 6, 7, None)], "code int")
    labels = [r[0] for r in df.select(money.payment_label(F.col("code"))).collect()]
    assert labels == [
        "Unknown", "Credit Card", "Cash", "No Charge", "Dispute", "Unknown", "Voided",
        "Unknown", "Unknown",
    ]


def test_weather_categories(spark):
    expected = {
        1: "Clear", 3: "Cloudy", 46: "Other", 48: "Fog", 57: "Drizzle", 60: "Other", 67: "Rain",
        68: "Other", 77: "Snow", 82: "Rain Showers", 86: "Snow Showers", 99: "Thunderstorm",
        None: "Other",
    }
    df = spark.createDataFrame([(c,) for c in expected], "code int")
    got = {r[0]: r[1] for r in df.select("code", sky.category(F.col("code"))).collect()}
    assert got == expected


@pytest.mark.parametrize(
    "code, snow, wind, adverse",
    [
        (60, 0.0, 0.0, False), (61, 0.0, 0.0, True), (0, 0.0, 25.0, False), (0, 0.0, 25.1, True),
        (0, 0.01, 0.0, True), (None, 0.1, None, True), (None, None, None, False),
    ],
)
def test_adverse_terms(make_weather, code, snow, wind, adverse):
    staged = conform.stage_weather(make_weather(("2025-01-01 00:00:00", code, snow, wind)))
    assert len(staged.columns) == 17
    assert staged.first().is_adverse_weather is adverse


def test_descriptions_default(spark):
    df = spark.createDataFrame([(0,), (99,), (50,), (None,)], "code int")
    got = [r[0] for r in df.select(sky.description(F.col("code"))).collect()]
    assert got == ["Clear sky", "Thunderstorm with heavy hail", "Unknown", "Unknown"]


def test_month_labels(spark):
    df = spark.createDataFrame([(1,), (12,), (13,)], "m int")
    got = [r[0] for r in df.select(clock.month_label(F.col("m"))).collect()]
    assert got == ["Jan", "Dec", None]


def test_hour_index_agrees_with_its_parts(spark):
    df = spark.sql(
        "SELECT explode(array(TIMESTAMP_NTZ '2025-03-09 02:30:00',"
        " TIMESTAMP_NTZ '1969-12-31 23:10:00')) AS ts"
    )
    ts = F.col("ts")
    whole, parts = df.select(
        F.collect_list(clock.hour_index(ts)),
        F.collect_list(clock.hour_index_of(F.to_date(ts), F.hour(ts))),
    ).first()
    assert whole == parts


def test_rule_counts_cover_the_invalid_rows(make_feed):
    feed = make_feed(
        "yellow", {}, dict(fare_amount=-1.0), dict(fare_amount=-1.0, total_amount=-1.0)
    )
    staged = conform.stage_trips(feed, make_feed("green"))
    counts = {r.rule_name: r.row_count for r in quality.dq_rule_counts(staged).collect()}
    assert counts["negative_fare"] == 2 and counts["negative_total"] == 1
    share = {r.is_valid: r.pct for r in quality.validity_share(staged).collect()}
    assert share == {True: 33.33, False: 66.67}


def test_exploratory_counts_bound_short_trips_at_zero(make_feed):
    feed = make_feed(
        "yellow",
        dict(dropoff="2025-03-05 10:00:30"),
        dict(dropoff="2025-03-05 09:59:00"),
        dict(dropoff="2025-03-05 15:00:00", passenger_count=None),
        dict(trip_distance=0.0, fare_amount=5.0, passenger_count=0.0),
        dict(trip_distance=0.0, fare_amount=5.5),
    )
    row = quality.dq_exploratory_counts(conform.stage_trips(feed, make_feed("green"))).first()
    assert tuple(row) == (2, 1, 1, 1)
