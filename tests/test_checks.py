"""Every kind of expectation passes and fails as it should; gates and pipeline."""

import pytest

from hailmeter.catalog.queries import Scene
from hailmeter.plans import expectations as x
from hailmeter.plans import pipeline
from hailmeter.plans.quality import table_counts


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (None, None, None), (3, "z", 9)], "k int, v string, parent int"
    )
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    return {"child": child, "parent": parent}


@pytest.mark.parametrize(
    "check, failures",
    [
        (x.Expectation("child", "k", "not_null"), 1),
        (x.Expectation("parent", "id", "not_null"), 0),
        (x.Expectation("child", "k", "unique"), 1),
        (x.Expectation("parent", "id", "unique"), 0),
        (x.Expectation("child", "k,v", "unique"), 0),
        (x.Expectation("child", "v", "accepted_values", values=("a", "b")), 1),
        (x.Expectation("child", "v", "accepted_values", values=("a", "b", "z")), 0),
        (x.Expectation("child", "parent", "relationship", parent=("parent", "id")), 1),
        (x.Expectation("parent", "id", "relationship", parent=("child", "parent")), 0),
    ],
)
def test_failures(tables, check, failures):
    row = x.run_expectations(tables, [check]).first()
    assert (row.failures, row.status) == (failures, "fail" if failures else "pass")


def test_warnings_do_not_stop(tables):
    warn = x.Expectation("child", "k", "not_null", "warn")
    results = x.run_expectations(tables, [warn])
    assert x.enforce(results).first().status == "warn"
    with pytest.raises(x.ExpectationError, match="not_null:child.k"):
        x.enforce(x.run_expectations(tables, [x.Expectation("child", "k", "not_null")]))


def test_hot_orphan_key_is_counted_in_full(spark):
    child = spark.range(3000).selectExpr("CASE WHEN id % 3 > 0 THEN -1 ELSE 1 END AS k")
    parent = spark.createDataFrame([(1,)], "id int")
    assert x.relationship_failures(child, "k", parent, "id").first()[0] == 2000


def test_suite_has_32_checks():
    assert len(x.SUITE) == 32
    assert sum(e.severity == "warn" for e in x.SUITE) == 4


def test_gate_stops_on_a_small_table(tables):
    counts = table_counts(tables)
    assert [r.passed for r in x.RowGate({"child": 4}).check(counts).collect()] == [True, True]
    with pytest.raises(x.ExpectationError, match="child: 4 rows, expected 5"):
        x.RowGate({"child": 5}).enforce(counts)


def test_pipeline_is_idempotent_and_reconciles(spark, sf_dir, tmp_path):
    scene = Scene(spark, sf_dir)
    out = str(tmp_path / "tables")
    for _ in range(2):
        stored, summary, results = pipeline.run_pipeline(spark, scene.landed, out)
    rows = {r.table_name: r.row_count for r in summary.collect()}
    assert len(rows) == 11
    assert rows["stg_trips"] == rows["yellow_raw"] + rows["green_raw"]
    assert rows["fct_trips"] == stored["stg_trips"].filter("is_valid").count()
    in_mart = stored["mart_weather_demand"].selectExpr("sum(trip_count)").first()[0]
    outside = stored["fct_trips"].filter(
        "pickup_borough IS NULL OR pickup_borough IN ('Unknown', 'N/A', 'EWR')"
    )
    assert in_mart + outside.count() == rows["fct_trips"]
    assert {r.status for r in results.collect()} <= {"pass", "warn"}
    assert sorted(map(str, stored["fct_trips"].collect())) == sorted(map(str, scene.fact.collect()))


def test_pipeline_stops_at_the_gate(spark, sf_dir, tmp_path):
    scene = Scene(spark, sf_dir)
    settings = pipeline.Settings(gate=x.PRODUCTION_GATE)
    with pytest.raises(x.ExpectationError, match="yellow_raw"):
        pipeline.run_pipeline(spark, scene.landed, str(tmp_path / "t"), settings)


def test_checks_that_were_observed_scan_nothing(spark, tables):
    checks = [x.Expectation("child", "k", "not_null"), x.Expectation("child", "v", "accepted_values", values=("a",))]
    seen = {c.name: n for c, n in zip(checks, (1, 2))}
    observed = x.run_expectations(tables, checks, counted=seen)
    assert [tuple(r) for r in observed.collect()] == [tuple(r) for r in x.run_expectations(tables, checks).collect()]


def test_checks_write_no_table(spark, sf_dir, monkeypatch):
    from hailmeter.catalog import queries
    from pyspark.sql import DataFrameWriter

    Scene(spark, sf_dir).bronze  # stored once per application
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **b: pytest.fail("a table is written"))
    for name in ("expect_not_null", "expect_accepted_values", "expect_relationship", "layer_counts"):
        assert queries.QUERIES[name](Scene(spark, sf_dir)).count() > 0
