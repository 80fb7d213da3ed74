"""Every named query against its DuckDB twin."""

import duckdb
import pytest

from __spark_entry__ import _bind, entry
from check import TABLES, compare
from hailmeter.catalog.oracle import ORACLE
from hailmeter.catalog.queries import QUERIES

ROWS_ONLY = {
    "davies_bouldin_by_k",
    "k_comparison",
    "centroid_table_k4",
    "centroid_table_k6",
    "assign_clusters",
}


def queries():
    return {name: _bind(build) for name, build in QUERIES.items()}


def oracle_sql():
    return ORACLE


@pytest.fixture(scope="module")
def connection(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def test_only_trained_models_lack_a_twin():
    assert set(queries()) - set(oracle_sql()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_oracle(spark, connection, sf_dir, name):
    state, rows, _, note = compare(
        spark, connection, name, queries()[name], oracle_sql()[name], sf_dir
    )
    assert state == "ok", note
    assert not note, note


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_model_query_runs(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0
