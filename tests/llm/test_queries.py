"""Registered queries: names, twins in DuckDB, empty tables, clashing columns."""

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import compare
from hailmeter.llm import (
    decontamination,
    linedup,
    mixture,
    nearduplicates,
    quality,
    repeats,
    secret_scan,
)
from hailmeter.llm.queries import ORACLE, QUERIES

from .conftest import pairs

TABLES = "documents embeddings pages benchmark labels".split()


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) and "pipeline" not in oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    state, rows, _, note = compare(spark, con, name, QUERIES[name], ORACLE[name], sf_dir)
    assert state == "ok" and not note and rows, note


OPERATORS = {
    "mixture": lambda d, b: mixture.mix_sources(d),
    "lines": lambda d, b: linedup.dedup_lines(d)[0],
    "decontamination": decontamination.decontaminate,
    "secrets": lambda d, b: secret_scan.scan_secrets(d),
    "quality": lambda d, b: quality.quality_rules(d),
    "near": lambda d, b: nearduplicates.near_duplicates(d),
    "repeats": lambda d, b: repeats.remove_repeats(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_and_clashing(spark, nothing, awkward, clashing, given, name):
    run = OPERATORS[name]
    assert run(nothing, given("benchmark")).count() == 0
    want = run(awkward, given("benchmark"))
    got = run(clashing(awkward), given("benchmark"))
    assert pairs(got, *want.columns) == pairs(want, *want.columns)
    assert want.count() == awkward.count()


def test_decontamination_without_a_benchmark(awkward, given):
    out = decontamination.decontaminate(awkward, given("benchmark").limit(0))
    assert out.count() == awkward.count() and not out.filter("contaminated").count()


def test_pipeline_stages(spark, sf_dir, clashing):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_duplicates", "decontaminate", "mix"]
    docs = clashing(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    hits = decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    assert not hits.filter("contaminated").count()
    assert nearduplicates.near_duplicates(docs).filter("n_shingles > 0 and component_id <> doc_id").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == before


def test_pipeline_of_awkward_rows(spark, sf_dir, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "awkward")
        assert docs.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
