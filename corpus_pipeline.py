"""Corpus pipeline: documents through five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet
and read again as the next stage's documents. All but the last return the columns of
documents, extra ones included.

1. language ID: documents without a letter go; a null lang becomes the predicted one.
2. line dedup: later similar lines are cut out; a document without words left goes.
3. near duplicates: one document of each connected class stays.
4. decontamination: documents with a passage of the benchmark go.
5. mixture: how many words of each document the mix of sources takes.

Nulls in any column, empty and very long texts, ties, repeated rows and empty tables have
the results that the stages' operators state; an empty table gives an empty result.

SQL can't express the first stage (a trained classifier), so the whole has no twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hailmeter.llm import decontamination, language, linedup, mixture, nearduplicates
from hailmeter.llm.common import documents, stored, table

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.determined(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linedup.with_unique_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearduplicates.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.mix_sources(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: doc_id, source, size, source_size, target, taken."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
