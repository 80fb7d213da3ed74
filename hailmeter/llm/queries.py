"""The dealt operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailmeter.llm import (
    decontamination,
    hardnegatives,
    language,
    linedup,
    mixture,
    nearduplicates,
    quality,
    repeats,
    runs,
    secret_scan,
    sitetree,
    tokenids,
    toxicity,
)
from hailmeter.llm.common import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix_sources(documents(spark, sf_dir)).drop("source")


ORACLE["op1_mixture"] = f"SELECT * EXCLUDE (source) FROM ({mixture.oracle()})"


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir)).drop("n_lines", "failed_rules")


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return decontamination.decontaminate(documents(spark, sf_dir), benchmark).drop("spans", "items")


ORACLE["op3_decontamination"] = decontamination.oracle()


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(documents(spark, sf_dir))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir))


@query
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.main_text(table(spark, sf_dir, "pages"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, n_lines, n_removed = linedup.dedup_lines(documents(spark, sf_dir))
    return done.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(n_lines).alias("n_lines"),
        F.col(n_removed).alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearduplicates.near_duplicates(documents(spark, sf_dir))


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, sf_dir))


@query
def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.token_digests(documents(spark, sf_dir))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardnegatives.mined(table(spark, sf_dir, "embeddings"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(documents(spark, sf_dir))


ORACLE["op12_hard_negatives"] = hardnegatives.oracle()
ORACLE["op4_secrets"] = secret_scan.oracle()
ORACLE["op5_quality_rules"] = quality.oracle()
