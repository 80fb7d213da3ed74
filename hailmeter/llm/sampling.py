"""A bounded, repeatable training sample of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _share(key: Column, n: Column, per_label: int) -> Column:
    return F.pmod(key, F.lit(1_000_003)) / 1_000_003 * n < per_label


def bounded_sample(labelled: DataFrame, label: str, per_label: int) -> DataFrame:
    """(label, text) of about `per_label` rows of each label (all, where there are fewer).

    A row of (doc_id, text, label) is chosen by a hash of itself against a share that the
    counts of all rows fix, so a retried task chooses the same rows and no group is
    ever sorted; a row that is repeated counts once, however often it is there.
    """
    counts = labelled.groupBy(label).agg(F.count("*").alias("_n"))
    return (
        labelled.withColumn("_key", F.xxhash64(F.col("doc_id"), F.col("text")))
        .join(F.broadcast(counts), label)
        .filter(_share(F.col("_key"), F.col("_n"), per_label))
        .groupBy(label, "_key")
        .agg(F.first("text").alias("text"))
        .drop("_key")
    )


def bounded_labels(labels: DataFrame, label: str, per_label: int) -> DataFrame:
    """(doc_id, label) of about `per_label` distinct rows of each label, chosen alike.

    Chosen before any text is read, so texts are met by a bounded broadcast.
    """
    marks = labels.select("doc_id", label).distinct()
    counts = marks.groupBy(label).agg(F.count("*").alias("_n"))
    return (
        marks.join(F.broadcast(counts), label)
        .filter(_share(F.xxhash64("doc_id", label), F.col("_n"), per_label))
        .select("doc_id", label)
    )
