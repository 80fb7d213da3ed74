"""Operator 10: toxicity by a character n-gram classifier with naive Bayes scaling.

A text is the set of its hashed character n-grams. Each n-gram's feature is its naive
Bayes log-count ratio (how much likelier it is in toxic than in other training
texts), and a logistic linear classifier is trained on those scaled features.

Training takes at most about `SAMPLE_PER_LABEL` labelled whole texts per label, chosen
by a hash of the text, in one task of bounded size; scoring runs over all rows and
whole texts in one pass. Labels are joined to documents by doc_id; only rows
whose crc32(doc_id) mod 5 is not 0 are learned from.

Defined results: a null or empty text gets the score of a text without n-grams but the
outer spaces; without labelled rows of both kinds every score is the share of toxic
labels (0 with none). A document with several labels is learned from once per label.
Null labels are ignored; repeated rows get equal scores; an empty table gives an empty
result; input columns besides doc_id and text are no part of a score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailmeter.llm import ngrams
from hailmeter.llm.common import fold, stored
from hailmeter.llm.sampling import bounded_labels, bounded_sample

SAMPLE_PER_LABEL = 2500
ORDERS = (4, 5, 6)
BITS = 20
EPOCHS = 8
MIN_TEXTS = 5
MIN_RATIO = 2.0
SMOOTHING = 1.0
HELD_OUT_FOLDS, HELD_OUT = 5, 0


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct buckets of each text, without sorting: the last writer of one stays."""
    last = np.zeros(1 << BITS, dtype=np.int32)
    for grams in ngrams.batch_grams(texts, ORDERS, BITS):
        place = np.arange(len(grams), dtype=np.int32)
        last[grams] = place
        yield grams[last[grams] == place]


def _fit(sets: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights per bucket (the ratio is multiplied in) and the bias."""
    size = 1 << BITS
    share = {True: np.full(size, SMOOTHING), False: np.full(size, SMOOTHING)}
    for grams, label in zip(sets, toxic, strict=True):
        share[bool(label)][grams] += 1
    ratio = np.log(
        (share[True] / (toxic.sum() + 2 * SMOOTHING))
        / (share[False] / ((~toxic).sum() + 2 * SMOOTHING))
    ).astype(np.float32)
    ratio[share[True] + share[False] < 2 * SMOOTHING + MIN_TEXTS] = 0
    # n-grams that tell nothing have a ratio near 0 and stay out of the classifier
    told = [grams[np.abs(ratio[grams]) > MIN_RATIO] for grams in sets]
    weight = np.zeros(size, dtype=np.float32)
    squares = np.full(size, 1e-2, dtype=np.float32)
    bias, bias_square = 0.0, 1e-2
    balance = np.where(toxic, 0.5 / toxic.mean(), 0.5 / (~toxic).mean())
    order = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in order.permutation(len(told)):
            grams = told[i]
            r = ratio[grams] / np.float32(np.sqrt(max(1, len(grams))))
            z = float(weight[grams] @ r) + bias
            g = balance[i] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic[i])
            grad = np.float32(g) * r + np.float32(1e-3) * weight[grams]
            squares[grams] += grad * grad
            weight[grams] -= 0.1 * grad / np.sqrt(squares[grams])
            bias_square += g * g
            bias -= 0.1 * g / np.sqrt(bias_square)
    return np.stack([ratio, weight]), bias


def _train(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["toxic", "text"], kind="stable")
    toxic = frame["toxic"].to_numpy() == 1
    sets = list(_sets(pa.array(frame["text"], pa.string())))
    model, bias = _fit(sets, toxic)
    return pd.DataFrame({"model": [model.tobytes()], "bias": [bias]})


def train(docs: DataFrame, marks: DataFrame, per_label: int = SAMPLE_PER_LABEL):
    """From documents and rows of (doc_id, toxic): the scaled classifier, or a constant score."""
    marks = marks.select("doc_id", F.col("toxic").cast("int")).filter("toxic in (0, 1)")
    chosen = stored(bounded_labels(marks, "toxic", per_label), "toxicity-labels")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sample = stored(
        bounded_sample(texts.join(F.broadcast(chosen), "doc_id"), "toxic", per_label),
        "toxicity-sample",
    )
    n, mean = sample.agg(F.count("*"), F.avg("toxic")).first()
    if not n or mean in (0.0, 1.0):
        return None, float(mean or 0.0)
    row = sample.groupBy(F.lit(1).alias("all")).applyInPandas(_train, "model binary, bias double")
    model, bias = row.first()
    return np.frombuffer(model, dtype=np.float32).reshape(2, -1), bias


def _score_batches(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    weights, bias = model
    packed = None if weights is None else weights[0] * weights[1]
    telling = None if weights is None else np.abs(weights[0]) > MIN_RATIO

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if packed is None:
                score = np.full(batch.num_rows, bias)
            else:
                z = [
                    packed[grams].sum(dtype=np.float64) / np.sqrt(max(1, telling[grams].sum()))
                    for grams in _sets(batch.column("text"))
                ]
                score = 1 / (1 + np.exp(-np.clip(np.array(z) + bias, -30, 30)))
            keep = [batch.column(n) for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(score, pa.float64())],
                names=[*(n for n in batch.schema.names if n != "text"), "score"],
            )

    return run


def held_out() -> Column:
    return F.coalesce(fold("doc_id", HELD_OUT_FOLDS) == HELD_OUT, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = train(docs, labels.filter(~held_out() & F.col("doc_id").isNotNull()))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    scored = rows.mapInArrow(
        _score_batches(model), "doc_id long, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
