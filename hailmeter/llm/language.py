"""Operator 7: language ID by hierarchical discrimination.

First a language family is predicted, by multinomial naive Bayes over hashed character
n-grams; then one-versus-one linear support vector machines (squared hinge, n-gram
vectors of unit length) tell the languages inside that family apart, by votes and
then by summed margins. The family of a language is a parameter; a language that it
doesn't name is a family of its own.

Training takes at most about `SAMPLE_PER_LANGUAGE` labelled texts of each language
(whole texts, chosen by a hash of the text). Each pair of languages is trained as one
Spark task on its bounded share of the sample; scoring runs over all rows, whole
texts, in one pass without a shuffle.

Defined results: a null text, or one without any letter, is `und` with score 0; with
no labelled rows at all everything is `und`. Rows with a null label are never learned
from, but are predicted. Repeated rows get equal predictions; an empty table gives an
empty result; input columns besides doc_id and text are no part of a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailmeter.llm import ngrams
from hailmeter.llm.common import bounded_batches, fold, stored
from hailmeter.llm.sampling import bounded_sample

UNDETERMINED = "und"
SAMPLE_PER_LANGUAGE = 1500
ORDERS = (1, 2, 3)
BITS = 13
ROWS_AT_ONCE = 256

FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "it", "pt", "ca", "gl", "ro", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk"),
}
HELD_OUT_FOLDS, HELD_OUT = 4, 2

_LETTER = re.compile(r"[^\W\d_]")


def family_of(lang: str, families: dict[str, tuple[str, ...]] = FAMILIES) -> str:
    return next((f for f, members in families.items() if lang in members), f"only-{lang}")


def _counts(texts: pa.Array) -> Iterator[np.ndarray]:
    """n-gram counts, in blocks of a bounded number of rows."""
    block: list[np.ndarray] = []
    for grams in ngrams.batch_grams(texts, ORDERS, BITS):
        block.append(np.bincount(grams, minlength=1 << BITS).astype(np.float32))
        if len(block) == ROWS_AT_ONCE:
            yield np.stack(block)
            block = []
    if block:
        yield np.stack(block)


def _unit(counts: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class _Rows:
    """The vectors of a training sample: each block as its cells that aren't 0, or whole.

    Most texts hold few of the n-grams, so the cells take less; a block of very long texts
    that fill them stays whole, which bounds it.
    """

    def __init__(self, blocks: Iterator[np.ndarray]):
        self.blocks = [self._packed(x) for x in blocks]

    @staticmethod
    def _packed(x: np.ndarray):
        row, column = np.nonzero(x)
        if 6 * len(row) >= x.nbytes:
            return x
        # a text has an n-gram at least (of the spaces around it), so no row is without cells
        sizes = np.bincount(row, minlength=len(x))
        return sizes, np.cumsum(sizes) - sizes, column.astype(np.uint16), x[row, column]

    def margins(self, w: np.ndarray) -> np.ndarray:
        """x @ w, where the last weight is the bias."""
        found = [np.zeros(0, dtype=np.float32)]
        for block in self.blocks:
            if isinstance(block, tuple):
                _, begins, column, value = block
                found.append(np.add.reduceat(value * w[column], begins))
            else:
                found.append(block @ w[:-1])
        return np.concatenate(found) + w[-1]

    def summed(self, by: np.ndarray) -> np.ndarray:
        """x.T @ by, and the sum of `by` for the bias."""
        total = np.zeros((1 << BITS) + 1, dtype=np.float64)
        total[-1] = by.sum()
        at = 0
        for block in self.blocks:
            if isinstance(block, tuple):
                sizes, _, column, value = block
                own = by[at : at + len(sizes)].astype(np.float32)
                total[:-1] += np.bincount(
                    column, value * np.repeat(own, sizes), minlength=1 << BITS
                )
                at += len(sizes)
            else:
                total[:-1] += block.T @ by[at : at + len(block)].astype(np.float32)
                at += len(block)
        return total.astype(np.float32)


def _fit_svm(x: _Rows, y: np.ndarray, cost: float = 30.0, steps: int = 150) -> np.ndarray:
    """Weights of an L2-regularised squared-hinge machine (accelerated descent), bias last."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    rate = 1.0 / (1.0 + 4.0 * cost)
    w = np.zeros((1 << BITS) + 1, dtype=np.float32)
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * x.margins(ahead))
        grad = ahead - cost * 2 * x.summed(weight * y * slack)
        new = ahead - rate * grad
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + np.float32((t - 1) / t_new) * (new - w)
        w, t = new, t_new
    return w


def _train_pair(frame: pd.DataFrame) -> pd.DataFrame:
    one, two = frame["pair"].iloc[0].split("|")
    frame = frame.sort_values(["lang", "text"], kind="stable")
    x = _Rows(_unit(counts) for counts in _counts(pa.array(frame["text"], pa.string())))
    y = np.where(frame["lang"] == one, 1.0, -1.0).astype(np.float32)
    return pd.DataFrame({"one": [one], "two": [two], "model": [_fit_svm(x, y).tobytes()]})


def _sum_counts(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << BITS, dtype=np.float64)
    for counts in _counts(pa.array(frame["text"], pa.string())):
        total += (counts / np.maximum(1, counts.sum(axis=1, keepdims=True)) ** 0.5).sum(axis=0)
    return pd.DataFrame(
        {"lang": [frame["lang"].iloc[0]], "n": [len(frame)], "model": [total.tobytes()]}
    )


def train(labelled: DataFrame, families=FAMILIES, per_language: int = SAMPLE_PER_LANGUAGE):
    """(family names, priors and log odds, pairs of languages and their machines)."""
    bounded_batches(labelled.sparkSession)
    sample = stored(
        bounded_sample(
            labelled.filter("lang is not null and text is not null"),
            "lang",
            per_language,
        ),
        "language-sample",
    )
    rows = (
        sample.groupBy("lang")
        .applyInPandas(_sum_counts, "lang string, n long, model binary")
        .collect()
    )
    languages = sorted(r["lang"] for r in rows)
    members: dict[str, list[str]] = {}
    for lang in languages:
        members.setdefault(family_of(lang, families), []).append(lang)
    names = sorted(members)
    sums = {r["lang"]: np.frombuffer(r["model"]) for r in rows}
    log_odds = np.zeros((1 << BITS, max(1, len(names))), dtype=np.float32)
    for i, name in enumerate(names):
        total = sum(sums[lang] for lang in members[name]) + 0.01
        log_odds[:, i] = np.log(total / total.sum())
    pairs = [p for name in names for p in combinations(members[name], 2)]
    machines = {}
    if pairs:
        spark = labelled.sparkSession
        wanted = spark.createDataFrame(
            [(lang, f"{a}|{b}") for a, b in pairs for lang in (a, b)], "lang string, pair string"
        )
        # a stated number of partitions is not merged again: pairs train side by side
        trained = (
            sample.join(F.broadcast(wanted), "lang")
            .repartition(max(2, len(pairs)), "pair")
            .groupBy("pair")
            .applyInPandas(_train_pair, "one string, two string, model binary")
            .collect()
        )
        machines = {
            (r["one"], r["two"]): np.frombuffer(r["model"], dtype=np.float32) for r in trained
        }
    return names, members, log_odds, machines


def _predict(counts: np.ndarray, model) -> tuple[list[str], np.ndarray]:
    names, members, log_odds, machines = model
    odds = (counts @ log_odds).astype(np.float64)
    odds = odds - odds.max(axis=1, keepdims=True)
    share = np.exp(odds) / np.exp(odds).sum(axis=1, keepdims=True)
    best = share.argmax(axis=1)
    langs = [""] * len(counts)
    score = share[np.arange(len(counts)), best]
    for f, name in enumerate(names):
        rows = np.flatnonzero(best == f)
        own = members[name]
        if not len(rows):
            continue
        if len(own) == 1:
            for r in rows:
                langs[r] = own[0]
            continue
        x = _unit(counts[rows])
        votes = np.zeros((len(rows), len(own)))
        sure = np.full((len(rows), len(own)), np.inf)
        for (a, b), w in machines.items():
            if a not in own or b not in own:
                continue
            i, j = own.index(a), own.index(b)
            margin = x @ w[:-1] + w[-1]
            # a vote each, and summed margins (less than a vote) to settle ties
            votes[:, i] += (margin >= 0) + np.tanh(margin) / (4 * len(own))
            votes[:, j] += (margin < 0) - np.tanh(margin) / (4 * len(own))
            sure[:, i] = np.minimum(sure[:, i], margin)
            sure[:, j] = np.minimum(sure[:, j], -margin)
        chosen = votes.argmax(axis=1)
        for r, c in zip(rows, chosen, strict=True):
            langs[r] = own[c]
        margin = sure[np.arange(len(rows)), chosen]
        score[rows] *= 1 / (1 + np.exp(-3 * np.clip(margin, -10, 10)))
    return langs, score


def _predict_batches(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            lettered = [bool(t and _LETTER.search(t)) for t in text.to_pylist()]
            langs: list[str] = []
            scores: list[np.ndarray] = [np.zeros(0)]
            if model[0]:
                for counts in _counts(text):
                    part, score = _predict(counts, model)
                    langs += part
                    scores.append(score)
            else:
                langs = [UNDETERMINED] * len(text)
                scores.append(np.zeros(len(text)))
            score = np.where(lettered, np.clip(np.concatenate(scores), 0, 1), 0.0)
            pred = [a if ok else UNDETERMINED for a, ok in zip(langs, lettered, strict=True)]
            keep = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [
                    *keep,
                    pa.array(pred, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(lettered, pa.bool_()),
                ],
                names=[*batch.schema.names, "lang_pred", "score", "has_letter"],
            )

    return run


def held_out() -> Column:
    return F.coalesce(fold("doc_id", HELD_OUT_FOLDS) == HELD_OUT, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, text) of the rows that may be learned from."""
    return docs.filter(~held_out() & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )


def predict(rows: DataFrame, model) -> DataFrame:
    """Adds lang_pred, score and has_letter to rows, which have a column text."""
    added = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("has_letter", T.BooleanType()),
    ]
    return rows.mapInArrow(_predict_batches(model), T.StructType(rows.schema.fields + added))


def language_id(docs: DataFrame, families=FAMILIES) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    model = train(learnable(docs), families)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return predict(rows, model).drop("text", "has_letter")


def determined(docs: DataFrame, families=FAMILIES) -> DataFrame:
    """The documents in some language, with all their columns.

    Texts without a letter (null and empty ones too) go. Whatever has one stays, also where
    no label was there to learn from; a null lang becomes the predicted one, other values
    of lang and all other columns are left as they are. Repeated rows and rows of one
    doc_id stay, each for itself.
    """
    model = train(learnable(docs), families)
    numbered = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*numbered, F.col("text").cast("string").alias("text"))
    kept = predict(rows, model).filter("has_letter")
    # the prediction of a text that was judged; 'und' where there was nothing to learn from
    guessed = F.when(F.col("lang_pred") != UNDETERMINED, F.col("lang_pred"))
    return kept.select(
        *[
            (
                F.coalesce(F.col(f"_{i}"), guessed.cast(docs.schema[i].dataType))
                if c == "lang"
                else F.col(f"_{i}")
            ).alias(c)
            for i, c in enumerate(docs.columns)
        ]
    )
