"""What Python tasks hold at once."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa

from hailmeter.llm import language, linedup, tokens

from .conftest import SCHEMA


def test_training_a_pair_holds_less_than_the_whole_matrix():
    texts = [f"{i} {'pan pon pin' if i % 2 else 'xur xor xir'} {i * 7919}" for i in range(1500)]
    frame = pd.DataFrame(
        {"lang": ["de" if i % 2 else "en" for i in range(1500)], "text": texts, "pair": "en|de"}
    )
    tracemalloc.start()
    try:
        made = language._train_pair(frame)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(made["model"].iloc[0]) == 4 * ((1 << language.BITS) + 1)
    assert peak < 4 * len(texts) << language.BITS


def test_training_rows_are_the_matrix_however_they_are_held():
    rng = np.random.default_rng(3)
    sparse, whole = (
        (rng.random((7, 1 << language.BITS)) * (rng.random((7, 1 << language.BITS)) < share))
        .astype(np.float32)
        for share in (0.01, 0.99)
    )
    sparse[:, 5] = 1
    rows = language._Rows(iter([sparse, whole, sparse]))
    assert [isinstance(b, tuple) for b in rows.blocks] == [True, False, True]
    x = np.concatenate([sparse, whole, sparse]).astype(np.float64)
    w, by = rng.standard_normal((1 << language.BITS) + 1), rng.standard_normal(21)
    assert np.allclose(rows.margins(w.astype(np.float32)), x @ w[:-1] + w[-1], atol=1e-2)
    assert np.allclose(rows.summed(by), np.append(x.T @ by, by.sum()), atol=1e-4)


def _most_bytes(docs):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    return max(r.n for r in docs.coalesce(1).mapInArrow(sizes, "n long").collect())


def test_long_texts_come_in_batches_of_bounded_bytes(spark):
    session = spark.newSession()
    rows = [(i, f"word{i} " * 250_000, "en", "a", None) for i in range(8)]
    for operator in (linedup.with_unique_lines, language.determined):
        session.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        docs = session.createDataFrame(rows, SCHEMA)
        assert operator(docs).count() == 8
        assert _most_bytes(docs) < 8_000_000


def test_tables_of_powers_are_as_long_as_the_chunks(monkeypatch):
    monkeypatch.setattr(tokens, "_powers", {})
    for chunk in tokens.chunks(pa.array(["some words of a line\n" * 9] * 900), 60_000):
        linedup.line_words(chunk)
    assert [len(t) for t in tokens._powers.values()] == [1 << 16, 1 << 16]
