"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given as over
from hypothesis import settings
from hypothesis import strategies as st

from hailmeter.llm import runs

from . import brute


def plain_runs(w, times=4, least=6):
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            own = w[s : s + length]
            smaller = any(own[p:] == own[:-p] for p in range(1, q))
            if length >= max(least, times * q) and not smaller:
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = brute.words(text)
    n = len(w)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def array_runs(texts, **options):
    flat = np.array([hash((x, 9)) for t in texts for x in t], dtype=np.int64).view(np.uint64)
    counts = np.array([len(t) for t in texts], dtype=np.int64)
    out = runs.find_runs(flat, counts, **options)
    rows = zip(out.row.tolist(), out.start.tolist(), out.length.tolist(), out.period.tolist(), strict=True)
    by = [[] for _ in texts]
    for row, *run in rows:
        by[row].append(tuple(run))
    return by


@settings(max_examples=150, deadline=None)
@over(st.lists(st.lists(st.sampled_from("ab"), max_size=70), min_size=1, max_size=4))
def test_runs_of_two_letters(texts):
    assert array_runs(texts) == [plain_runs(t) for t in texts]
    assert array_runs(texts, times=3, least=2) == [plain_runs(t, 3, 2) for t in texts]


def test_planted_runs():
    rng = random.Random(8)
    texts = []
    for period in (1, 2, 3, 5, 7, 8, 16, 31, 64, 100):
        base = [rng.randrange(50) for _ in range(period)]
        lead = [rng.randrange(50) for _ in range(rng.randrange(40))]
        cut = rng.randrange(period)
        texts.append(lead + base * rng.randrange(3, 7) + base[:cut] + lead[::-1])
    texts += [[], [1], [1] * 5, [1] * 6, [1] * 5000, [1, 2] * 3, [1, 2] * 4]
    assert array_runs(texts) == [plain_runs(t) for t in texts[:-5]] + [
        plain_runs([1] * 5), [(0, 6, 1)], [(0, 5000, 1)], [], [(0, 8, 2)]
    ]


def test_runs_need_three_periods():
    with pytest.raises(ValueError):
        array_runs([[1, 1, 1]], times=2)


def test_rows_equal_brute_force(awkward, given):
    docs = given("documents").limit(200).unionByName(awkward.filter("n_chars < 5000 or n_chars is null"))
    want = sorted((plain_row(r.doc_id, r.text) for r in docs.collect()), key=repr)
    got = sorted((tuple(r) for r in runs.run_digests(docs).collect()), key=repr)
    assert got == want
    assert any(r[1] for r in got)


def test_long_text_and_clashes(spark, awkward, nothing, clashing):
    rows = [(10, "a b c " * 40_000 + "end", "en", "x", 1), (11, "w " * 100_001, None, None, 1)]
    long = spark.createDataFrame(rows, awkward.schema)
    found = [tuple(r) for r in runs.periodic_runs(long).orderBy("doc_id").collect()]
    assert found == [(10, 0, 120_000, 3), (11, 0, 100_001, 1)]
    plain = sorted(map(repr, runs.run_digests(awkward).collect()))
    assert sorted(map(repr, runs.run_digests(clashing(awkward)).collect())) == plain
    assert runs.run_digests(nothing).count() == 0 and runs.periodic_runs(nothing).count() == 0
