"""Hard negatives against brute force; the tree and its bounds."""

import math
import random

import numpy as np
import pytest

from hailmeter.llm import hardnegatives as hard

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    own = []
    for i, (vec_id, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        own.append((i, vec_id, label, [math.floor(256 * x) for x in v]))
    last = lambda r: (hard.LAST if r[1] is None else r[1], r[0])
    out = []
    for a in own:
        if a[1] is None or a[1] % 100:
            continue
        score = {b[0]: sum(x * y for x, y in zip(a[3], b[3])) for b in own}
        order = sorted(own, key=lambda b: (-score[b[0]], *last(b)))
        for p in [b for b in order if b[2] == a[2] and b[0] != a[0]][:5]:
            s = score[p[0]]
            fit = [
                b for b in order if b[2] != a[2] and 30 * s <= 100 * score[b[0]] <= 90 * s
            ]
            out += [(a[1], p[1], k, b[1], s, score[b[0]]) for k, b in enumerate(fit[:10], 1)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def f32(values):
    return [float(np.float32(x)) for x in values]


def made(seed, n, d=6, ties=False):
    rng = random.Random(seed)
    pick = (lambda: rng.choice([-0.5, 0.0, 0.25, 0.5])) if ties else (lambda: rng.gauss(0, 0.4))
    return [(i * 25, f32(pick() for _ in range(d)), rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("ties", [False, True])
def test_equals_brute_force(spark, monkeypatch, ties):
    monkeypatch.setattr(hard, "CHUNK_ROWS", 17)
    monkeypatch.setattr(hard, "BLOCK_ANCHORS", 7)
    rows = made(1, 300, ties=ties)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(hard.mined(df)) == plain(rows)


def test_groups_of_blocks(spark, monkeypatch):
    """With a small bound on a broadcast there are many groups and the same rows."""
    monkeypatch.setattr(hard, "BLOCK_ANCHORS", 5)
    monkeypatch.setattr(hard, "GROUP_BYTES", 3_000)
    rows = made(2, 200)
    assert rows_of(hard.mined(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_awkward_rows(spark, clashing):
    rows = made(3, 60)
    rows += [
        (None, f32([0.3] * 6), 1), (None, None, None), (6000, None, 1), (6100, f32([0.1] * 6), None),
        (6200, [0.1, None, 0.2], 1), (6300, [float("nan")] * 6, 1), (6400, [float("inf"), 1.0], 2),
        (6500, [], 0), (6600, f32([0.5, 0.5]), 2), (6700, [0.0] * 6, 0), (-100, f32([0.4] * 6), 1),
        (6800, f32([3e18, -2e18]), 1), (6901, f32([2e18, 1.0]), 2), (6902, f32([1e18, 4.0]), 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    big = {6800, 6901, 6902}
    got = rows_of(hard.mined(df))
    small = [r for r in rows if r[0] not in big]
    assert rows_of(hard.mined(spark.createDataFrame(small, SCHEMA))) == plain(small)
    assert all(-hard.LAST <= r[4] <= hard.LAST for r in got)
    assert rows_of(hard.mined(clashing(df))) == got
    assert hard.mined(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows(spark):
    rows = made(4, 40)
    rows += rows[:8]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert rows_of(hard.mined(df)) == plain(rows)


def test_tree_spans_and_is_minimal():
    points = np.random.default_rng(0).normal(size=(40, 3))
    order, parent, edge = hard.spanning_tree(points)
    assert sorted(order) == list(range(40)) and (parent[1:] < np.arange(1, 40)).all()
    at = points[order]
    assert np.allclose(np.linalg.norm(at[1:] - at[parent[1:]], axis=1), edge[1:])
    every = sorted(
        (float(np.linalg.norm(points[i] - points[j])), i, j) for i in range(40) for j in range(i)
    )
    root, total = list(range(40)), 0.0
    for length, i, j in every:
        a, b = root[i], root[j]
        if a != b:
            total += length
            root = [a if r == b else r for r in root]
    assert edge.sum() == pytest.approx(total)


def test_bounds_save_scores(spark, monkeypatch):
    """Near anchors: what the parent's score rules out is never scored."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(4, 8))
    points = np.floor(256 * (centers[rng.integers(0, 4, 600)] + 0.01 * rng.normal(size=(600, 8))))
    order, parent, edge = hard.spanning_tree(points[:60])
    block = hard.Block(
        parent, edge, order, np.zeros(60, np.int64), points[:60][order], np.full((60, 1), np.nan)
    )
    scored = []
    plain_dot = hard._dot
    monkeypatch.setattr(hard, "_dot", lambda a, b, e: scored.append(len(a)) or plain_dot(a, b, e))
    best = hard.Best(60, 1, 3)
    for at in range(0, 600, 100):
        own = np.arange(at, at + 100)
        rows = hard.Rows(own, own, np.zeros(100, np.int64), points[own])
        hard._descend(block, rows, best, True)
    assert 0 < sum(scored) < 0.5 * 59 * 600
    exact = points[:60][order] @ points.T
    exact[np.arange(60), order] = -np.inf
    want = -np.sort(-exact, axis=1)[:, :3]
    assert np.array_equal(best.score.reshape(60, 3), want)


def test_oracle_name_is_registered():
    from hailmeter.llm.queries import ORACLE

    assert "op12_hard_negatives" in ORACLE
