"""Operator 12: hard negatives of anchors, with spanning-tree bounds on scores.

Anchors are dealt into blocks of bounded size, near ones together (by label and leading
component). In each block a minimum spanning tree over the anchors is built. Rows meet the
blocks in chunks: the root scores a chunk exactly, and for every child the scores at its
parent, plus or minus the edge's length times each row's norm, bound its own (Cauchy-
Schwarz). Only rows whose bounds overlap what the anchor still wants are scored again:
better than its worst positive so far in the first pass, in one of its positives' windows and
not worse than the worst of its best negatives so far in the second. Others go down the
tree with their bounds, which widen by each edge.

A task keeps the best few of each anchor and emits them once it has seen its rows; a window
over (tasks x few) rows per anchor merges them. Blocks are broadcast in groups of at most
`GROUP_BYTES`, one job a group, so no broadcast grows with the input: the anchors are a
stated query set that meets all rows, in blocks.

Scores are exact integers: components are floored multiples, products are summed in doubles
where every sum is sure to stay below 2**53, and as Python integers otherwise (then cut to
the range of a long).

Defined results: rows with a null label or vector, or a null or non-finite component, take
no part; an empty vector scores 0 with all; shorter vectors count as padded with zeros; a
null vec_id is no anchor, comes last among ties, and is returned as null (2**63 - 1 stands
for it inside and isn't told apart); repeated rows are rows of their own, so a copy of an
anchor is its nearest positive; an anchor without positives or negatives has no rows; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hailmeter.llm.common import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score in percent of its positive's.
LEAST_PERCENT, MOST_PERCENT = 30, 90
BLOCK_ANCHORS = 512
CHUNK_ROWS = 2_048
GROUP_BYTES = 64 * 1024 * 1024

LAST = 2**63 - 1
_EXACT = float(2**53)
_NONE = np.zeros(0, dtype=np.int64)

TREE = (
    "block long, place int, parent int, edge double, row long, vec_id long, label long, q array<double>"
)
FOUND = "anchor_row long, slot int, score long, vec_id long, row long"


def scaled(embeddings: DataFrame, label: Column | None = None, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, q) of the rows that take part; `row` tells repeated rows apart.

    Stored by the caller before `row` is used.
    """
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(
        values,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    return embeddings.filter(finite & F.col("label").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        # floor of a double, kept as one: a long can't hold every product
        F.transform(values, lambda x: _floor(x * scale)).alias("q"),
    )


def _floor(x: Column) -> Column:
    # beyond 2**53 every double is whole
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _padded(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's tree from point 0: order of joining, each one's parent place, edge length."""
    n = len(points)
    order, by = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    parent, edge = np.full(n, -1, dtype=np.int64), np.zeros(n)
    far, joined = np.full(n, np.inf), np.zeros(n, dtype=bool)
    place = np.zeros(n, dtype=np.int64)
    at = 0
    for step in range(n):
        order[step], place[at], joined[at] = at, step, True
        if step:
            parent[step], edge[step] = place[by[at]], far[at]
        own = np.linalg.norm(points - points[at], axis=1)
        near = ~joined & (own < far)
        far[near], by[near] = own[near], at
        at = int(np.argmin(np.where(joined, np.inf, far)))
    return order, parent, edge


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    number = 0
    for batch in batches:
        for at in range(0, len(batch), BLOCK_ANCHORS):
            some = batch.slice(at, BLOCK_ANCHORS)
            order, parent, edge = spanning_tree(_matrix(some.column("q")))
            some = some.take(pa.array(order))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(order), part * 2**32 + number)),
                    pa.array(np.arange(len(order), dtype=np.int32)),
                    pa.array(parent.astype(np.int32)),
                    pa.array(edge),
                    *[some.column(c) for c in ("row", "vec_id", "label", "q")],
                ],
                names=["block", "place", "parent", "edge", "row", "vec_id", "label", "q"],
            )
            number += 1


def anchor_trees(anchors: DataFrame, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """One row per anchor: its block, its place in the block's tree, parent and edge."""
    n = anchors.count()
    blocks = max(1, -(-n // block_anchors))
    dealt = anchors.withColumn("lead", F.try_element_at("q", F.lit(1)))
    near = [F.col("label"), F.col("lead"), F.col("row")]
    return (
        dealt.repartitionByRange(blocks, *near)
        .sortWithinPartitions(*near)
        .select("row", "vec_id", "label", "q")
        .mapInArrow(_trees, TREE)
    )


@dataclass
class Block:
    """The anchors of a tree, in the order of joining."""

    parent: np.ndarray
    edge: np.ndarray
    row: np.ndarray
    label: np.ndarray
    q: np.ndarray
    wanted: np.ndarray  # positives' scores by slot, NaN where there are fewer

    def levels(self) -> list[np.ndarray]:
        depth = np.zeros(len(self.parent), dtype=np.int64)
        for i in range(1, len(depth)):
            depth[i] = depth[self.parent[i]] + 1
        return [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]


@dataclass
class Rows:
    """A chunk of all rows."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    q: np.ndarray


def _dot(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Row-wise inner products as integers (as doubles while they are surely exact)."""
    if exact:
        return np.einsum("ij,ij->i", a, b)
    out = [sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for u, v in zip(a, b, strict=True)]
    return np.array([min(max(x, -LAST), LAST) for x in out], dtype=np.int64)


class Best:
    """The best few of each (anchor place, slot), by score, then vec_id, then row."""

    def __init__(self, anchors: int, slots: int, few: int):
        self.slots, self.few = slots, few
        self.key = self.score = self.vec_id = self.row = _NONE
        self.worst = np.full((anchors, slots), -np.inf)

    def add(self, key: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        if not len(key):
            return
        key = np.concatenate([self.key, key])
        score = np.concatenate([self.score, score.astype(np.int64)])
        vec_id = np.concatenate([self.vec_id, vec_id])
        row = np.concatenate([self.row, row])
        # ~score falls as score rises and never overflows
        order = np.lexsort((row, vec_id, ~score, key))
        key = key[order]
        first = np.searchsorted(key, key)
        rank = np.arange(len(key)) - first
        kept = order[rank < self.few]
        key, rank = key[rank < self.few], rank[rank < self.few]
        self.key, self.score = key, score[kept]
        self.vec_id, self.row = vec_id[kept], row[kept]
        full = rank == self.few - 1
        self.worst.reshape(-1)[key[full]] = self.score[full]

    def columns(self, block: Block) -> list[pa.Array]:
        place, slot = np.divmod(self.key, self.slots)
        return [
            pa.array(block.row[place]),
            pa.array(slot.astype(np.int32)),
            pa.array(self.score),
            pa.array(self.vec_id),
            pa.array(self.row),
        ]


def _descend(block: Block, rows: Rows, best: Best, positives: bool) -> None:
    """One chunk through a block's tree: bounds, exact scores where needed, the best few."""
    width = max(block.q.shape[1], rows.q.shape[1])
    anchors, points = _padded(block.q, width), _padded(rows.q, width)
    high = np.abs(anchors).max(initial=0.0) * np.abs(points).max(initial=0.0)
    exact = high * max(width, 1) < _EXACT
    norm = np.linalg.norm(points, axis=1)
    shape = (len(block.row), len(rows.row))
    low, top = np.full(shape, -np.inf), np.full(shape, np.inf)
    for level, own in enumerate(block.levels()):
        if level and exact:
            up = block.parent[own]
            # a little wider than the lengths say: they are rounded
            reach = block.edge[own, None] * norm[None, :] * (1 + 1e-9) + 1.0
            low[own], top[own] = low[up] - reach, top[up] + reach
        same = block.label[own, None] == rows.label[None, :]
        if positives:
            need = same & (top[own] >= best.worst[own, 0][:, None])
            need &= block.row[own, None] != rows.row[None, :]
        else:
            need = np.zeros(same.shape, dtype=bool)
            for slot in range(best.slots):
                score = block.wanted[own, slot][:, None]
                least = np.maximum(LEAST_PERCENT * score, 100 * best.worst[own, slot][:, None])
                # comparisons with NaN are false: no such positive
                need |= (100 * top[own] >= least) & (100 * low[own] <= MOST_PERCENT * score)
            need &= ~same
        if not level and exact:
            low[own] = top[own] = anchors[own] @ points.T  # the root scores all rows
        a, r = np.nonzero(need)
        if not len(a):
            continue
        if level or not exact:
            if exact and 4 * len(a) > need.size:
                score = (anchors[own] @ points.T)[a, r]
            else:
                score = _dot(anchors[own[a]], points[r], exact)
            low[own[a], r] = top[own[a], r] = score
        else:
            score = low[own[a], r]
        if positives:
            best.add(own[a], score, rows.vec_id[r], rows.row[r])
        else:
            _add_windows(block, rows, best, own[a], r, score.astype(np.int64))


def _add_windows(
    block: Block, rows: Rows, best: Best, a: np.ndarray, r: np.ndarray, score: np.ndarray
) -> None:
    big = max(np.abs(score).max(initial=0), np.nanmax(np.abs(block.wanted), initial=0)) >= 2**53 // 100
    whole = score.astype(object) if big else score
    for slot in range(best.slots):
        positive = block.wanted[a, slot]
        known = ~np.isnan(positive)
        positive = np.where(known, positive, 0)
        positive = np.array([int(x) for x in positive], dtype=object) if big else positive.astype(np.int64)
        inside = known & np.asarray(
            (LEAST_PERCENT * positive <= 100 * whole) & (100 * whole <= MOST_PERCENT * positive), dtype=bool
        )
        inside &= score >= best.worst[a, slot]
        best.add(
            a[inside] * best.slots + slot,
            score[inside],
            rows.vec_id[r[inside]],
            rows.row[r[inside]],
        )


def _search(positives: bool, few: int, slots: int):
    """A task's function over pairs of a chunk of rows and a block of anchors."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, tuple[Block, Best]] = {}
        for batch in batches:
            for i in range(len(batch)):
                name = batch.column("block")[i].as_py()
                if name not in blocks:
                    blocks[name] = _unpack(batch.column("anchors")[i].values, few, slots)
                own = batch.column("rows")[i].values
                rows = Rows(
                    *[own.field(c).to_numpy() for c in ("row", "vec_id", "label")],
                    _matrix(own.field("q")),
                )
                block, best = blocks[name]
                _descend(block, rows, best, positives)
        for block, best in blocks.values():
            yield pa.RecordBatch.from_arrays(
                best.columns(block), names=["anchor_row", "slot", "score", "vec_id", "row"]
            )

    return tasks


def _unpack(anchors: pa.StructArray, few: int, slots: int) -> tuple[Block, Best]:
    order = np.argsort(anchors.field("place").to_numpy())
    anchors = anchors.take(pa.array(order))
    scores = _matrix(anchors.field("scores"))
    sizes = np.diff(anchors.field("scores").offsets.to_numpy())
    wanted = np.full((len(order), slots), np.nan)
    known = np.arange(slots) < sizes[:, None]
    wanted[known] = _padded(scores, max(slots, scores.shape[1]))[:, :slots][known]
    block = Block(
        *[anchors.field(c).to_numpy() for c in ("parent", "edge", "row", "label")],
        _matrix(anchors.field("q")),
        wanted,
    )
    return block, Best(len(order), slots, few)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), CHUNK_ROWS):
            some = batch.slice(at, CHUNK_ROWS)
            names = ["row", "vec_id", "label", "q"]
            packed = pa.StructArray.from_arrays([some.column(c) for c in names], names=names)
            places = pa.array([0, len(some)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(places, packed)], names=["rows"]
            )


def _meet(rows: DataFrame, trees: DataFrame, positives: bool, few: int, slots: int) -> DataFrame:
    """The best few of each anchor and slot over all rows, `trees` with scores by slot."""
    packed = stored(
        trees.groupBy("block").agg(
            F.collect_list(
                F.struct("place", "parent", "edge", "row", "label", "q", "scores")
            ).alias("anchors"),
            F.sum(8 * (F.size("q") + F.size("scores") + 8)).alias("bytes"),
        ),
        "negatives-blocks",
    )
    # groups of blocks of bounded bytes; one row per block of BLOCK_ANCHORS anchors
    sizes = packed.agg(F.count("*").alias("n"), F.max("bytes").alias("most")).first()
    groups = max(1, -(-sizes["n"] * (sizes["most"] or 0) // GROUP_BYTES))
    dealt = packed.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    chunks = rows.mapInArrow(
        _chunks, "rows array<struct<row: long, vec_id: long, label: long, q: array<double>>>"
    )
    found = None
    for group in range(groups):
        # each chunk meets every block of the group: the key is the group's number
        own = F.broadcast(dealt.filter(F.col("group") == group))
        pairs = chunks.withColumn("group", F.explode(F.array(F.lit(group)))).join(own, "group")
        part = pairs.select("block", "anchors", "rows").mapInArrow(
            _search(positives, few, slots), FOUND
        )
        part = stored(part, "negatives-found")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= few)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `is_anchor` is a condition on vec_id; `label` replaces the column label. A positive is
    one of the first `positives` other rows of the anchor's label, a negative one of the
    first `negatives` rows of another label whose score lies between LEAST_PERCENT and
    MOST_PERCENT of the positive's.
    """
    rows = stored(scaled(embeddings, label), "negatives-rows")
    anchors = rows.filter((F.col("vec_id") != LAST) & is_anchor)
    trees = stored(anchor_trees(anchors), "negatives-trees")
    none = trees.withColumn("scores", F.array().cast("array<double>"))
    nearest = stored(_meet(rows, none, True, positives, 1), "negatives-positives")
    ranked = nearest.groupBy("anchor_row").agg(
        F.sort_array(F.collect_list(F.struct("rank", F.col("score").cast("double").alias("score")))).alias("s")
    )
    wanted = trees.join(
        ranked.select(F.col("anchor_row").alias("row"), F.col("s.score").alias("scores")), "row"
    )
    found = _meet(rows, wanted, False, negatives, positives)
    ids = trees.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    own = nearest.select(
        "anchor_row",
        (F.col("rank") - 1).alias("slot"),
        F.col("vec_id").alias("positive"),
        F.col("score").alias("positive_score"),
    ).join(ids, "anchor_row")
    known = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return found.join(own, ["anchor_row", "slot"]).select(
        "anchor_id",
        known("positive").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        known("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def shifted_label() -> Column:
    """The contract's label: (label + 1) % 10 where vec_id is divisible by 7."""
    moved = (F.col("label") + 1) % 10
    return F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))


def mined(embeddings: DataFrame) -> DataFrame:
    """The contract's rows: anchors are rows whose vec_id is divisible by 100."""
    return hard_negatives(embeddings, F.col("vec_id") % 100 == 0, shifted_label())


def oracle() -> str:
    return f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id, a.label = b.label AS same,
    list_inner_product(a.q, b.q)::BIGINT AS score
  FROM rows a, rows b WHERE a.vec_id % 100 = 0 AND a.r <> b.r),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, br) AS k
  FROM scored WHERE same QUALIFY k <= {POSITIVES}),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
    p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.k ORDER BY n.score DESC, n.vec_id, n.br)::INT AS rank
  FROM positives p JOIN scored n ON p.ar = n.ar AND NOT n.same
  WHERE {LEAST_PERCENT} * p.score <= 100 * n.score AND 100 * n.score <= {MOST_PERCENT} * p.score
  QUALIFY rank <= {NEGATIVES})
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives"""
