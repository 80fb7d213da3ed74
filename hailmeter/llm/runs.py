"""Operator 13: periodic runs of words, caught online over dyadic blocks.

The words of a text arrive one after the other. Whenever a block of 2**k words that begins
at a multiple of 2**k is complete, it gets a catcher, which is active while the following
words could begin a second copy of the block 2**k to 2**(k+1) - 1 words later: exactly one
catcher of each level is active at a word. Each appended word advances the suffix
comparison of the active catchers by one step: is the text's suffix of 2**k words the
catcher's block? A hit is a candidate square whose period is the distance of the two.
Successive catchers that hit at one distance belong to one repetition and merge; the ends
of what has merged are found by comparing longer and longer dyadic blocks on both sides,
and a stretch at least `times` periods long becomes a run, with its smallest period.

A run with period q, 2**k <= q < 2**(k+1), that is three periods long or longer holds a
whole aligned block of 2**k words in its first two periods and the block's copy q words
later, so no run is missed. A step costs one comparison per level: n log n for n words.
The steps of one level over all texts of a chunk are carried out as one array operation,
which gives what word-by-word appending gives. Blocks are named by 64-bit hashes of the
names of their halves (words by hashes of their bytes), so equality rests on 64-bit names.

Defined results: a null or empty text has no words, no runs and nothing collapsed; a null
doc_id belongs to no tenth; repeated rows are answered one by one; very long texts are one
row of work each, whole; an empty table gives an empty result; input columns other than
doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailmeter.llm import tokens

LEAST_WORDS = 6
TIMES = 4

SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)
RUNS_SCHEMA = "doc_id long, start long, length long, period long"

_U = np.uint64
_HALF = _U(0xD6E8FEB86659FD93)


class Blocks:
    """Names of all blocks of 2**k values; blocks may begin anywhere."""

    def __init__(self, names: np.ndarray, levels: int):
        self.levels = [names]
        for _ in range(levels):
            self.add()

    def add(self) -> None:
        last = self.levels[-1]
        size = 1 << (len(self.levels) - 1)
        if len(last) <= size:
            self.levels.append(np.zeros(0, dtype=_U))
            return
        # the halves enter differently, and no sum of them is a sum over single words
        self.levels.append(tokens.mix(tokens.mix(last[:-size] * _HALF) + last[size:]))

    def common_after(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values agree from a and from b on (a < b), up to `limit` of them."""
        n = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names, size = self.levels[k], 1 << k
            while True:
                go = np.flatnonzero(n + size <= limit)
                go = go[names[a[go] + n[go]] == names[b[go] + n[go]]] if len(go) else go
                n[go] += size
                if k < len(self.levels) - 1 or not len(go):
                    break  # below the top level a size fits at most once
        return n

    def common_before(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values agree before a and before b, up to `limit` of them."""
        n = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names, size = self.levels[k], 1 << k
            while True:
                go = np.flatnonzero(n + size <= limit)
                at = n[go] + size
                go = go[names[a[go] - at] == names[b[go] - at]] if len(go) else go
                n[go] += size
                if k < len(self.levels) - 1 or not len(go):
                    break
        return n


@dataclass
class Runs:
    """Runs of the texts of a chunk, by text, then start, then period."""

    row: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray

    def __len__(self) -> int:
        return len(self.row)


def _catches(
    names: np.ndarray, begins: np.ndarray, counts: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, block, copy) of every hit of the catchers of level k, in order of appending.

    The suffix that ends with a word begins at `copy`; the active catcher is the one of the
    last aligned block that begins at least one block before it.
    """
    size = 1 << k
    rows = np.flatnonzero(counts >= 2 * size)
    steps = counts[rows] - 2 * size + 1  # copies begin at size .. count - size
    row = np.repeat(rows, steps)
    place = np.arange(len(row)) - np.repeat(np.cumsum(steps) - steps, steps) + size
    block = begins[row] + ((place >> k) - 1 << k)
    copy = begins[row] + place
    hit = np.flatnonzero(names[block] == names[copy])
    return row[hit], block[hit], copy[hit]


def find_runs(
    words: np.ndarray,
    counts: np.ndarray,
    times: int = TIMES,
    least: int = LEAST_WORDS,
) -> Runs:
    """All runs of texts whose word names lie one after the other in `words`.

    A run is a maximal stretch with smallest period q and at least max(least, times * q)
    words; `times` is 3 at least, which is what the catchers need.
    """
    if times < 3:
        raise ValueError("catchers need runs of three periods or more")
    begins = np.cumsum(counts) - counts
    most = int(counts.max(initial=0)) // times
    blocks = Blocks(words, 0)
    found = []
    k = 0
    while 1 << k <= most:
        if k:
            blocks.add()
        own = np.where(counts // times >= 1 << k, counts, 0)
        row, block, copy = _catches(blocks.levels[k], begins, own, k)
        period = copy - block
        fits = period * times <= counts[row]
        row, block, copy, period = row[fits], block[fits], copy[fits], period[fits]
        if len(row):
            # neighbouring blocks that hit at one distance have caught the same repetition
            order = np.lexsort((block, period, row))
            row, block, copy, period = row[order], block[order], copy[order], period[order]
            first = np.ones(len(row), dtype=bool)
            first[1:] = (
                (row[1:] != row[:-1])
                | (period[1:] != period[:-1])
                | (block[1:] != block[:-1] + (1 << k))
            )
            last = np.flatnonzero(np.concatenate([first[1:], [True]]))
            first = np.flatnonzero(first)
            row, period, begin = row[first], period[first], begins[row[first]]
            left = blocks.common_before(block[first], copy[first], block[first] - begin)
            right = blocks.common_after(
                block[last], copy[last], begin + counts[row] - copy[last]
            )
            start = block[first] - left
            length = copy[last] + right - start
            keep = length >= np.maximum(least, times * period)
            found.append(
                np.stack([row, start - begin, length, period], axis=1)[keep]
            )
        k += 1
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return Runs(none, none, none, none)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    # one stretch caught at several distances: they are multiples of the smallest one
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return Runs(*rows.T)


def collapsed(runs: Runs, counts: np.ndarray) -> np.ndarray:
    """Whether each word stays: no run has it after the run's first period."""
    begins = np.cumsum(counts) - counts
    over = np.zeros(int(counts.sum()) + 1, dtype=np.int64)
    np.add.at(over, begins[runs.row] + runs.start + runs.period, 1)
    np.add.at(over, begins[runs.row] + runs.start + runs.length, -1)
    return np.cumsum(over)[:-1] == 0


def repeated_tails(doc_ids: list, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which word stands at each place once every tenth text has a periodic tail.

    h = crc32 of the decimal doc_id and g = h // 10; where h is divisible by 10, words from
    a = g % n on repeat those of a with period 1 + (n - a) // (3 + g % 8). Also returns which
    texts are changed.
    """
    place = np.arange(int(counts.sum()))
    begins = np.cumsum(counts) - counts
    changed = np.zeros(len(counts), dtype=bool)
    for i, doc_id in enumerate(doc_ids):
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        n = int(counts[i])
        if h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        tail = place[begins[i] + a : begins[i] + n]
        tail[:] = begins[i] + a + np.arange(n - a) % p
        changed[i] = True
    return place, changed


def _words(chunk: tokens.Chunk) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = chunk.runs(tokens.NON_SPACE)
    counts = np.diff(np.searchsorted(starts, chunk.offsets))
    return chunk.span_hash(starts, ends), counts.astype(np.int64)


def _digests(batch: pa.RecordBatch) -> Iterator[tuple]:
    ids = batch.column("doc_id").to_pylist()
    for chunk in tokens.chunks(batch.column("text")):
        names, counts = _words(chunk)
        own = ids[chunk.first : chunk.first + len(chunk)]
        place, changed = repeated_tails(own, counts)
        runs = find_runs(names[place], counts)
        stays = collapsed(runs, counts)
        begins = np.concatenate([[0], np.cumsum(counts)])
        split = np.searchsorted(runs.row, np.arange(len(counts) + 1))
        for i, doc_id in enumerate(own):
            # bytes.split() cuts at just the six characters that end a word
            text = chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes().split()
            a, b = begins[i], begins[i + 1]
            mine = slice(split[i], split[i + 1])
            if changed[i] or mine.start < mine.stop:
                kept = place[a:b][stays[a:b]] - a
                text = [text[j] for j in kept.tolist()]
            best = (None,) * 4
            lines = b""
            if mine.start < mine.stop:
                rows = list(
                    zip(
                        runs.start[mine].tolist(),
                        runs.length[mine].tolist(),
                        runs.period[mine].tolist(),
                        strict=True,
                    )
                )
                s, n, q = min(rows, key=lambda r: (-r[1], r[0], r[2]))
                best = (s, n, q, 1000 * n // q)
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in rows).encode()
            yield (
                doc_id,
                mine.stop - mine.start,
                *best,
                hashlib.sha256(lines).hexdigest(),
                hashlib.sha256(b" ".join(text)).hexdigest(),
            )


_TYPES = [pa.int64()] * 6 + [pa.string()] * 2
_NAMES = [part.split()[0] for part in SCHEMA.split(",")]


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = list(zip(*_digests(batch), strict=True)) or [[] for _ in _NAMES]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES
        )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def periodic_runs(docs: DataFrame, times: int = TIMES, least: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, start, length, period) of every run of every whole text as it stands."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids = batch.column("doc_id")
            for chunk in tokens.chunks(batch.column("text")):
                runs = find_runs(*_words(chunk), times, least)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(runs.row + chunk.first)),
                        *[pa.array(v) for v in (runs.start, runs.length, runs.period)],
                    ],
                    names=["doc_id", "start", "length", "period"],
                )

    return _texts(docs).mapInArrow(batches, RUNS_SCHEMA)


def run_digests(docs: DataFrame) -> DataFrame:
    """The contract's row per document: runs and collapsed text, every tenth tail repeated."""
    return _texts(docs).mapInArrow(_digest_batches, SCHEMA)
