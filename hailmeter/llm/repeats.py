"""Operator 9: removing later copies of long byte strings, by hashed windows.

The method as named sorts suffixes and finds each one's longest previous factor (the
longest string that begins both there and at an earlier place) at the previous or next
suffix of a smaller place. None of that is computed here. A place is earlier if its
document has a smaller doc_id, and all that counts is whether the factor reaches
`LENGTH` bytes. So windows of that length are grouped by 64-bit names, and within equal
names the smallest doc_id covers the others. Names are dealt over tasks.

Naming every byte position of a corpus would move many times its size. So suffixes are
first taken in runs: a window of `LENGTH` bytes is put under the least hash of its
`GRAM`-byte strings (its minimizer), consecutive windows with the same minimizer form a
run, and equal windows have equal minimizers wherever they stand.

1. Runs. Each run is sent as (minimizer, name of its whole string, doc_id), packed,
   the first document of a task for each run only. A run whose string also stands
   in an earlier document is covered as a whole. A run whose minimizer stands in other
   documents with other strings around it (the ends of a match) is left open.
2. Windows. All windows of the open runs are named one by one, and those that begin in
   an earlier document too are covered. Only the first document of each open run takes
   part: later ones are already covered by it.
3. Documents. Covered runs and windows come back to their documents, whose bytes are
   marked and cut.

A passage that a third of all documents share costs one row per task and string, and
a minimizer with very many strings around it is dealt over all tasks by string. The
number of buckets grows with the bytes of text, so a task holds a bounded share of them.

Defined results: a null text is empty; doc_id null counts as greater than all others;
rows with the same doc_id never remove each other's bytes; texts under `LENGTH` bytes
lose nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hailmeter.llm import tokens
from hailmeter.llm.common import bounded_batches, shuffle_partitions, stored

LENGTH = 50
GRAM = 24
#: A minimizer with more strings in one task is dealt by string.
MANY_STRINGS = 64
#: Rows that a task holds before it packs and sends them.
HELD_ROWS = 400_000
#: Bytes of text that a task works on at once.
CHUNK_BYTES = 250_000
#: Bytes of text behind a bucket at most, on average: about a run for every 14 of them.
BUCKET_BYTES = 8_000_000
MOST_BITS = 16
LAST_DOC = 2**63 - 1

_U = np.uint64


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Runs:
    """The runs of a chunk: their first and last window, minimizer and string."""

    def __init__(self, chunk: tokens.Chunk, length: int, gram: int):
        n = len(chunk.data)
        self.begin = self.end = np.zeros(0, dtype=np.int64)
        self.least = self.string = np.zeros(0, dtype=_U)
        if n < length:
            return
        at = np.arange(n - gram + 1)
        m = _least(chunk.span_hash(at, at + gram), length - gram + 1)
        whole = np.zeros(len(m) + 1, dtype=np.int32)
        long = chunk.lengths >= length
        whole[chunk.offsets[:-1][long]] += 1
        whole[chunk.offsets[1:][long] - length + 1] -= 1
        valid = np.cumsum(whole)[:-1] > 0
        changed = m[1:] != m[:-1]
        first, last = valid.copy(), valid.copy()
        first[1:] &= changed | ~valid[:-1]
        last[:-1] &= changed | ~valid[1:]
        self.begin, self.end = np.flatnonzero(first), np.flatnonzero(last)
        with np.errstate(over="ignore"):
            extent = (self.end - self.begin).astype(_U)
            self.string = tokens.mix(chunk.span_hash(self.begin, self.end + length) + extent)
        # 56 bits of the minimizer and 40 of the string together name a run; the least of
        # many hashes is small, so they are mixed again before they are dealt by their first bits
        self.least = tokens.mix(m[self.begin]) >> _U(8)
        self.string >>= _U(24)

    @property
    def names(self) -> np.ndarray:
        return _names(self.least, self.string)


def _names(least: np.ndarray, string: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return tokens.mix(least * _U(0x9E3779B97F4A7C15) + string)


def _narrow(values: np.ndarray, n_bytes: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n_bytes].tobytes()


def _widen(data: memoryview, n: int, n_bytes: int) -> np.ndarray:
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :n_bytes] = np.frombuffer(data, np.uint8, n * n_bytes).reshape(n, n_bytes)
    return wide.view("<u8").reshape(-1)


def pack(columns: list[tuple[np.ndarray, int]]) -> bytes:
    """Unsigned columns of the given widths, one after the other; least values apart."""
    n = len(columns[0][0])
    parts = [np.array([n], dtype="<u8").tobytes()]
    for values, width in columns:
        base = values.min() if n else _U(0)
        small = values - base
        while n and width < 8 and int(small.max()) >> (8 * width):
            width += 1
        parts += [np.array([base, width], dtype="<u8").tobytes(), _narrow(small, width)]
    return b"".join(parts)


def unpack(data: bytes, n_columns: int) -> list[np.ndarray]:
    view = memoryview(data)
    n = int(np.frombuffer(view, "<u8", 1)[0])
    at, out = 8, []
    for _ in range(n_columns):
        base, width = np.frombuffer(view[at:], "<u8", 2)
        at += 16
        out.append(_widen(view[at:], n, int(width)) + base)
        at += n * int(width)
    return out


def _first_of_each(*sorted_columns: np.ndarray) -> np.ndarray:
    keep = np.ones(len(sorted_columns[0]), dtype=bool)
    if len(keep):
        keep[1:] = False
        for c in sorted_columns:
            keep[1:] |= c[1:] != c[:-1]
    return keep


def _group_min(first: np.ndarray, sorted_docs: np.ndarray) -> np.ndarray:
    """For each row, the document of the first row of its group."""
    return sorted_docs[np.flatnonzero(first)][np.cumsum(first) - 1] if len(first) else sorted_docs


def _bucket_bits(spark: SparkSession, n_bytes: int = 0) -> int:
    """A task holds one bucket at once, so their number grows with the input."""
    some = max(8, (shuffle_partitions(spark) - 1).bit_length())
    return max(some, min(MOST_BITS, (n_bytes // BUCKET_BYTES).bit_length()))


def _spread(name: np.ndarray, doc: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of rows that only pass through: a string of very many documents fills none."""
    return (tokens.mix(name ^ tokens.mix(doc)) >> _U(64 - bits)).astype(np.int64)


def _boxes(rows: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 512):
        bucket, kind, blob = zip(*rows[i : i + 512], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())],
            names=["bucket", "kind", "blob"],
        )


def _box(kind: int, bucket: np.ndarray, bits: int, columns: list[tuple[np.ndarray, int]]):
    """(bucket, kind, packed columns) for each bucket that has rows."""
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
    for q in np.flatnonzero(cut[1:] > cut[:-1]):
        own = order[cut[q] : cut[q + 1]]
        yield int(q), kind, pack([(values[own], width) for values, width in columns])


def _pack_runs(parts: list[tuple[np.ndarray, ...]], bits: int) -> Iterator[pa.RecordBatch]:
    least, string, doc = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((doc.view(np.int64), string, least))
    least, string, doc = least[order], string[order], doc[order]
    first = _first_of_each(least, string)
    later = ~first & (doc != _group_min(first, doc))
    names = _names(least[later], string[later])
    bucket = _spread(names, doc[later], bits)
    rows = list(_box(3, bucket, bits, [(names, 8), (doc[later], 4)]))
    least, string, doc = least[first], string[first], doc[first]
    if len(least):
        group = np.cumsum(_first_of_each(least)) - 1
        many = np.bincount(group)[group] > MANY_STRINGS
        marker = many & _first_of_each(least)
        away = (_names(least, string) >> _U(64 - bits)).astype(np.int64)
        home = _home(least, bits)
        for kind, use, bucket in ((0, ~many, home), (1, marker, home), (2, many, away)):
            columns = [(least[use], 6), (string[use], 5), (doc[use], 4)]
            rows += _box(kind, bucket[use], bits, columns)
    yield from _boxes(rows)


def _home(least: np.ndarray, bits: int) -> np.ndarray:
    return (least >> _U(56 - bits)).astype(np.int64)


def _map_runs(length: int, gram: int, bits: int):
    """Packed runs of a task's documents, by bucket of the minimizer.

    Kind 0 goes by minimizer, 2 by string (1 tells the minimizer's bucket so); 3 are
    runs that an earlier document of this task already covers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            doc = batch.column("doc").to_numpy()
            for chunk in tokens.chunks(batch.column("text"), CHUNK_BYTES):
                runs = Runs(chunk, length, gram)
                row = chunk.row_of(runs.begin)
                parts.append((runs.least, runs.string, doc[chunk.first + row].view(_U)))
                held += len(row)
                if held > HELD_ROWS:
                    yield from _pack_runs(parts, bits)
                    parts, held = [], 0
        if parts:
            yield from _pack_runs(parts, bits)

    return run


def _gather(frame: pd.DataFrame, kinds: tuple[int, ...], n_columns: int) -> list[np.ndarray]:
    blobs = [unpack(b, n_columns) for b in frame["blob"][frame["kind"].isin(kinds)]]
    if not blobs:
        return [np.zeros(0, dtype=_U)] * n_columns
    return [np.concatenate(c) for c in zip(*blobs, strict=True)]


def _answer(parts: list[tuple[np.ndarray, np.ndarray, bool]]) -> pd.DataFrame:
    names = np.concatenate([p[0] for p in parts])
    docs = np.concatenate([p[1] for p in parts])
    covered = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
    return pd.DataFrame(
        {"doc": docs.view(np.int64), "name": names.view(np.int64), "covered": covered}
    )


def _reduce_runs(frame: pd.DataFrame) -> pd.DataFrame:
    done, done_doc = _gather(frame, (3,), 2)
    parts = [(done, done_doc, True)]
    marked = np.unique(_gather(frame, (1,), 3)[0])
    for kind in (0, 2):
        least, string, doc = _gather(frame, (kind,), 3)
        order = np.lexsort((doc.view(np.int64), string, least))
        least, string, doc = least[order], string[order], doc[order]
        first = _first_of_each(least, string)
        later = ~first & (doc != _group_min(first, doc))
        parts.append((_names(least[later], string[later]), doc[later], True))
        least, string, doc = least[first], string[first], doc[first]
        if kind == 2:
            is_open = np.ones(len(least), dtype=bool)
        else:
            starts = np.flatnonzero(_first_of_each(least))
            if len(starts):
                signed = doc.view(np.int64)
                spread = np.maximum.reduceat(signed, starts) != np.minimum.reduceat(signed, starts)
                group = np.cumsum(_first_of_each(least)) - 1
                is_open = spread[group] | np.isin(least, marked)
            else:
                is_open = np.zeros(0, dtype=bool)
        parts.append((_names(least[is_open], string[is_open]), doc[is_open], False))
    return _answer(parts)


def _pack_windows(parts: list[tuple[np.ndarray, np.ndarray]], bits: int):
    name, doc = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((doc.view(np.int64), name))
    name, doc = name[order], doc[order]
    keep = _first_of_each(name, doc)
    name, doc = name[keep], doc[keep]
    first = _first_of_each(name)
    done = ~first & (doc != _group_min(first, doc))
    rows = []
    for kind, use in ((0, first), (3, done)):
        if kind == 3:
            bucket = _spread(name[use], doc[use], bits)
        else:
            bucket = (name[use] >> _U(64 - bits)).astype(np.int64)
        rows += _box(kind, bucket, bits, [(name[use], 7), (doc[use], 4)])
    yield from _boxes(rows)


def _map_windows(length: int, gram: int, bits: int):
    """Packed windows of the open runs of a task's documents, by bucket of the name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            doc = batch.column("doc").to_numpy()
            wanted = batch.column("names")
            for chunk in tokens.chunks(batch.column("text"), CHUNK_BYTES):
                names, row = _windows(chunk, wanted, length, gram)
                parts.append((names, doc[chunk.first + row].view(_U)))
                held += len(row)
                if held > HELD_ROWS:
                    yield from _pack_windows(parts, bits)
                    parts, held = [], 0
        if parts:
            yield from _pack_windows(parts, bits)

    return run


def _listed(column: pa.Array, rows: range) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of a list column, by row from 0; a null list is empty."""
    part = column.slice(rows.start, len(rows))
    counts = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(_U)
    return np.repeat(np.arange(len(rows)), counts), values


def _chosen(row: np.ndarray, names: np.ndarray, in_row: np.ndarray, wanted: np.ndarray):
    """Whether (row, name) is among the wanted (row, name) pairs."""
    if not len(wanted) or not len(names):
        return np.zeros(len(names), dtype=bool)
    maybe = np.flatnonzero(np.isin(names, wanted))
    have = set(zip(in_row.tolist(), wanted.tolist(), strict=True))
    out = np.zeros(len(names), dtype=bool)
    pairs = zip(row[maybe].tolist(), names[maybe].tolist(), strict=True)
    out[maybe] = [p in have for p in pairs]
    return out


def _windows(chunk: tokens.Chunk, wanted: pa.Array, length: int, gram: int):
    """Names and rows of all windows of the wanted runs."""
    in_row, names = _listed(wanted, range(chunk.first, chunk.first + len(chunk)))
    if not len(names):
        return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
    runs = Runs(chunk, length, gram)
    use = _chosen(chunk.row_of(runs.begin), runs.names, in_row, names)
    begin, n = runs.begin[use], runs.end[use] - runs.begin[use] + 1
    at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return chunk.span_hash(at, at + length), chunk.row_of(at)


def _reduce_windows(frame: pd.DataFrame) -> pd.DataFrame:
    done, done_doc = _gather(frame, (3,), 2)
    name, doc = _gather(frame, (0,), 2)
    order = np.lexsort((doc.view(np.int64), name))
    name, doc = name[order], doc[order]
    first = _first_of_each(name)
    later = ~first & (doc != _group_min(first, doc))
    return _answer([(done, done_doc, True), (name[later], doc[later], True)])


def _cut(length: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Marks covered bytes and cuts them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, digests = [], [], [], []
            for chunk in tokens.chunks(batch.column("text"), CHUNK_BYTES):
                rows = range(chunk.first, chunk.first + len(chunk))
                mask = np.zeros(len(chunk.data), dtype=bool)
                runs_row, runs_name = _listed(batch.column("runs"), rows)
                windows_row, windows_name = _listed(batch.column("windows"), rows)
                if len(runs_name) or len(windows_name):
                    edge = np.zeros(len(chunk.data) + 1, dtype=np.int32)
                    runs = Runs(chunk, length, gram)
                    row = chunk.row_of(runs.begin)
                    use = _chosen(row, runs.names, runs_row, runs_name)
                    np.add.at(edge, runs.begin[use], 1)
                    np.add.at(edge, runs.end[use] + length, -1)
                    if len(windows_name):
                        left = ~use & np.isin(row, windows_row)
                        begin = runs.begin[left]
                        n = runs.end[left] - begin + 1
                        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
                        names = chunk.span_hash(at, at + length)
                        at = at[_chosen(chunk.row_of(at), names, windows_row, windows_name)]
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + length, -1)
                    mask = np.cumsum(edge)[:-1] > 0
                begin = mask.copy()
                begin[1:] &= ~mask[:-1]
                full = chunk.offsets[:-1][chunk.lengths > 0]
                begin[full] = mask[full]
                count = np.concatenate([[0], np.cumsum(mask)])
                starts = np.concatenate([[0], np.cumsum(begin)])
                for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:], strict=True):
                    sizes.append(b - a)
                    removed.append(count[b] - count[a])
                    spans.append(starts[b] - starts[a])
                    own = chunk.data[a:b]
                    kept = own if removed[-1] == 0 else own[~mask[a:b]]
                    digests.append(hashlib.sha256(kept.tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.array(sizes, dtype=np.int64)),
                    pa.array(np.array(removed, dtype=np.int64)),
                    pa.array(np.array(spans, dtype=np.int64)),
                    pa.array(digests, pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def _place() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_DOC)).alias("doc")


def repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM):
    """(runs, windows): rows of (doc, name, covered) for whole runs and single windows."""
    spark = docs.sparkSession
    bounded_batches(spark)
    packed = "bucket int, kind int, blob binary"
    answer = "doc long, name long, covered boolean"
    texts = docs.select(_place(), F.col("text").cast("string").alias("text")).filter(
        F.octet_length("text") >= length
    )
    n_bytes = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0]
    bits = _bucket_bits(spark, n_bytes or 0)
    runs = stored(
        texts.mapInArrow(_map_runs(length, gram, bits), packed)
        .groupBy("bucket")
        .applyInPandas(_reduce_runs, answer),
        "repeat-runs",
    )
    wanted = (
        runs.filter("not covered").groupBy("doc").agg(F.collect_list("name").alias("names"))
    )
    windows = stored(
        texts.join(wanted.hint("merge"), "doc")
        .mapInArrow(_map_windows(length, gram, bits), packed)
        .groupBy("bucket")
        .applyInPandas(_reduce_windows, answer),
        "repeat-windows",
    )
    return runs, windows


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    runs, windows = repeated_strings(docs, length, gram)
    covered = (
        runs.filter("covered")
        .select("doc", F.col("name").alias("run"), F.lit(None).cast("long").alias("window"))
        .unionByName(
            windows.select(
                "doc", F.lit(None).cast("long").alias("run"), F.col("name").alias("window")
            )
        )
        .groupBy("doc")
        .agg(F.collect_list("run").alias("runs"), F.collect_list("window").alias("windows"))
    )
    rows = docs.select("doc_id", _place(), F.col("text").cast("string").alias("text"))
    return (
        rows.join(covered.hint("merge"), "doc", "left")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text", "runs", "windows")
        .mapInArrow(
            _cut(length, gram),
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
        )
    )
