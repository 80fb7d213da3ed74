"""Exact set-similarity joins over hashed tokens, for lines (2) and documents (6).

Items (lines or documents) with equal token sets are one class, named by a hash of
the set. Tokens are ordered by rarity: by their count in a table of `BITS` bits of
hash buckets, summed over all rows, then by name. The order only has to be the same
everywhere for the prefix filter to be exact, and frequent tokens come last in it.

A task sends each class's prefix once, packed into one binary value per bucket of the
token, and the tasks of the buckets emit

* pairs of classes that share a token and pass the positional and length bounds, for
  tokens with at most `many` classes (where only an earlier match is asked for, each
  class with the earliest that passes: a group of n similar classes makes n pairs), and
* plain rows (token, class, size, position) for tokens with more: those are joined by
  Spark, first with one pivot per token and, where that leaves classes apart, among
  each other; skewed tokens are split by the adaptive skew join.

A minimizer of work and no cap: every pair that can reach the threshold is verified
against the whole sets, or its two classes are already known to be connected (or,
where only an earlier match is asked for, the class already has one).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailmeter.llm import tokens
from hailmeter.llm.common import shuffle_partitions, stored
from hailmeter.llm.repeats import _box, _boxes, _first_of_each, unpack

#: The threshold as a fraction: Jaccard >= NUM / DEN.
NUM, DEN = 80, 100
BITS = 21
SLICES = 16
#: Bytes of text and rows that a task works on at once.
CHUNK_BYTES = 250_000
HELD_ROWS = 125_000
#: Prefix rows a bucket should have at most; the number of buckets grows with the input.
BUCKET_ROWS = 1_000_000
MAX_MATCHES = 4
PARITY_BITS = 96
#: 96 parities of a set with more tokens tell next to nothing, so it has longer ones, too.
WIDE_FROM, WIDE_WORDS = 144, 6
WIDE = tuple(f"w{i}" for i in range(WIDE_WORDS))
#: Sizes of similar sets lie in the same band or in neighbouring ones.
BAND = 1.3
#: Pairs near the bound that a set of the earliest-match search is given under a token.
MOST_DOUBTS = 4
PARITY_WORDS = 8
PARITIES = tuple(f"p{w}" for w in range(PARITY_WORDS))
MOST_COUNTED = 2**32 - 1
WANTED_BITS, WANTED_SLICES = 23, 64

_U = np.uint64


def bucket_of(names: np.ndarray) -> np.ndarray:
    """The place of tokens in the table of counts."""
    return (names >> _U(64 - BITS)).astype(np.int64)


def listed(names: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether names are in a table of bits: all that were put there are."""
    return bits[(names >> _U(64 - WANTED_BITS)).astype(np.int64)]


@dataclass
class Items:
    """Token sets of a chunk: names sorted by item; row and number of each item."""

    names: np.ndarray
    counts: np.ndarray
    row: np.ndarray
    number: np.ndarray

    def of(self, use: np.ndarray) -> Items:
        """Some of the items; use: a flag for each."""
        kept = np.repeat(use, self.counts)
        return Items(self.names[kept], self.counts[use], self.row[use], self.number[use])

    @property
    def begins(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts

    def classes(self) -> np.ndarray:
        """One name per item; equal sets have equal names. Items have a token at least."""
        if not len(self.counts):
            return np.zeros(0, dtype=_U)
        with np.errstate(over="ignore"):
            one = np.add.reduceat(tokens.mix(self.names), self.begins)
            two = np.add.reduceat(tokens.mix(self.names ^ _U(0x5DEECE66D1234567)), self.begins)
            return tokens.mix(one + tokens.mix(two + self.counts.astype(_U)))


#: Of a chunk; a second argument, a table of bits, leaves items out that have no token in it.
ItemsOf = Callable[..., Items]
NamesOf = Callable[[tokens.Chunk], np.ndarray]


def required(a, b):
    """Least intersection with which sizes a and b reach the threshold (ceiling)."""
    return -(-NUM * (a + b) // (NUM + DEN))


def prefix_length(n: np.ndarray, matches=1) -> np.ndarray:
    """Tokens of which a set of n must share `matches` with any similar set."""
    return n - (-(-NUM * n // DEN)) + matches


# --- counts of tokens -----------------------------------------------------------


def _count_batches(names_of: NamesOf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, dtype=np.int64)
        for batch in batches:
            for chunk in tokens.chunks(batch.column("text"), CHUNK_BYTES):
                # in place: a second table for each piece would be as large as the first
                np.add.at(total, (names_of(chunk) >> _U(64 - BITS)).view(np.int64), 1)
        yield pa.RecordBatch.from_arrays(packed_counts(total), names=["slice", "counts"])

    return run


def packed_counts(total: np.ndarray) -> list[pa.Array]:
    """A task's table as columns slice and counts."""
    parts = total.reshape(SLICES, -1)
    return [
        pa.array(range(SLICES), pa.int32()),
        pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary()),
    ]


def _add_counts(frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(c), dtype=np.int64) for c in frame["counts"])
    # the order needs no more than this; counts beyond it are equally frequent
    total = np.minimum(total, MOST_COUNTED).astype(np.uint32)
    return pd.DataFrame({"slice": frame["slice"].iloc[:1], "counts": [total.tobytes()]})


def token_counts(texts: DataFrame, names_of: NamesOf) -> np.ndarray:
    """Counts of 2**BITS hash buckets over all rows: 8 MB, whatever the input."""
    return summed_counts(
        texts.select("text").mapInArrow(_count_batches(names_of), "slice int, counts binary")
    )


def summed_counts(parts: DataFrame) -> np.ndarray:
    """The sum of the tables that tasks made (slice, counts), see `packed_counts`."""
    rows = parts.groupBy("slice").applyInPandas(_add_counts, "slice int, counts binary").collect()
    total = np.zeros((SLICES, (1 << BITS) // SLICES), dtype=np.uint32)
    for r in rows:
        total[r["slice"]] = np.frombuffer(r["counts"], dtype=np.uint32)
    return total.reshape(-1)


# --- prefixes and candidates ----------------------------------------------------


def _choose_matches(load: np.ndarray, begins: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many shared prefix tokens each item asks for: the cheapest by estimate.

    `load` is the estimated number of other sets under each ordered token. Reading a
    longer prefix costs its load; at most load / matches sets can share that many.
    """
    total = np.concatenate([[0.0], np.cumsum(load)])
    most = np.minimum(MAX_MATCHES, -(-NUM * n // DEN))
    best = np.ones(len(n), dtype=np.int64)
    cheapest = np.full(len(n), np.inf)
    for matches in range(1, MAX_MATCHES + 1):
        length = np.minimum(n, prefix_length(n, matches))
        read = total[begins + length] - total[begins]
        cost = np.where(matches <= most, read + 8 * read / matches, np.inf)
        better = cost < cheapest
        best[better], cheapest[better] = matches, cost[better]
    return best


def _signature(names: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parities of 96 hash bits over each set, as 64 and 32 of them.

    A token counts for one of the bits, so sets that differ in d tokens differ in d bits
    at most.
    """
    place = names % _U(PARITY_BITS)
    bit = _U(1) << (place & _U(63))
    return tuple(
        np.bitwise_xor.reduceat(np.where((place >= _U(64)) == high, bit, _U(0)), begins)
        for high in (False, True)
    )


def _wide_signature(names: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
    """Parities of 64 * WIDE_WORDS other hash bits over each set, a column for each word."""
    if not len(begins):
        return [np.zeros(0, dtype=_U)] * WIDE_WORDS
    place = (names >> _U(24)) % _U(64 * WIDE_WORDS)
    word, bit = place >> _U(6), _U(1) << (place & _U(63))
    return [
        np.bitwise_xor.reduceat(np.where(word == _U(w), bit, _U(0)), begins)
        for w in range(WIDE_WORDS)
    ]


def _prefix_batches(
    items_of: ItemsOf,
    counts: np.ndarray,
    bits: int,
    many_at: int,
    adaptive: bool,
    only_tokens: np.ndarray | None = None,
):
    """Packed (token, class, size, position, extra, document, number of the item).

    Extra is the number of matches asked for, or the parities. Only where the earliest
    match is asked for are documents and numbers sent: those of the class's first item.
    There each bucket also gets the longer parities of its large sets, once a class.
    """
    mean = float(counts.mean())

    def pack(
        parts: list[tuple[np.ndarray, ...]], large: list[tuple[np.ndarray, ...]]
    ) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        parts.clear()
        entries = _sorted_entries(columns)
        token, cls, size, pos, extra, doc, number, more = entries
        first = _first_of_each(token)
        group = np.cumsum(first) - 1
        many = np.bincount(group)[group] > many_at if len(group) else first
        home = (token >> _U(64 - bits)).astype(np.int64)
        away = (tokens.mix(token ^ cls) >> _U(64 - bits)).astype(np.int64)
        rows: list = []
        for kind, use, bucket in ((0, ~many, home), (1, many & first, home), (2, many, away)):
            columns = [(token, 7), (cls, 8), (size, 2), (pos, 1)]
            columns += [(extra, 1 if adaptive else 8), (doc, 4), (number, 2), (more, 4)]
            columns = columns[:5] if adaptive else columns
            rows += _box(kind, bucket[use], bits, [(c[use], w) for c, w in columns])
        if large:
            rows += pack_large(large, cls, np.where(many, away, home))
        yield from _boxes(rows)

    def pack_large(large: list, cls: np.ndarray, bucket: np.ndarray) -> Iterator[tuple]:
        known, *words = (np.concatenate(c) for c in zip(*large, strict=True))
        large.clear()
        known, at = np.unique(known, return_index=True)
        words = [w[at] for w in words]
        place = np.minimum(np.searchsorted(known, cls), max(len(known) - 1, 0))
        use = np.flatnonzero(known[place] == cls) if len(known) else np.zeros(0, dtype=np.int64)
        # each class once in a bucket
        both = np.unique(place[use] * (1 << bits) + bucket[use])
        place, bucket = both >> bits, both & ((1 << bits) - 1)
        columns = [(known[place], 8), *((w[place], 8) for w in words)]
        return _box(4, bucket, bits, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts: list[tuple[np.ndarray, ...]] = []
        large: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            docs = None if adaptive else batch.column("doc").to_numpy()
            for chunk in tokens.chunks(batch.column("text"), CHUNK_BYTES):
                # a set without one of these tokens has none of them in its prefix
                items = items_of(chunk) if only_tokens is None else items_of(chunk, only_tokens)
                if not len(items.counts):
                    continue
                cls = items.classes()
                if docs is None:
                    doc = np.zeros(len(cls), dtype=_U)
                    fresh = np.zeros(len(cls), dtype=bool)
                    for i, c in enumerate(cls.tolist()):
                        if c not in seen:
                            seen.add(c)
                            fresh[i] = True
                else:
                    doc = docs[chunk.first + items.row].view(_U)
                    fresh = np.ones(len(cls), dtype=bool)
                n, begins = items.counts, items.begins
                item = np.repeat(np.arange(len(n)), n)
                load = counts[(items.names >> _U(64 - BITS)).astype(np.int64)]
                # names that agree in their rank are put in order by the whole name, so
                # the order is the same everywhere
                rank = _rank(items.names, counts)
                order = tokens.grouped_order(rank, item)
                tied = (rank[order][1:] == rank[order][:-1]) & (item[order][1:] == item[order][:-1])
                if tied.any():
                    order = np.lexsort((items.names, rank, item))
                names, load = items.names[order], load[order].astype(np.float64)
                more = np.zeros(len(n), dtype=_U)
                if adaptive:
                    extra = _choose_matches(np.maximum(load - mean, 0) + 1.0, begins, n)
                    length = np.minimum(n, prefix_length(n, extra))
                else:
                    extra, more = _signature(items.names, begins)
                    wide = items.of(n >= WIDE_FROM)
                    if len(wide.counts):
                        large.append(
                            (cls[n >= WIDE_FROM], *_wide_signature(wide.names, wide.begins))
                        )
                    length = np.minimum(n, prefix_length(n))
                # a set so small that no other set can be similar has no prefix
                length = np.where(n * DEN >= NUM * (n + 1), length, 0)
                pos = np.arange(len(names)) - begins[item]
                use = (pos < length[item]) & fresh[item]
                if only_tokens is not None:
                    use &= only_tokens[(names >> _U(64 - WANTED_BITS)).astype(np.int64)]
                own = item[use]
                values = (names[use], cls[own], n[own], pos[use], extra[own], doc[own])
                values += (items.number[own], more[own])
                parts.append(tuple(v.astype(_U) for v in values))
                held += len(own)
                if held > HELD_ROWS:
                    yield from pack(parts, large)
                    held = 0
            if len(seen) > 4 * HELD_ROWS:
                seen.clear()
        if parts:
            yield from pack(parts, large)

    return run


def _sorted_entries(columns: list[np.ndarray]) -> list[np.ndarray]:
    """By token; each token and class once, by its first item."""
    with np.errstate(over="ignore"):
        both = tokens.mix(columns[0] * _U(0x9E3779B97F4A7C15) + columns[1])
    order = np.argsort(both)
    repeated = ~_first_of_each(both[order])
    repeated[:-1] |= repeated[1:]
    if repeated.any():
        # only what stands there more than once is put in order by item
        again = order[repeated]
        by = [columns[i][again].view(np.int64) for i in range(len(columns) - 1, 4, -1)]
        again = again[np.lexsort((*by, columns[1][again], columns[0][again]))]
        again = again[_first_of_each(columns[0][again], columns[1][again])]
        order = np.concatenate([order[~repeated], again])
    order = order[np.argsort(columns[0][order])]
    return [c[order] for c in columns]


class _Wide:
    """The longer parities of the large sets of a bucket, by entry."""

    def __init__(self, frame: pd.DataFrame, cls: np.ndarray):
        self.at = np.full(len(cls), -1)
        blobs = [unpack(b, 1 + WIDE_WORDS) for b in frame["blob"][frame["kind"] == 4]]
        if blobs:
            known, *words = (np.concatenate(c) for c in zip(*blobs, strict=True))
            known, first = np.unique(known, return_index=True)
            self.words = np.stack([w[first] for w in words], axis=1)
            place = np.minimum(np.searchsorted(known, cls), len(known) - 1)
            self.at = np.where(known[place] == cls, place, -1)

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many parities of entries a and b differ; 0 where one of them has none."""
        out = np.zeros(len(a), dtype=np.int64)
        use = np.flatnonzero((self.at[a] >= 0) & (self.at[b] >= 0))
        if len(use):
            apart = self.words[self.at[a[use]]] ^ self.words[self.at[b[use]]]
            out[use] = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
        return out

    def columns(self) -> list[np.ndarray]:
        """A column for each word, 0 for sets that aren't large."""
        if not (self.at >= 0).any():
            return [np.zeros(len(self.at), dtype=_U)] * WIDE_WORDS
        return [np.where(self.at >= 0, w[self.at], _U(0)) for w in self.words.T]


def _differ(parities, wide: _Wide, a, b) -> np.ndarray:
    """How many parities of entries a and b differ, by those that tell more."""
    differ = sum(np.bitwise_count(p[a] ^ p[b]).astype(np.int64) for p in parities)
    return np.maximum(differ, wide.differ(a, b))


def _possible(size, pos, parities, wide, a, b) -> np.ndarray:
    """Length and positional bounds, and the bound on differences, of entries a and b."""
    na, nb, pa_, pb = size[a], size[b], pos[a], pos[b]
    need = required(na, nb)
    ok = np.minimum(na, nb) * DEN >= np.maximum(na, nb) * NUM
    ok &= np.minimum(pa_, pb) + 1 + np.minimum(na - pa_ - 1, nb - pb - 1) >= need
    if parities:
        some = np.flatnonzero(ok)
        differ = _differ(parities, wide, a[some], b[some])
        ok[some] = differ <= (na + nb - 2 * need)[some]
    return ok


def _all_pairs(token, size, pos, parities, wide, left):
    """All pairs (a, b) of one token that pass; entries lie by size within a token."""
    step = 1
    while len(left):
        left = left[left + step < len(token)]
        other = left + step
        same = token[left] == token[other]
        same &= size[left] * DEN >= size[other] * NUM
        left, other = left[same], other[same]
        ok = _possible(size, pos, parities, wide, left, other)
        yield left[ok], other[ok], np.zeros(ok.sum(), dtype=bool)
        step += 1


def _first_pairs(token, size, pos, parities, wide, left):
    """(a, b, whether a's search ends there): a with the first of its token that pass.

    Entries lie by document, and b before a. A search goes on while parities leave it in
    doubt whether the pair is similar, but past `MOST_DOUBTS` such pairs at most.
    """
    first = np.flatnonzero(_first_of_each(token))
    start = first[np.cumsum(_first_of_each(token)) - 1]
    doubts = np.zeros(len(token), dtype=np.int8)
    rank = 0
    while len(left):
        left = left[left - start[left] > rank]
        other = start[left] + rank
        ok = _possible(size, pos, parities, wide, left, other)
        a, b = left[ok], other[ok]
        differ = _differ(parities, wide, a, b)
        most = size[a] + size[b] - 2 * required(size[a], size[b])
        ends = (2 * differ <= most) | (doubts[a] >= MOST_DOUBTS)
        doubts[a] += 1
        yield a, b, ends
        ok[ok] = ends
        left = left[~ok]
        rank += 1


def _pairs_batches(many_at: int, adaptive: bool, wanted: np.ndarray | None = None):
    """Of one bucket: candidate pairs, and the rows of tokens with many classes."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        hot_rows: list[tuple[np.ndarray, ...]] = []
        found: list[tuple[np.ndarray, ...]] = []
        width = 5 if adaptive else 8
        marked = [unpack(b, width)[0] for b in frame["blob"][frame["kind"] == 1]]
        marked = np.unique(np.concatenate(marked)) if marked else np.zeros(0, dtype=_U)
        for kind in (0, 2):
            blobs = [unpack(b, width) for b in frame["blob"][frame["kind"] == kind]]
            if not blobs:
                continue
            columns = [np.concatenate(c) for c in zip(*blobs, strict=True)]
            blobs.clear()
            if kind == 0:
                # most tokens stand there once and go at once
                use = _repeated(columns[0])
                if len(marked):
                    use |= np.isin(columns[0], marked)
                columns = [c[use] for c in columns]
            entries = _sorted_entries(columns)
            members = _members(entries[0])
            hot = np.ones(len(members), dtype=bool) if kind == 2 else (members > many_at)
            if kind == 0 and len(marked):
                hot |= np.isin(entries[0], marked)
            if hot.any():
                rows = [c[hot] for c in entries]
                more = [] if adaptive else [rows[7], *_Wide(frame, rows[1]).columns()]
                hot_rows.append((*rows[:5], *more))
            entries = [c[~hot & (members > 1)] for c in entries]
            # by document, for the earliest match; else by size, where the length bound
            # ends the search early
            first_only = not adaptive and wanted is None
            by = [c.view(np.int64) for c in reversed(entries[5:])] if first_only else [entries[2]]
            order = np.lexsort((*by, entries[0]))
            token, cls, size, pos, extra = (c[order] for c in entries[:5])
            parities = [] if adaptive else [extra, entries[7][order]]
            wide = None if adaptive else _Wide(frame, cls)
            size, pos = size.astype(np.int64), pos.astype(np.int64)
            left = np.arange(len(token))
            search = _first_pairs if first_only else _all_pairs
            asked = np.ones(len(token), dtype=bool)
            if wanted is not None:
                asked = wanted[(cls >> _U(64 - WANTED_BITS)).astype(np.int64)]
            for a, b, ends in search(token, size, pos, parities, wide, left):
                use = asked[a] | asked[b]
                a, b, ends = a[use], b[use], ends[use]
                if not len(a):
                    continue
                one, two = tokens.signed(cls[a]), tokens.signed(cls[b])
                need = np.minimum(extra[a], extra[b]) if adaptive else np.zeros(len(a), dtype=_U)
                ended = np.where(ends, one, 0)
                found.append(
                    (np.minimum(one, two), np.maximum(one, two), need.view(np.int64), ended)
                )
        none = np.zeros(0, dtype=np.int64)
        x, y, need, ended = map(np.concatenate, zip(*found, strict=True)) if found else (none,) * 4
        names = [] if adaptive else ["more", *WIDE]
        rows = [np.concatenate(c) for c in zip(*hot_rows, strict=True)] or [none] * (5 + len(names))
        token, cls, size, pos, extra, *more = (c.view(np.int64) for c in rows)
        return pd.DataFrame(
            {
                "token": np.concatenate([token, ended]),
                "x": np.concatenate([cls, x]),
                "y": np.concatenate([np.zeros_like(cls), y]),
                "size": np.concatenate([size, np.zeros_like(x)]),
                "pos": np.concatenate([pos, np.zeros_like(x)]),
                "extra": np.concatenate([extra, need]),
                "hot": np.arange(len(cls) + len(x)) < len(cls),
            }
            | {n: np.concatenate([c, np.zeros_like(x)]) for n, c in zip(names, more, strict=True)}
        )

    return run


def _repeated(values: np.ndarray) -> np.ndarray:
    """Whether each of some values is there more than once."""
    order = np.argsort(values)
    same = ~_first_of_each(values[order])
    same[:-1] |= same[1:]
    out = np.empty(len(values), dtype=bool)
    out[order] = same
    return out


def _members(grouped: np.ndarray) -> np.ndarray:
    """For each of some values that lie together, how often its value is there."""
    if not len(grouped):
        return np.zeros(0, dtype=np.int64)
    group = np.cumsum(_first_of_each(grouped)) - 1
    return np.bincount(group)[group]


def candidates(
    texts: DataFrame, items_of: ItemsOf, counts: np.ndarray, many: int, adaptive: bool
) -> tuple[DataFrame, DataFrame]:
    """(pairs of classes, rows of tokens with more than `many` classes).

    Not adaptive, pairs are each class with the earliest ones that may be similar, by the
    documents of a column doc. A column `ended` names the class whose search under a token
    ended with the pair, which is all but surely similar; where it isn't after all,
    `remaining` finds all others of that class.
    """
    found = _exchange(
        texts,
        counts,
        lambda bits: _prefix_batches(items_of, counts, bits, many, adaptive),
        _pairs_batches(many, adaptive),
        adaptive,
    )
    more = [] if adaptive else ["more", *WIDE]
    hot = found.filter("hot").select(
        "token", F.col("x").alias("cls"), "size", "pos", "extra", *more
    )
    if not adaptive:
        return found.filter("not hot").select("x", "y", F.col("token").alias("ended")), hot
    pairs = (
        found.filter("not hot")
        .groupBy("x", "y")
        .agg(F.count("*").alias("shared"), F.min("extra").alias("need"))
        .filter("shared >= need")
        .select("x", "y")
    )
    return pairs, hot


def remaining(
    texts: DataFrame, items_of: ItemsOf, counts: np.ndarray, many: int, sets: DataFrame
) -> DataFrame:
    """All pairs of the classes of the given sets (few, as a rule), under tokens that aren't hot.

    Only prefix rows of tokens that these sets hold are dealt out again.
    """
    wanted = _wanted_bitmap(sets.select("cls"))
    held = sets.select("names")
    its_tokens = _wanted_bitmap(held.mapInArrow(_token_batches(counts), "cls long"))
    found = _exchange(
        texts,
        counts,
        lambda bits: _prefix_batches(items_of, counts, bits, many, False, its_tokens),
        _pairs_batches(many, False, wanted),
        False,
    )
    return found.filter("not hot").select("x", "y").distinct()


def _token_batches(counts: np.ndarray):
    """The prefix tokens of whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, dtype=_U)]
            for blob in batch.column("names"):
                names = np.frombuffer(blob.as_buffer(), dtype=_U)
                order = np.lexsort((names, _rank(names, counts)))
                found.append(names[order[: int(prefix_length(np.int64(len(names))))]])
            cls = np.unique(np.concatenate(found))
            yield pa.RecordBatch.from_arrays([pa.array(tokens.signed(cls))], names=["cls"])

    return run


def _rank(names: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rarity and then 32 bits of the name."""
    load = counts[(names >> _U(64 - BITS)).astype(np.int64)]
    return (load.astype(_U) << _U(32)) | (tokens.mix(names) >> _U(32))


def _exchange(
    texts: DataFrame, counts: np.ndarray, mapper: Callable, reducer: Callable, adaptive: bool
) -> DataFrame:
    # about a third of the tokens of similar sets lie in prefixes
    buckets = int(counts.sum(dtype=np.float64) / 3 / BUCKET_ROWS)
    bits = max(8, buckets.bit_length(), (shuffle_partitions(texts.sparkSession) - 1).bit_length())
    columns = [c for c in ("doc", "text") if c in texts.columns]
    schema = "token long, x long, y long, size long, pos long, extra long, hot boolean"
    if not adaptive:
        schema = ", ".join([schema, *(f"{c} long" for c in ("more", *WIDE))])
    return stored(
        texts.select(columns)
        .mapInArrow(mapper(bits), "bucket int, kind int, blob binary")
        .groupBy("bucket")
        .applyInPandas(reducer, schema),
        "set-candidates",
    )


def possible(a: str, b: str, adaptive: bool) -> Column:
    """The bounds of two rows of hot tokens, as a condition for Spark's join."""
    need = f"ceil({NUM} * ({a}.size + {b}.size) / {NUM + DEN}.0)"
    text = (
        f"least({a}.size, {b}.size) * {DEN} >= greatest({a}.size, {b}.size) * {NUM}"
        f" and least({a}.pos, {b}.pos) + 1"
        f" + least({a}.size - {a}.pos, {b}.size - {b}.pos) - 1 >= {need}"
    )
    if not adaptive:
        # large sets have all parities, others 0 for the longer ones
        few, wide = (
            " + ".join(f"bit_count({a}.{c} ^ {b}.{c})" for c in columns)
            for columns in (("extra", "more"), WIDE)
        )
        text += f" and {few} <= {a}.size + {b}.size - 2 * {need}"
        text += f" and (least({a}.size, {b}.size) < {WIDE_FROM}"
        text += f" or {wide} <= {a}.size + {b}.size - 2 * {need})"
    return F.expr(text)


def banded(rows: DataFrame, near: bool) -> DataFrame:
    """Rows with the band of their size; near: once for it and each neighbouring band.

    Similar sets meet in the band of one of them, and far fewer others meet there.
    """
    own = F.floor(F.log(F.col("size").cast("double")) / F.lit(np.log(BAND).item())).cast("int")
    if near:
        own = F.explode(F.array(own - 1, own, own + 1))
    return rows.withColumn("band", own)


# --- verification ---------------------------------------------------------------


def _bitmap_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << WANTED_BITS, dtype=bool)
    for batch in batches:
        cls = tokens.unsigned(batch.column("cls").to_numpy())
        bits[(cls >> _U(64 - WANTED_BITS)).astype(np.int64)] = True
    parts = bits.reshape(WANTED_SLICES, -1)
    some = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(some, pa.int32()),
            pa.array([np.packbits(parts[i]).tobytes() for i in some], pa.binary()),
        ],
        names=["slice", "counts"],
    )


def _or_bitmaps(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.bitwise_or.reduce([np.frombuffer(c, dtype=np.uint8) for c in frame["counts"]])
    return pd.DataFrame({"slice": frame["slice"].iloc[:1], "counts": [total.tobytes()]})


def _wanted_bitmap(classes: DataFrame) -> np.ndarray:
    """A table of bits (1 MB) that says of most unwanted classes that they are."""
    schema = "slice int, counts binary"
    rows = (
        classes.mapInArrow(_bitmap_batches, schema)
        .groupBy("slice")
        .applyInPandas(_or_bitmaps, schema)
        .collect()
    )
    out = np.zeros((WANTED_SLICES, (1 << WANTED_BITS) // WANTED_SLICES), dtype=bool)
    for r in rows:
        out[r["slice"]] = np.unpackbits(np.frombuffer(r["counts"], dtype=np.uint8)).astype(bool)
    return out.reshape(-1)


def _set_batches(items_of: ItemsOf, bitmap: np.ndarray, held_by: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            found, blobs = [], []
            texts = batch.column("text")
            if held_by is not None:
                places = tokens.unsigned(batch.column("place").to_numpy())
                texts = texts.filter(pa.array(listed(places, held_by)))
            for chunk in tokens.chunks(texts, CHUNK_BYTES):
                items = items_of(chunk)
                cls = items.classes()
                begins = items.begins
                use = np.flatnonzero(bitmap[(cls >> _U(64 - WANTED_BITS)).astype(np.int64)])
                for i in use:
                    c = int(cls[i].view(np.int64))
                    if c not in seen:
                        seen.add(c)
                        found.append(c)
                        blobs.append(items.names[begins[i] : begins[i] + items.counts[i]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array(blobs, pa.binary())], names=["cls", "names"]
            )

    return run


def whole_sets(
    texts: DataFrame, items_of: ItemsOf, classes: DataFrame, firsts: DataFrame | None = None
) -> DataFrame:
    """(cls, names): the sorted token names of the wanted classes, each once.

    Texts aren't shuffled: a table of bits leaves out most sets nobody asks for. With
    `firsts` (cls, doc), a document that holds each class, another one leaves out texts.
    """
    bitmap, held_by = _wanted_bitmap(classes), None
    columns = [F.col("text")]
    if firsts is not None:
        place = F.xxhash64("doc")
        held_by = _wanted_bitmap(firsts.join(classes, "cls", "left_semi").select(place.alias("cls")))
        columns.append(place.alias("place"))
    return stored(
        texts.select(*columns)
        .mapInArrow(_set_batches(items_of, bitmap, held_by), "cls long, names binary")
        .join(classes, "cls", "left_semi")
        .groupBy("cls")
        .agg(F.first("names").alias("names")),
        "set-members",
    )


def _parity_batches(items_of: ItemsOf, bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in tokens.chunks(batch.column("text"), CHUNK_BYTES):
                items = items_of(chunk)
                cls = items.classes()
                use = bitmap[(cls >> _U(64 - WANTED_BITS)).astype(np.int64)]
                if not use.any():
                    continue
                own = items.of(use)
                word, bit = own.names % _U(PARITY_WORDS), _U(1) << ((own.names >> _U(3)) & _U(63))
                columns = [
                    np.bitwise_xor.reduceat(np.where(word == _U(w), bit, _U(0)), own.begins)
                    for w in range(PARITY_WORDS)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.signed(c)) for c in (cls[use], *columns)],
                    names=["cls", *PARITIES],
                )

    return run


def parities(texts: DataFrame, items_of: ItemsOf, classes: DataFrame) -> DataFrame:
    """(cls, p0, p1, ...): parities of 512 hash bits over the sets of the wanted classes."""
    schema = ", ".join(f"{c} long" for c in ("cls", *PARITIES))
    return stored(
        texts.select("text")
        .mapInArrow(_parity_batches(items_of, _wanted_bitmap(classes)), schema)
        .join(classes, "cls", "left_semi")
        .distinct(),
        "set-parities",
    )


def parity_bound(a: str, b: str) -> Column:
    """Sets that differ in d tokens differ in d parities at most."""
    differ = " + ".join(f"bit_count({a}.{p} ^ {b}.{p})" for p in PARITIES)
    need = f"ceil({NUM} * ({a}.size + {b}.size) / {NUM + DEN}.0)"
    return F.expr(f"{differ} <= {a}.size + {b}.size - 2 * {need}")


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = batch.column("x"), batch.column("y")
        good = np.zeros(batch.num_rows, dtype=bool)
        for i, (a, b) in enumerate(
            zip(batch.column("names_x"), batch.column("names_y"), strict=True)
        ):
            one = np.frombuffer(a.as_buffer(), dtype=_U)
            two = np.frombuffer(b.as_buffer(), dtype=_U)
            at = np.minimum(np.searchsorted(two, one), len(two) - 1)
            both = int((two[at] == one).sum())
            good[i] = both * DEN >= NUM * (len(one) + len(two) - both)
        mask = pa.array(good)
        yield pa.RecordBatch.from_arrays([x.filter(mask), y.filter(mask)], names=["x", "y"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (x, y) whose whole sets reach the threshold."""
    one = sets.select(F.col("cls").alias("x"), F.col("names").alias("names_x"))
    two = sets.select(F.col("cls").alias("y"), F.col("names").alias("names_y"))
    return pairs.join(two, "y").join(one, "x").mapInArrow(_verify_batches, "x long, y long")


def classes_of(*frames: DataFrame) -> DataFrame:
    out = None
    for f in frames:
        for c in ("x", "y", "cls"):
            if c in f.columns:
                part = f.select(F.col(c).alias("cls"))
                out = part if out is None else out.unionAll(part)
    return out.distinct()
