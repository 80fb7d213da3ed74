"""Whole texts of an Arrow batch as byte arrays: words, lines and window hashes.

Python tasks here never loop over words. A batch of documents is one byte buffer
with offsets, cut into chunks of a few megabytes; words are runs of bytes of one
class, and a word, line or window is named by a 64-bit polynomial hash of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1_000_000
_U = np.uint64


def _splitmix(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_BASE = 0xA24BAED4963EE407  # odd, hence invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)
_STEP = 0x9FB21C651E98DF25

_BYTE_VALUE = _splitmix(256, 7)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWER_VALUE = _BYTE_VALUE[_LOWER]

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        # as long as the chunks ask for: they are of another size in each operator
        size = 1 << (n - 1).bit_length()
        have = np.full(size, base, dtype=_U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: `[^\x20\x09-\x0D]+`: everything but ASCII white space.
NON_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: letters, digits, non-ASCII.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


class Chunk:
    """Some consecutive rows of a batch: their bytes, and where each row begins."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first = first
        self.data = data
        self.offsets = offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def runs(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the longest runs of bytes of a class; none crosses a row."""
        mask = table[self.data]
        before = np.empty_like(mask)
        after = np.empty_like(mask)
        if len(mask):
            before[0] = after[-1] = False
            before[1:] = mask[:-1]
            after[:-1] = mask[1:]
            full = self.offsets[:-1][self.lengths > 0]
            before[full] = False
            after[full[full > 0] - 1] = False
        return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1

    def span_hash(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """A 64-bit name of the bytes of each span; equal bytes have equal names."""
        n = len(self.data)
        power = _power_table(_BASE, n + 1)
        back = _power_table(_INVERSE, n + 1)
        total = np.zeros(n + 1, dtype=_U)
        value = (_LOWER_VALUE if lower else _BYTE_VALUE)[self.data]
        value *= power[:n]
        np.cumsum(value, out=total[1:])
        return mix((total[ends] - total[starts]) * back[starts])


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a string column, about `size` bytes at once; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, places, body = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield Chunk(
            first,
            data[offsets[first] : offsets[last]],
            offsets[first : last + 1] - offsets[first],
        )
        first = last


def window_hash(values: np.ndarray, width: int) -> np.ndarray:
    """Names of all windows of `width` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    total = values[:n].copy()
    factor = 1
    for i in range(1, width):
        factor = factor * _STEP % 2**64
        total += values[i : i + n] * _U(factor)
    return mix(total)


def windows_by_row(
    values: np.ndarray, counts: np.ndarray, width: int, whole_short: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, row, position in row) of every window of each row's values.

    A row with fewer values than `width`, but not none, has one window over all of
    them if `whole_short`, else none.
    """
    begins = np.concatenate([[0], np.cumsum(counts)])
    names = window_hash(values, width)
    per_row = np.maximum(counts - width + 1, 0)
    row = np.repeat(np.arange(len(counts)), per_row)
    place = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    out = names[begins[row] + place] if len(row) else np.zeros(0, dtype=_U)
    if whole_short:
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            extra = np.array(
                [window_hash(values[begins[r] : begins[r + 1]], int(counts[r]))[0] for r in short],
                dtype=_U,
            )
            # another length is another name, even where the sums agree
            extra = mix(extra + counts[short].astype(_U))
            out = np.concatenate([out, extra])
            row = np.concatenate([row, short])
            place = np.concatenate([place, np.zeros(len(short), dtype=place.dtype)])
    return out, row, place


def grouped_order(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The order by group, then value; groups of a chunk are small integers."""
    order = np.argsort(values)
    if len(group) and int(group.max()) < 1 << 16:
        return order[np.argsort(group[order].astype(np.uint16), kind="stable")]
    return order[np.argsort(group[order], kind="stable")]


def distinct_by_row(names: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct names; sorted by row, then name."""
    order = grouped_order(names, row)
    names, row = names[order], row[order]
    if len(names):
        keep = np.empty(len(names), dtype=bool)
        keep[0] = True
        keep[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
        names, row = names[keep], row[keep]
    return names, row


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def unsigned(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, dtype=np.int64).view(np.uint64)
