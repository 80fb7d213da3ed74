"""Hashed character n-grams of whole texts, for the classifiers of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from hailmeter.llm import tokens

_FACTORS = tokens._splitmix(16, 11).astype(np.uint32) | np.uint32(1)


def code_points(chunk: tokens.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a chunk, Latin letters lower-cased, and where each row begins."""
    text = chunk.data.tobytes().decode("utf-8", errors="replace")
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).copy()
    begun = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
    upper = ((points >= 65) & (points <= 90)) | (
        (points >= 0xC0) & (points <= 0xDE) & (points != 0xD7)
    )
    points[upper] += 32
    points[(points >= 9) & (points <= 13)] = 32
    return points, begun[chunk.offsets]


def hashed(points: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each code point (fewer by order - 1)."""
    n = len(points) - order + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int32)
    total = points[:n] * _FACTORS[0] + np.uint32(order)
    for i in range(1, order):
        total ^= total >> np.uint32(15)
        total *= _FACTORS[order]
        total += points[i : i + n] * _FACTORS[i]
    total ^= total >> np.uint32(16)
    total *= np.uint32(0x85EBCA6B)
    return (total >> np.uint32(32 - bits)).astype(np.int32)


def row_grams(
    points: np.ndarray, begins: np.ndarray, orders: tuple[int, ...], bits: int
) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of each row, a space added at both ends."""
    for a, b in zip(begins[:-1], begins[1:], strict=True):
        own = np.full(b - a + 2, 32, dtype=np.uint32)
        own[1:-1] = points[a:b]
        yield np.concatenate([hashed(own, order, bits) for order in orders])


def batch_grams(column: pa.Array, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    for chunk in tokens.chunks(column):
        yield from row_grams(*code_points(chunk), orders, bits)
