"""Operator 3: benchmark decontamination by a prefix-filtered set join.

The words of a benchmark item are cut into windows of `WINDOW` consecutive words (an
item of fewer words is one window). A document word inside any occurrence of a window
is hit. A window occurs only where all of its shingles of `SHINGLE` words do, so, with
shingles ordered by rarity, one necessary prefix token per window is enough to find
every candidate: its rarest shingle. Rarity is the exact count of that shingle over
all documents, from a first pass. A document position with the prefix shingle of a
window is a candidate; its place in the window fixes where the window would begin, the
positional and length bounds throw out those that would begin before the first or end
after the last word, and the rest are verified word by word.

The benchmark is read in blocks of at most `BLOCK_WINDOWS` windows, so what is
sent to the executors has a bounded size however large the benchmark is; documents
are scanned twice per block, whole texts, without a shuffle. Only with several blocks
are the (small) results of a document brought together.

Defined results: null and empty texts have no words and no hits; an item without words
or with a null item_id is no item; item_ids that stand there several times with several
texts are one item; repeated documents are judged one by one; an empty benchmark hits
nothing; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailmeter.llm import tokens
from hailmeter.llm.common import stored

WINDOW = 10
SHINGLE = 5
#: Windows (of at most 10 words of 8 bytes) sent to the executors at once.
BLOCK_WINDOWS = 400_000


def _words(chunk: tokens.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names of the lower-cased words, words per row, and each word's bytes."""
    starts, ends = chunk.runs(tokens.ALNUM)
    counts = np.diff(np.searchsorted(starts, chunk.offsets))
    return chunk.span_hash(starts, ends, lower=True), counts, starts, ends


def _item_windows(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column("item_id"), {"item_id": [], "words": []}
            for chunk in tokens.chunks(batch.column("text")):
                words, counts, _, _ = _words(chunk)
                ends = np.cumsum(counts)
                for row in range(len(chunk)):
                    own = words[ends[row] - counts[row] : ends[row]]
                    item = ids[chunk.first + row].as_py()
                    for i in range(max(1, len(own) - window + 1) if len(own) else 0):
                        found["item_id"].append(item)
                        found["words"].append(own[i : i + window].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["item_id"], pa.string()), pa.array(found["words"], pa.binary())],
                names=["item_id", "words"],
            )

    return run


class Block:
    """A bounded number of distinct windows, ready to be looked up by prefix shingle."""

    def __init__(self, windows: list[bytes], items: list[list[str]], shingle: int):
        self.windows = [np.frombuffer(w, dtype=np.uint64) for w in windows]
        self.items = items
        self.shingle = shingle
        names, places = [], []
        for w in self.windows:
            width = min(shingle, len(w))
            names.append(tokens.window_hash(w, width))
            places.append(width)
        self.widths = sorted(set(places))
        self.shingles = {
            width: np.unique(np.concatenate([n for n, p in zip(names, places, strict=True) if p == width]))
            for width in self.widths
        }
        self._names = names

    def choose(self, frequency: dict[int, np.ndarray]) -> None:
        """The rarest shingle of each window becomes its prefix (ties: the first name)."""
        self.prefix: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        rows: dict[int, list[tuple[int, int, int]]] = {w: [] for w in self.widths}
        for i, names in enumerate(self._names):
            width = min(self.shingle, len(self.windows[i]))
            at = np.searchsorted(self.shingles[width], names)
            best = np.lexsort((names, frequency[width][at]))[0]
            if frequency[width][at[best]]:
                rows[width].append((int(names[best]), int(best), i))
        for width, found in rows.items():
            found.sort()
            self.prefix[width] = (
                np.array([f[0] for f in found], dtype=np.uint64),
                np.array([f[1] for f in found], dtype=np.int64),
                np.array([f[2] for f in found], dtype=np.int64),
            )


def _doc_shingles(words: np.ndarray, counts: np.ndarray, width: int):
    names, row, place = tokens.windows_by_row(words, counts, width, whole_short=False)
    begins = np.cumsum(counts) - counts
    return names, begins[row] + place


def _member(sorted_names: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Positions in `names` of those that are in the sorted list."""
    if not len(sorted_names):
        return np.zeros(0, dtype=np.int64)
    # a small bitmap of low bits first: nearly all lookups end there
    bits = np.uint64(0xFFFFF)
    seen = np.zeros(1 << 20, dtype=bool)
    seen[sorted_names & bits] = True
    maybe = np.flatnonzero(seen[names & bits])
    at = np.minimum(np.searchsorted(sorted_names, names[maybe]), len(sorted_names) - 1)
    return maybe[sorted_names[at] == names[maybe]]


def _frequency_batches(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {w: np.zeros(len(block.shingles[w]), dtype=np.int64) for w in block.widths}
        for batch in batches:
            for chunk in tokens.chunks(batch.column("text")):
                words, counts, _, _ = _words(chunk)
                for width, shingles in block.shingles.items():
                    names, _ = _doc_shingles(words, counts, width)
                    found = np.searchsorted(shingles, names[_member(shingles, names)])
                    total[width] += np.bincount(found, minlength=len(shingles))
        for width, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(at), width, dtype=np.int32)),
                    pa.array(at),
                    pa.array(n[at]),
                ],
                names=["width", "place", "n"],
            )

    return run


def _hits_in_chunk(chunk: tokens.Chunk, block: Block) -> list[tuple[int, list[int], list[str]]]:
    """Per row: words, hit spans (flat, merged) and the items with occurring windows."""
    words, counts, _, _ = _words(chunk)
    begins = np.cumsum(counts) - counts
    row_end = np.cumsum(counts)
    spans: dict[int, set[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    word_row = np.repeat(np.arange(len(counts)), counts)
    for width in block.widths:
        prefix, places, owners = block.prefix[width]
        names, at = _doc_shingles(words, counts, width)
        for k in _member(np.unique(prefix), names):
            low = np.searchsorted(prefix, names[k], side="left")
            high = np.searchsorted(prefix, names[k], side="right")
            row = int(word_row[at[k]])
            for j in range(low, high):
                window = block.windows[owners[j]]
                start = at[k] - places[j]
                if start < begins[row] or start + len(window) > row_end[row]:
                    continue
                if np.array_equal(words[start : start + len(window)], window):
                    first = int(start - begins[row])
                    spans.setdefault(row, set()).add((first, first + len(window)))
                    items.setdefault(row, set()).update(block.items[owners[j]])
    out = []
    for row in range(len(counts)):
        out.append((int(counts[row]), _merge(list(spans.get(row, ()))), sorted(items.get(row, ()))))
    return out


def _hit_batches(block: Block | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, list[int], list[str]]] = []
            for chunk in tokens.chunks(batch.column("text")):
                if block is None:
                    found += [(int(n), [], []) for n in _words(chunk)[1]]
                else:
                    found += _hits_in_chunk(chunk, block)
            keep = [batch.column(n) for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *keep,
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.list_(pa.int64())),
                    pa.array([f[2] for f in found], pa.list_(pa.string())),
                ],
                names=[*(n for n in batch.schema.names if n != "text"), "n_words", "spans", "items"],
            )

    return run


def benchmark_blocks(
    benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, size: int = BLOCK_WINDOWS
) -> Iterator[Block]:
    """Distinct windows with their items, in blocks of at most `size` windows."""
    items = benchmark.filter("item_id is not null").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    windows = stored(
        items.mapInArrow(_item_windows(window), "item_id string, words binary")
        .groupBy("words")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items")),
        "benchmark-windows",
    )
    held: list = []
    for row in windows.toLocalIterator():
        held.append(row)
        if len(held) == size:
            yield Block([bytes(r["words"]) for r in held], [r["items"] for r in held], shingle)
            held = []
    if held:
        yield Block([bytes(r["words"]) for r in held], [r["items"] for r in held], shingle)


def _count(rows: DataFrame, block: Block) -> None:
    """Counts the block's shingles over all rows and chooses the prefixes by that."""
    counted = (
        rows.select("text")
        .mapInArrow(_frequency_batches(block), "width int, place long, n long")
        .groupBy("width", "place")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    frequency = {w: np.zeros(len(s), dtype=np.int64) for w, s in block.shingles.items()}
    for r in counted:
        frequency[r["width"]][r["place"]] = r["n"]
    block.choose(frequency)


def _search(rows: DataFrame, block: Block) -> DataFrame:
    _count(rows, block)
    return rows.mapInArrow(_hit_batches(block), _found_schema(rows))


def _found_schema(rows: DataFrame) -> str:
    kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "text")
    return f"{kept}, n_words long, spans array<bigint>, items array<string>"


def _merge(pairs: list[tuple[int, int]]) -> list[int]:
    merged: list[int] = []
    for a, b in sorted(pairs):
        if merged and a <= merged[-1]:
            merged[-1] = max(merged[-1], b)
        else:
            merged += [int(a), int(b)]
    return merged


@F.pandas_udf(T.ArrayType(T.LongType()))
def _merge_spans(flat: pd.Series) -> pd.Series:
    return flat.map(lambda x: _merge(list(zip(x[::2], x[1::2], strict=True))))


def _merged(results: list[DataFrame]) -> DataFrame:
    """One row per document again, from one per document and block."""
    key = [c for c in results[0].columns if c not in ("n_words", "spans", "items")]
    return (
        reduce(DataFrame.unionAll, results)
        .groupBy(*key, "n_words")
        .agg(
            _merge_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            (F.count("*") / len(results)).cast("int").alias("_copies"),
        )
        .withColumn("_copies", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*key, "n_words", "spans", "items")
    )


def find_hits(
    rows: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Adds n_words, spans (first word and end of merged hit runs, flat) and items.

    `rows` has a column text, which is not carried on, and others, which are; equal
    rows must have equal texts, so a hash of the text belongs to them.
    """
    results = [
        _search(rows, block)
        for block in benchmark_blocks(benchmark, window, shingle, block_windows)
    ]
    if not results:
        return rows.mapInArrow(_hit_batches(None), _found_schema(rows))
    return results[0] if len(results) == 1 else _merged(results)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    found = find_hits(rows, benchmark, **options)
    n_hit = F.expr(
        "aggregate(spans, 0L, (a, x) -> a + x)"
        " - 2 * aggregate(sequence(0, size(spans) div 2 - 1), 0L, (a, i) -> a + spans[2 * i])"
    )
    return (
        found.withColumn(
            "n_hit", F.when(F.size("spans") == 0, F.lit(0).cast("long")).otherwise(n_hit)
        )
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
        .drop("text_hash")
    )


def _clean_batches(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean: list[bool] = []
            for chunk in tokens.chunks(batch.column("_text")):
                clean += [not spans for _, spans, _ in _hits_in_chunk(chunk, block)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit, with all their columns; block after block."""
    columns = docs.columns
    numbered = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)]
    rows = docs.select(*numbered, F.col("text").cast("string").alias("_text"))
    found = 0
    for block in benchmark_blocks(benchmark, **options):
        if found:
            rows = stored(rows, "decontaminated")
        found += 1
        _count(rows.select(F.col("_text").alias("text")), block)
        rows = rows.mapInArrow(_clean_batches(block), rows.schema)
    return rows.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(columns)])


def oracle() -> str:
    """The contract's columns in DuckDB, by joining every window of every document."""
    words = (
        "COALESCE(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
        " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"
    )
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
item AS (
  SELECT item_id::VARCHAR AS item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i + 1 : i + size], ' ') AS gram
  FROM (SELECT item_id, w, LEAST({WINDOW}, len(w)) AS size,
               unnest(range(0, GREATEST(1, len(w) - {WINDOW} + 1))) AS i
        FROM item WHERE len(w) > 0)),
grams AS (
  SELECT r, i, size, array_to_string(w[i + 1 : i + size], ' ') AS gram
  FROM (SELECT r, w, size, unnest(range(0, len(w) - size + 1)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
hits AS (SELECT r, i, size, item_id FROM grams JOIN windows USING (size, gram)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r),
matched AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, COALESCE(n_hit, 0)::BIGINT AS n_hit,
  COALESCE(n_items, 0)::BIGINT AS n_items, COALESCE(items_sha256, sha256('')) AS items_sha256,
  COALESCE(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN matched USING (r)"""
