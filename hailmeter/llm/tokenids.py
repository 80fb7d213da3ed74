"""Operator 11: token ids of whole texts in binary blocks, Re-Pair compressed.

`write_tokens` deals documents over tasks by ranges of doc_id, encodes each text with a
public tokenizer, appends the end id, and writes blocks of whole documents in ascending
order of doc_id: a Parquet dataset whose column `block` holds the bytes described in
`grammar`, beside what a reader needs to find a block without opening it. Executors write
through Spark alone, so the dataset may lie in any store that Spark reaches:

    blocks/   part, block_no, in_part (ids of the part before the block), n_ids, n_docs,
              least_doc, most_doc, block
    starts/   part, start (ids before the part): one row per writing task

`read_documents` gives each document's ids back, `read_ids` any range of the whole
sequence; that one touches only blocks that overlap it and expands only the symbols which
cover it. Places come from two levels of running sums: within a task while it writes, and
over one row per task afterwards.

A text is cut before its spaces, where each is followed by a visible character, and between
ASCII letters, digits, signs and single line feeds. The tokenizer's own first step cuts
there too (a space goes with the word behind it), so pieces are encoded by themselves, each
distinct one once as long as a worker remembers it, and give the whole text's ids. A text
with other spaces in it, or with one of the tokenizer's added tokens, is a piece as it
stands. Pieces are named by 64-bit hashes of their bytes. Vocabularies must be byte-level
ones that split like the default.

Defined results: a null or empty text has the end id alone; a null doc_id comes last;
rows of one doc_id lie in an order by their text, repeated rows one after the other; a very
long text is one document of one block, in one task; an empty table gives empty datasets
and an empty result; input columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailmeter.llm import grammar, tokens
from hailmeter.llm.common import shuffle_partitions
from hailmeter.session import work_dir

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: A block is closed once it has so many ids; it holds whole documents.
BLOCK_IDS = 250_000
#: Ids of distinct pieces that a worker remembers, places for their names (as a power of two),
#: and how many pieces are joined in a call.
MEMORY_IDS = 16_000_000
MEMORY_BITS = 22
JOINED = 200

BLOCKS = (
    "part int, block_no int, in_part long, n_ids long, n_docs int,"
    " least_doc long, most_doc long, block binary"
)

#: `[!-~\xC3-\xE0\xE4-\xF4]`: what a piece may begin with behind its space. Lead bytes of code
#: points that may be white space beyond ASCII (C2, E1, E2, E3) are left out: the safe side.
_VISIBLE = tokens.byte_class((0x21, 0x7E), (0xC3, 0xE0), (0xE4, 0xF4))
#: What may be encoded in one call with others: such a piece without other white space.
_PLAIN = re.compile(rb" ?[!-~\xc3-\xe0\xe4-\xf4][!-~\x80-\xc1\xc3-\xe0\xe4-\xf4]*")
#: Letters, digits, signs but for the apostrophe (which may begin a contraction), line feed:
#: the first step also cuts between ASCII characters of two of these kinds.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = 3
_KIND[0x27] = 0
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = 1
_FEED = 4
_KIND[0x0A] = _FEED


class Encoder:
    """Ids of whole texts by the tokenizers library, distinct pieces encoded once.

    A worker remembers the ids of pieces in one flat array. A piece's 64-bit name has one
    place in a table of fixed size, where the piece learned last stands; one that lost its
    place is encoded again. The worker begins anew when the ids are too many.
    """

    def __init__(self, path: str):
        # a task has one core; must be set before the library starts its threads
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [re.compile(re.escape(str(t.content).encode())) for t in added]
        vocabulary = self.tokenizer.get_vocab()
        # a byte-level vocabulary spells each byte by one character
        self.width = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for word, i in vocabulary.items():
            self.width[i] = len(word)
        self._forget()

    def _forget(self) -> None:
        self.names = np.zeros(1 << MEMORY_BITS, dtype=np.uint64)
        self.starts = np.zeros(1 << MEMORY_BITS, dtype=np.int32)
        # no size: nothing stands here yet
        self.sizes = np.zeros(1 << MEMORY_BITS, dtype=np.int32)
        self.pool = np.zeros(1 << 16, dtype=np.int32)
        self.held = 0

    def _pieces(self, chunk: tokens.Chunk) -> np.ndarray:
        """Where pieces begin: at each text, and at its cuts unless it is one piece."""
        data, offsets = chunk.data, chunk.offsets
        space = np.flatnonzero(data == 0x20)
        # no text's last byte has a visible one behind it
        last = np.zeros(len(data) + 1, dtype=bool)
        last[offsets[1:]] = True
        cut = ~last[space + 1]
        cut[cut] = _VISIBLE[data[space[cut] + 1]]
        whole = set(chunk.row_of(space[~cut]).tolist())
        raw = data.tobytes()
        for token in self.added:
            for found in token.finditer(raw):
                whole.add(int(chunk.row_of(np.array([found.start()]))[0]))
        kind = _KIND[data]
        left, right = kind[:-1], kind[1:]
        change = (left != right) & (left > 0) & (right > 0)
        # behind a line feed only where it is the only white space
        change[1:] &= (left[1:] != _FEED) | ((kind[:-2] > 0) & (kind[:-2] != _FEED))
        cuts = np.concatenate([space[cut], np.flatnonzero(change) + 1])
        if whole:
            cuts = cuts[~np.isin(chunk.row_of(cuts), np.fromiter(whole, dtype=np.int64))]
        begins = np.zeros(len(data), dtype=bool)
        begins[offsets[:-1][chunk.lengths > 0]] = True
        begins[cuts] = True
        return np.flatnonzero(begins)

    def _encode_joined(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain pieces, many in one call with line feeds between, and their sizes."""
        joined = [texts[i : i + JOINED] for i in range(0, len(texts), JOINED)]
        done = self.tokenizer.encode_batch_fast(
            [b"\n".join(some).decode() for some in joined], add_special_tokens=False
        )
        ids, sizes = [], []
        for some, one in zip(joined, done, strict=True):
            own = np.array(one.ids, dtype=np.int32)
            ends = np.cumsum(self.width[own])
            stop = np.cumsum([len(t) + 1 for t in some]) - 1
            at = np.searchsorted(ends, stop) + 1
            keep = np.ones(len(own), dtype=bool)
            keep[at[:-1]] = False  # the line feeds
            ids.append(own[keep])
            sizes.append(np.diff(np.concatenate([[0], at - np.arange(len(at))])))
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none.astype(np.int32), *ids]), np.concatenate([none, *sizes])

    def _remember(self, ids: np.ndarray) -> None:
        """Add ids to the pool, which doubles where it is too small."""
        if self.held + len(ids) > len(self.pool):
            pool = np.empty(2 * (self.held + len(ids)), dtype=np.int32)
            pool[: self.held] = self.pool[: self.held]
            self.pool = pool
        self.pool[self.held : self.held + len(ids)] = ids
        self.held += len(ids)

    def _learn(self, names: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of new pieces stand in the pool, and how many each has."""
        plain = np.array([_PLAIN.fullmatch(t) is not None for t in texts])
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        ids, counts = self._encode_joined([texts[i] for i in order[: plain.sum()]])
        before = self.held
        self._remember(ids)
        others = []
        for i in order[plain.sum() :]:
            one = self.tokenizer.encode(texts[i].decode(), add_special_tokens=False)
            self._remember(np.array(one.ids, dtype=np.int32))
            others.append(len(one.ids))
        counts = np.concatenate([counts, np.array(others, dtype=np.int64)])
        starts, sizes = np.empty_like(counts), np.empty_like(counts)
        starts[order] = before + np.cumsum(counts) - counts
        sizes[order] = counts
        # where two of them have one place, the same one has to win in all three arrays
        place = self._places(names)
        self.names[place] = names
        won = self.names[place] == names
        self.starts[place[won]], self.sizes[place[won]] = starts[won], sizes[won]
        return starts, sizes

    @staticmethod
    def _places(names: np.ndarray) -> np.ndarray:
        return (names >> np.uint64(64 - MEMORY_BITS)).view(np.int64)

    def encode(self, chunk: tokens.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a chunk, and how many each text has."""
        if self.held > MEMORY_IDS:
            self._forget()
        begins = self._pieces(chunk)
        ends = np.append(begins[1:], len(chunk.data))[: len(begins)]
        names = chunk.span_hash(begins, ends)
        place = self._places(names)
        starts = self.starts[place].astype(np.int64)
        sizes = self.sizes[place].astype(np.int64)
        unknown = np.flatnonzero((self.names[place] != names) | (sizes == 0))
        if len(unknown):
            new, first, which = np.unique(names[unknown], return_index=True, return_inverse=True)
            first = unknown[first]
            raw = chunk.data.tobytes()
            spans = zip(begins[first].tolist(), ends[first].tolist(), strict=True)
            found, counts = self._learn(new, [raw[a:b] for a, b in spans])
            starts[unknown], sizes[unknown] = found[which], counts[which]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(starts - upto[:-1], sizes)
        places += np.arange(len(places))
        return self.pool[places], np.diff(upto[np.searchsorted(begins, chunk.offsets)])


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    out = np.full(len(ids) + len(counts), end_id, dtype=np.int32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out


def _block(
    part: int, number: int, before: int, ids: list, sizes: list, docs: list
) -> pa.RecordBatch:
    counts = np.concatenate(sizes)
    known = np.array([d is not None for d in docs])
    doc_ids = np.array([d or 0 for d in docs], dtype=np.int64)
    made = grammar.re_pair(np.concatenate(ids), counts)
    real = doc_ids[known]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([number], pa.int32()),
            pa.array([before], pa.int64()),
            pa.array([int(counts.sum())], pa.int64()),
            pa.array([len(docs)], pa.int32()),
            pa.array([int(real.min()) if len(real) else None], pa.int64()),
            pa.array([int(real.max()) if len(real) else None], pa.int64()),
            pa.array([grammar.to_bytes(made, doc_ids, known)], pa.binary()),
        ],
        names=[c.split()[0] for c in BLOCKS.split(",")],
    )


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    tasks: int | None = None,
) -> None:
    """Encode every whole text and write the dataset to `path`.

    `vocabulary` is a tokenizer file that every executor has at that path (by default the
    installed public one). `tasks` is the number of ranges of doc_id, the session's number of
    shuffle partitions by default.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary is None:
            import public_tokenizers

            encoder = _encoder(public_tokenizers.path(VOCABULARY))
        else:
            encoder = _encoder(vocabulary)
        part = TaskContext.get().partitionId()
        ids, sizes, names, n, number, before = [], [], [], 0, 0, 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for chunk in tokens.chunks(batch.column("text")):
                own, counts = encoder.encode(chunk)
                ids.append(_with_end(own, counts, end_id))
                sizes.append(counts + 1)
                names += doc_ids[chunk.first : chunk.first + len(chunk)]
                n += len(ids[-1])
                if n >= block_ids:
                    yield _block(part, number, before, ids, sizes, names)
                    ids, sizes, names, number, before, n = [], [], [], number + 1, before + n, 0
        if names:
            yield _block(part, number, before, ids, sizes, names)

    spark = docs.sparkSession
    # A heavy doc_id (or none at all) is cut by its texts, and equal rows by their place.
    order = [
        F.col("doc_id").asc_nulls_last(), F.col("_text_hash"), F.col("_row")
    ]
    dealt = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
        )
        .withColumns(
            {"_text_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()}
        )
        .repartitionByRange(tasks or shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    dealt.mapInArrow(encode, BLOCKS).write.parquet(f"{path}/blocks")
    sizes = (
        spark.read.schema(BLOCKS)
        .parquet(f"{path}/blocks")
        .groupBy("part")
        .agg(F.sum("n_ids").alias("n"))
    )
    # one row per task of the write above, whatever the size of the corpus
    before = F.expr("sum(n) OVER (ORDER BY part) - n")
    sizes.select("part", before.alias("start")).coalesce(1).write.parquet(f"{path}/starts")


def _placed(spark: SparkSession, path: str) -> DataFrame:
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    starts = spark.read.schema("part int, start long").parquet(f"{path}/starts")
    return blocks.join(F.broadcast(starts), "part").withColumn(
        "start", F.col("start") + F.col("in_part")
    )


def _documents(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, data in zip(
            batch.column("start").to_pylist(), batch.column("block").to_pylist(), strict=True
        ):
            made, doc_ids, known = grammar.from_bytes(data)
            counts = np.diff(np.concatenate([[0], np.cumsum(made.expansion(made.symbols))])[made.places])
            ends = np.cumsum(counts)
            ids = made.expand(made.symbols).astype("<u4")
            columns = [
                pa.array(doc_ids, mask=~known),
                pa.array(start + ends - counts),
                pa.array(counts),
            ]
            if digest:
                raw = memoryview(ids.tobytes())
                spans = zip((4 * (ends - counts)).tolist(), (4 * ends).tolist(), strict=True)
                columns.append(pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()))
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            else:
                places = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(places, pa.array(ids.astype(np.int32))))
                names = ["doc_id", "start", "n_tokens", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a written dataset."""
    return _placed(spark, path).select("start", "block").mapInArrow(
        lambda batches: _documents(batches, digest=False),
        "doc_id long, start long, n_tokens long, ids array<int>",
    )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As `read_documents`, with a checksum in place of the ids."""
    return _placed(spark, path).select("start", "block").mapInArrow(
        lambda batches: _documents(batches, digest=True),
        "doc_id long, start long, n_tokens long, ids_crc32 long",
    )


def read_ids(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(start, ids) of the pieces of ids `start` to `stop`, by block, in no order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in zip(
                batch.column("start").to_pylist(), batch.column("block").to_pylist(), strict=True
            ):
                made, _, _ = grammar.from_bytes(data)
                a = max(start - first, 0)
                ids = made.ids(a, stop - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first + a]), pa.array([ids.tolist()], pa.list_(pa.int32()))],
                    names=["start", "ids"],
                )

    overlap = (F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start)
    found = _placed(spark, path).filter(overlap).select("start", "block")
    return found.mapInArrow(cut, "start long, ids array<int>")


def token_digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the dataset to the shared folder and return the contract's rows from it."""
    spark = docs.sparkSession
    path = work_dir(spark, "tokens")
    write_tokens(docs, path, vocabulary)
    return read_digests(spark, path)
