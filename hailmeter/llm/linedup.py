"""Operator 2: line dedup by an exact set-similarity join.

A line is the set of its words (`[^\\x20\\x09-\\x0D]+`, A-Z lower-cased). A line is removed
when an earlier line (smaller doc_id, or line number within it, as the input has them) has a
Jaccard similarity of 0.8 or more with it; so the first of all similar lines stays.
Lines without a word are never compared and stay. Candidates come from a
prefix-filtered join over words ordered by rarity, under positional, length and
difference bounds (see setjoin.py), and are verified on whole sets.

Lines with equal sets are one class, which is compared once, at its first line: later
lines of a class go in any case, and its first line goes if a similar class has an
earlier line. Tokens with very many classes are first joined with one early pivot each,
and only classes without an earlier match after that are joined with all others of a like size.

Defined results: a null text has no lines; a null doc_id counts as greater than all
others; rows with equal doc_id are told apart by their text, lines of the same number in
them are none of them earlier, and equal rows have equal lines removed; an empty table gives an empty result; other columns are carried on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailmeter.llm import setjoin, tokens
from hailmeter.llm.common import bounded_batches, stored, unused_name
from hailmeter.llm.repeats import LAST_DOC
from hailmeter.llm.setjoin import Items

#: Pairs of so many lines under a word are compared by difference bounds right away.
MANY_LINES = 512

_NEWLINE = tokens.byte_class((0x0A, 0x0A))


def line_sets(chunk: tokens.Chunk, only: np.ndarray | None = None) -> Items:
    """The word sets of all lines with a word; lines are counted from 0 in each row.

    `only`, a table of bits, leaves lines out that have no word in it.
    """
    starts, ends = chunk.runs(tokens.NON_SPACE)
    breaks = np.flatnonzero(_NEWLINE[chunk.data])
    row = chunk.row_of(starts)
    line = np.searchsorted(breaks, starts) - np.searchsorted(breaks, chunk.offsets)[row]
    # lines of a chunk, numbered through
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
    item = np.cumsum(new) - 1
    row, line = row[new], line[new]
    names = chunk.span_hash(starts, ends, lower=True)
    if only is not None:
        asked = np.zeros(len(row), dtype=bool)
        asked[item[setjoin.listed(names, only)]] = True
        names, item = names[asked[item]], (np.cumsum(asked) - 1)[item[asked[item]]]
        row, line = row[asked], line[asked]
    names, item = tokens.distinct_by_row(names, item)
    return Items(names, np.bincount(item, minlength=len(row)), row, line)


def line_words(chunk: tokens.Chunk) -> np.ndarray:
    starts, ends = chunk.runs(tokens.NON_SPACE)
    return chunk.span_hash(starts, ends, lower=True)


def _line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines, and at last the task's table of the lines that hold each word."""
    names = ["doc", "text_hash", "line", "cls", "slice", "counts"]
    total = np.zeros(1 << setjoin.BITS, dtype=np.int64)
    for batch in batches:
        doc = batch.column("doc").to_numpy()
        text_hash = batch.column("text_hash").to_numpy()
        for chunk in tokens.chunks(batch.column("text"), setjoin.CHUNK_BYTES):
            items = line_sets(chunk)
            row = chunk.first + items.row
            np.add.at(total, setjoin.bucket_of(items.names), 1)
            lines = [doc[row], text_hash[row], items.number, tokens.signed(items.classes())]
            none = [pa.nulls(len(row), pa.int32()), pa.nulls(len(row), pa.binary())]
            yield pa.RecordBatch.from_arrays([*map(pa.array, lines), *none], names=names)
    table = setjoin.packed_counts(total)
    none = [pa.nulls(len(table[0]), pa.int64())] * 4
    yield pa.RecordBatch.from_arrays([*none, *table], names=names)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_DOC)).alias("doc"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def later_matches(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, lines): the numbers of the lines to remove, by document."""
    bounded_batches(docs.sparkSession)
    texts = _texts(docs)
    read = stored(
        texts.mapInArrow(
            _line_batches,
            "doc long, text_hash long, line long, cls long, slice int, counts binary",
        ),
        "line-classes",
    )
    counts = setjoin.summed_counts(read.filter("slice is not null").select("slice", "counts"))
    lines = read.filter("slice is null").drop("slice", "counts")
    first = stored(
        lines.groupBy("cls").agg(F.min(F.struct("doc", "line")).alias("at")),
        "line-firsts",
    )
    pairs, hot = setjoin.candidates(texts, line_sets, counts, MANY_LINES, adaptive=False)
    hot = stored(hot.join(first, "cls"), "line-hot")
    pivots = hot.groupBy("token").agg(
        F.min(F.struct("at", "cls", "size", "pos", "extra", "more", *setjoin.WIDE)).alias("p")
    )
    pivots = pivots.select("token", "p.*")
    star = (
        hot.alias("b")
        .join(pivots.alias("a"), "token")
        .filter(F.expr("a.at < b.at") & setjoin.possible("a", "b", adaptive=False))
        .select(F.least("a.cls", "b.cls").alias("x"), F.greatest("a.cls", "b.cls").alias("y"))
    )
    tried = stored(pairs.select("x", "y").unionByName(star).distinct(), "line-pairs")
    holders = first.select("cls", F.col("at.doc").alias("doc"))
    sets = setjoin.whole_sets(texts, line_sets, setjoin.classes_of(tried), holders)
    # of two similar classes, the one whose first line is later has an earlier match
    one = first.select(F.col("cls").alias("x"), F.col("at").alias("ax"))
    two = first.select(F.col("cls").alias("y"), F.col("at").alias("ay"))
    later = F.expr("case when ax < ay then y when ay < ax then x end").alias("y")
    similar = stored(setjoin.verified(tried, sets), "line-similar")
    found = stored(
        similar.join(one, "x").join(two, "y").select(later).dropna().distinct(), "line-matched"
    )
    # Each class was paired with the earliest that pass the bounds under each token. Where
    # the pair that ended its search isn't similar after all, a class without an earlier
    # match yet meets all others under its tokens.
    ended = pairs.filter("ended <> 0").join(similar, ["x", "y"], "left_anti")
    failed = ended.select(F.col("ended").alias("cls")).distinct()
    matched = found.select(F.col("y").alias("cls"))
    asked = stored(failed.join(matched, "cls", "left_anti"), "line-open")
    more = None
    if asked.take(1):
        # their whole sets are there already
        own = sets.join(asked, "cls", "left_semi")
        more = setjoin.remaining(texts, line_sets, counts, MANY_LINES, own)
    open_ones = hot.join(found, hot["cls"] == found["y"], "left_anti")
    rest = (
        setjoin.banded(open_ones, near=True).alias("b")
        .join(setjoin.banded(hot, near=False).alias("a"), ["token", "band"])
        .filter(F.expr("a.at < b.at") & setjoin.possible("a", "b", adaptive=False))
        .select(
            F.least("a.cls", "b.cls").alias("x"),
            F.greatest("a.cls", "b.cls").alias("y"),
        )
    )
    rest = (rest if more is None else rest.unionByName(more)).distinct()
    rest = stored(rest.join(tried, ["x", "y"], "left_anti"), "line-rest")
    if rest.take(1):
        # one pass over the texts for all sets that aren't there yet
        lacking = setjoin.classes_of(rest).join(sets, "cls", "left_anti")
        fetched = setjoin.whole_sets(texts, line_sets, lacking, holders)
        again = setjoin.verified(rest, sets.unionByName(fetched)).join(one, "x").join(two, "y")
        found = found.unionAll(again.select(later).dropna())
    matched = found.select(F.col("y").alias("cls"), F.lit(True).alias("matched"))
    judged = first.join(matched.distinct(), "cls", "left")
    removed = lines.join(judged, "cls").filter(
        F.col("matched").isNotNull() | (F.struct("doc", "line") != F.col("at"))
    )
    return removed.groupBy("doc", "text_hash").agg(F.collect_set("line").alias("lines"))


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        text_at, lines_at = names.index("_cut_text"), names.index("_cut_lines")
        texts, lines = batch.column(text_at), batch.column(lines_at)
        n_lines = pc.add(pc.count_substring(texts, "\n"), 1).cast(pa.int64()).fill_null(0)
        n_removed = pc.list_value_length(lines).cast(pa.int64()).fill_null(0)
        changed = pc.greater(n_removed, 0)
        kept_texts = []
        for text, gone in zip(
            texts.filter(changed).to_pylist(), lines.filter(changed).to_pylist(), strict=True
        ):
            drop = set(gone)
            own = text.split("\n")
            kept_texts.append("\n".join(x for i, x in enumerate(own) if i not in drop))
        kept_texts = pc.replace_with_mask(texts, changed, pa.array(kept_texts, texts.type))
        keep = [i for i in range(len(names)) if i not in (text_at, lines_at)]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i) for i in keep),
                kept_texts,
                n_lines,
                n_removed,
            ],
            names=[*(names[i] for i in keep), "_cut_text", "_cut_n_lines", "_cut_n_removed"],
        )


def dedup_lines(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """docs with later similar lines cut out of text, and two columns more.

    Returns the frame and the names of the columns with the number of lines of the
    text and of those removed.
    """
    removed = later_matches(docs).select(
        F.col("doc").alias("_cut_doc"),
        F.col("text_hash").alias("_cut_hash"),
        F.col("lines").alias("_cut_lines"),
    )
    others = [c for c in docs.columns if c != "text"]
    numbered = {c: f"_cut_{i}" for i, c in enumerate(others)}
    rows = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in numbered.items()],
        F.col("text").cast("string").alias("_cut_text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_DOC)).alias("_cut_doc"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_cut_hash"),
    )
    joined = rows.join(removed.hint("shuffle_hash"), ["_cut_doc", "_cut_hash"], "left").drop(
        "_cut_doc", "_cut_hash"
    )
    kept = joined.drop("_cut_text", "_cut_lines")
    schema = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes)
    schema = f"{schema}, " if schema else ""
    done = joined.mapInArrow(
        _cut_batches, f"{schema}_cut_text string, _cut_n_lines long, _cut_n_removed long"
    )
    n_lines = unused_name(docs, "n_lines")
    n_removed = unused_name(docs, "n_removed")
    back = [
        F.col("_cut_text").alias(c) if c == "text" else F.col(numbered[c]).alias(c)
        for c in docs.columns
    ]
    out = done.select(
        *back, F.col("_cut_n_lines").alias(n_lines), F.col("_cut_n_removed").alias(n_removed)
    )
    return out, n_lines, n_removed


def with_unique_lines(docs: DataFrame) -> DataFrame:
    """docs with later similar lines cut out, in the columns of docs.

    A document that loses all its words goes; n_chars, if there is one, is the length
    of the text that is left.
    """
    done, _, n_removed = dedup_lines(docs)
    worded = F.regexp_like(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]"))
    kept = done.filter((F.col(f"`{n_removed}`") == 0) | worded)
    if "n_chars" in docs.columns:
        changed = F.when(F.col(f"`{n_removed}`") > 0, F.length("text"))
        kind = dict(docs.dtypes)["n_chars"]
        kept = kept.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")).cast(kind))
    return kept.select(*[f"`{c}`" for c in docs.columns])
