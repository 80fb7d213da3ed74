"""Operator 6: n-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its 5-word shingles (words `[^\\x20\\x09-\\x0D]+`, A-Z
lower-cased; with fewer words the whole sequence is the one shingle). Two documents link
when their Jaccard similarity is 0.8 or more, and the result is the connected class
of each document.

Prefix filter: with shingles ordered by rarity, similar sets share a shingle among the
first 0.2 n + 1 of each. Lengthened by k - 1 places, the prefixes share k of them. Each
document chooses its own k (1 to 4) by estimated cost: the estimated number of other
sets under its prefix's shingles, read once, and at most that number over k to
verify. A pair is verified when it shares as many prefix shingles as the smaller of its
two demands, and passes the length and positional bounds (see setjoin.py).

Documents with equal sets are one class from the start. Shingles that very many classes
have in their prefix are first joined with one pivot each, the class with the most such
shingles (the plainest copy); classes that this already connects need no further
comparison, for they are in one component. All others under such a shingle are then
compared in full, but for pairs that parities of the whole sets tell apart. No candidate is capped.

Defined results: a document without words or text has no shingles and is its own
component; a null doc_id counts as the largest, and a component of such rows alone is
null; rows with equal doc_id are told apart by their text; repeated rows are kept; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailmeter.llm import setjoin, tokens
from hailmeter.llm.common import stored
from hailmeter.llm.repeats import LAST_DOC
from hailmeter.llm.setjoin import Items

SHINGLE = 5
#: Shingles in more prefixes are joined by pivots first.
MANY_SETS = 32


def _shingles(chunk: tokens.Chunk) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = chunk.runs(tokens.NON_SPACE)
    words = np.diff(np.searchsorted(starts, chunk.offsets))
    names, row, _ = tokens.windows_by_row(
        chunk.span_hash(starts, ends, lower=True), words, SHINGLE, whole_short=True
    )
    return names, row


def all_shingles(chunk: tokens.Chunk) -> np.ndarray:
    return _shingles(chunk)[0]


def shingle_sets(chunk: tokens.Chunk) -> Items:
    """The distinct shingles of each text that has a word."""
    names, row = _shingles(chunk)
    names, row = tokens.distinct_by_row(names, row)
    counts = np.bincount(row, minlength=len(chunk))
    some = np.flatnonzero(counts)
    return Items(names, counts[some], some, np.zeros(len(some), dtype=np.int64))


def _class_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cls = np.zeros(batch.num_rows, dtype=np.int64)
        size = np.zeros(batch.num_rows, dtype=np.int64)
        for chunk in tokens.chunks(batch.column("text")):
            items = shingle_sets(chunk)
            cls[chunk.first + items.row] = tokens.signed(items.classes())
            size[chunk.first + items.row] = items.counts
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("text_hash"), pa.array(cls), pa.array(size)],
            names=["doc", "text_hash", "cls", "n_shingles"],
        )


def components(links: DataFrame, label: str, start: DataFrame | None = None) -> DataFrame:
    """(cls, root): the smallest class reachable from each linked class.

    Every round each class takes the smallest root among its neighbours and itself, and
    from the third round on its root's root, too: stars need no more than that, and
    chains halve. Rounds end when nothing changes. Each round is a stored table, so no
    lineage grows and lost executors cost one round at most. `start` has roots of some
    of the classes, from fewer links.
    """
    both = stored(
        links.select(F.col("x").alias("cls"), F.col("y").alias("other")).unionAll(
            links.select("y", "x")
        ),
        f"{label}-links",
    )
    roots = both.groupBy("cls").agg(F.least("cls", F.min("other")).alias("root"))
    if start is not None:
        known = start.select("cls", F.col("root").alias("known"))
        roots = roots.join(known, "cls", "left").select("cls", F.least("root", "known").alias("root"))
    roots = stored(roots, label)
    for round_ in count(1):
        near = (
            both.join(roots.select(F.col("cls").alias("other"), "root"), "other")
            .groupBy("cls")
            .agg(F.min("root").alias("near"))
        )
        new = roots.join(near, "cls").select(
            "cls", F.least("root", "near").alias("root"), F.col("root").alias("before")
        )
        if round_ > 2:
            jump = roots.select(F.col("cls").alias("root"), F.col("root").alias("beyond"))
            new = new.join(jump, "root", "left").select(
                "cls", F.least("root", "beyond").alias("root"), "before"
            )
        new = stored(new, label)
        roots = new.select("cls", "root")
        if not new.filter("root <> before").take(1):
            return roots


def connected(texts: DataFrame) -> DataFrame:
    """(cls, root): the component of every class that links with another."""
    counts = setjoin.token_counts(texts, all_shingles)
    pairs, hot = setjoin.candidates(texts, shingle_sets, counts, MANY_SETS, adaptive=True)
    # The plainest copy of a group has the most shared shingles in its prefix, so most
    # of the group's shingles have it as their pivot, and each copy meets it once.
    plain = hot.groupBy("cls").agg(F.count("*").alias("n_hot"))
    hot = stored(hot.join(plain, "cls"), "near-hot")
    pivots = hot.groupBy("token").agg(
        F.max(F.struct("n_hot", "cls", "size", "pos", "extra")).alias("p")
    )
    pivots = pivots.select("token", "p.*")
    star = (
        hot.alias("a")
        .join(pivots.alias("b"), "token")
        .filter(F.expr("a.cls <> b.cls") & setjoin.possible("a", "b", adaptive=True))
        .select(
            F.least("a.cls", "b.cls").alias("x"), F.greatest("a.cls", "b.cls").alias("y")
        )
    )
    tried = stored(pairs.unionByName(star).distinct(), "near-pairs")
    sets = setjoin.whole_sets(texts, shingle_sets, setjoin.classes_of(tried))
    links = stored(setjoin.verified(tried, sets), "near-links")
    roots = components(links, "near-roots")
    if not hot.take(1):
        return roots
    rooted = (
        hot.join(roots, "cls", "left")
        .withColumn("root", F.coalesce("root", "cls"))
        .select("token", "cls", "size", "pos", "root")
    )
    spread = stored(
        rooted.groupBy("token", "root").agg(F.count("*").alias("n")), "near-spread"
    )
    # a token's largest component is never compared within itself
    largest = (
        spread.groupBy("token")
        .agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.count("*").alias("k"))
        .filter("k > 1")
        .drop("k")
    )
    apart = stored(rooted.join(largest, "token"), "near-apart")
    # parities of the whole sets tell most dissimilar pairs apart inside the join
    seen = setjoin.parities(texts, shingle_sets, setjoin.classes_of(apart))
    apart = stored(apart.join(seen, "cls"), "near-apart-parities")
    rest = (
        apart.filter("root <> largest")
        .alias("a")
        .join(apart.alias("b"), "token")
        .filter(
            F.expr("a.root <> b.root and (b.root = b.largest or a.cls < b.cls)")
            & setjoin.possible("a", "b", adaptive=True)
            & setjoin.parity_bound("a", "b")
        )
        .select(F.least("a.cls", "b.cls").alias("x"), F.greatest("a.cls", "b.cls").alias("y"))
        .distinct()
        .join(tried, ["x", "y"], "left_anti")
    )
    rest = stored(rest, "near-rest")
    if not rest.take(1):
        return roots
    more = setjoin.whole_sets(texts, shingle_sets, setjoin.classes_of(rest))
    found = stored(setjoin.verified(rest, more), "near-more")
    if not found.take(1):
        return roots
    return components(links.unionByName(found), "near-components", roots)


def grouped(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, n_shingles, component) of every document; doc is never null."""
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_DOC)).alias("doc"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    members = stored(
        texts.mapInArrow(_class_batches, "doc long, text_hash long, cls long, n_shingles long"),
        "near-classes",
    )
    roots = connected(texts)
    smallest = members.filter("n_shingles > 0").groupBy("cls").agg(F.min("doc").alias("doc"))
    rooted = smallest.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    named = rooted.groupBy("root").agg(F.min("doc").alias("component"))
    by_class = stored(rooted.join(named, "root").select("cls", "component"), "near-named")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc"))
    return members.join(by_class, "cls", "left").select(
        "doc", "text_hash", "n_shingles", component.alias("component")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    known = lambda c: F.when(F.col(c) < LAST_DOC, F.col(c))
    return grouped(docs).select(
        known("doc").alias("doc_id"), "n_shingles", known("component").alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component: the one with the smallest doc_id (then text hash).

    Documents without words are no copies of each other; of equal rows one stays.
    """
    rows = stored(grouped(docs), "near-grouped")
    chosen = (
        rows.filter("n_shingles > 0")
        .groupBy("component")
        .agg(F.min(F.struct("doc", "text_hash")).alias("c"))
        .select("c.*")
        .unionByName(rows.filter("n_shingles = 0").select("doc", "text_hash").distinct())
        .select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"))
    )
    numbered = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)]
    keyed = docs.select(
        *numbered,
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_DOC)).alias("_doc"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_hash"),
    )
    kept = keyed.join(chosen.hint("merge"), ["_doc", "_hash"]).dropDuplicates(["_doc", "_hash"])
    return kept.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])
