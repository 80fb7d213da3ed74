"""What operators move and leave behind must not grow faster than their input."""

import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hailmeter.llm import linedup, repeats, setjoin
from hailmeter.llm.common import BATCH_BYTES, stored

from .conftest import SCHEMA


def _long_lines(n, words, seed):
    rng = np.random.default_rng(seed)
    return [
        " ".join(["rareword", *(f"w{x}" for x in rng.choice(60_000, words, replace=False))])
        for _ in range(n)
    ]


def _texts(spark, lines):
    rows = [(i, x, "en", "a", None) for i, x in enumerate(lines)]
    return linedup._texts(spark.createDataFrame(rows, SCHEMA))


def _pairs(spark, lines, many):
    # a word that all lines have, yet the first in the order of rarity
    counts = np.ones(1 << setjoin.BITS, dtype=np.uint32) * 50
    chunk = next(iter(linedup.tokens.chunks(linedup.pa.array(["rareword"]))))
    counts[setjoin.bucket_of(linedup.line_words(chunk))] = 1
    return setjoin.candidates(_texts(spark, lines), linedup.line_sets, counts, many, False)


def test_unlike_long_lines_under_one_word_are_no_candidates(spark):
    lines = _long_lines(40, 300, 1)
    lines.append(" ".join(lines[7].split(" ")[:-20]))
    pairs, _ = _pairs(spark, lines, 512)
    assert pairs.select("x", "y").distinct().count() == 1


def test_unlike_long_lines_under_a_hot_word_are_no_candidates(spark):
    lines = _long_lines(40, 300, 2)
    lines.append(" ".join(lines[7].split(" ")[:-20]))
    _, hot = _pairs(spark, lines, 8)
    hot = stored(hot, "growth-hot")
    assert hot.count() == 41
    met = (
        setjoin.banded(hot, near=True).alias("b")
        .join(setjoin.banded(hot, near=False).alias("a"), ["token", "band"])
        .filter(F.expr("a.cls < b.cls") & setjoin.possible("a", "b", adaptive=False))
    )
    assert met.count() == 1


def test_sizes_of_similar_sets_lie_in_neighbouring_bands(spark):
    sizes = spark.range(1, 20_000).select(F.col("id").alias("size"))
    pairs = sizes.crossJoin(spark.createDataFrame([(k,) for k in range(2)], "k int")).select(
        "size", F.when(F.col("k") == 0, F.floor(F.col("size") * 1.25)).otherwise(F.col("size")).alias("other")
    )
    one = setjoin.banded(pairs, near=False).withColumnRenamed("band", "b")
    two = setjoin.banded(
        one.select(F.col("size").alias("s"), F.col("other").alias("size"), "b"), near=False
    )
    assert two.filter(F.abs(F.col("b") - F.col("band")) > 1).count() == 0
    assert setjoin.banded(sizes.limit(3), near=True).count() == 9


def test_lines_without_a_listed_word_are_left_out():
    chunk = next(iter(linedup.tokens.chunks(linedup.pa.array(["a b\n\nc d e", None, "x a\ny"]))))
    only = np.zeros(1 << setjoin.WANTED_BITS, dtype=bool)
    a, e = (
        linedup.line_words(next(iter(linedup.tokens.chunks(linedup.pa.array([w]))))) for w in "ae"
    )
    for name in (a, e):
        only[(name >> np.uint64(64 - setjoin.WANTED_BITS)).astype(int)] = True
    whole, some = linedup.line_sets(chunk), linedup.line_sets(chunk, only)
    assert list(zip(whole.row, whole.number)) == [(0, 0), (0, 2), (2, 0), (2, 1)]
    assert list(zip(some.row, some.number)) == [(0, 0), (0, 2), (2, 0)]
    assert some.counts.tolist() == [2, 3, 2]
    assert some.names.tolist() == whole.names[:7].tolist()


def _shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles().toList()
    return {
        name
        for i in range(files.size())
        if (name := files.apply(i).getName()).startswith("shuffle_")
    }


def test_a_stored_table_leaves_no_shuffle_files_behind(spark):
    before = _shuffle_files(spark)
    rows = spark.range(2000).groupBy((F.col("id") % 50).alias("k")).agg(F.sum("id").alias("s"))
    table = stored(rows, "growth")
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert table.count() == 50


def _boxed(lines, bits, held, monkeypatch):
    """Bytes and rows of packed runs, by kind and bucket."""
    monkeypatch.setattr(repeats, "HELD_ROWS", held)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(lines)), pa.int64()), pa.array(lines)], names=["doc", "text"]
    )
    rows = [r for b in repeats._map_runs(50, 24, bits)(iter([batch])) for r in b.to_pylist()]
    count = lambda r: int(np.frombuffer(r["blob"], "<u8", 1)[0])
    return {
        kind: np.bincount(
            [r["bucket"] for r in rows if r["kind"] == kind],
            [count(r) for r in rows if r["kind"] == kind],
            1 << bits,
        )
        for kind in (0, 3)
    }


def test_runs_are_dealt_evenly_over_buckets(monkeypatch):
    found = _boxed(_long_lines(200, 300, 3), 4, 10**9, monkeypatch)[0]
    assert found.sum() > 10_000
    assert found.max() < 1.3 * found.mean()


def test_copies_that_are_covered_already_fill_no_single_bucket(monkeypatch):
    passage = "one passage of some sixty bytes that very many texts hold as it is"
    found = _boxed([passage] * 4000, 4, 10**9, monkeypatch)[3]
    assert found.sum() >= 3999
    assert found.max() < 1.3 * found.mean()


def test_buckets_of_runs_grow_with_the_input(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "200")
    assert repeats._bucket_bits(session, 10**6) == 8
    assert repeats._bucket_bits(session, 10**10) == 11
    assert repeats._bucket_bits(session, 10**15) == repeats.MOST_BITS


def test_texts_for_repeats_come_in_batches_of_bounded_bytes(spark):
    session = spark.newSession()
    docs = session.createDataFrame([(1, "word " * 99, "en", "a", None)], SCHEMA)
    assert repeats.remove_repeats(docs).count() == 1
    assert session.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == BATCH_BYTES
