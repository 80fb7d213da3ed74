"""Operator 5: quality rules with adaptive thresholds per language and source.

Each document gets a few exact counts in one pass. Thresholds don't come from a
table of constants: mergeable quantile sketches (Spark's `percentile_approx`, a
partial aggregate whose buffers merge) of every rule's ratio are built per (lang,
source) over its distinct count vectors, so that copies of a text, junk or not, weigh as
much as one of them however many there are, and a document fails a rule when its ratio
lies outside the far fences `q1 - reach * iqr` and `q3 + reach * iqr` of its own group,
widened by the rule's slack so that a group of nearly equal documents rejects none of
them. The slacks of repeated words and duplicate lines lie well below the base rule's cutoff, and
a few such words and lines are free: a document of 100 words and more may fail by its
repeated words alone, while a short one may say one phrase twice.

Defined results: a null text has no words (all counts 0, base rule fails, and no adaptive
rule applies, as there are no ratios); very long texts are counted whole; null
lang or source form groups of their own; repeated rows are judged one by one and all
stay; an empty table gives an empty result; input columns other than the four used
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailmeter.llm import tokens
from hailmeter.llm.common import stored

REPEAT_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SCHEMA = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)

#: One line or phrase that stands there again says little: so much repetition is free, which
#: weighs in a short document and hardly in a long one.
FREE_LINES = 2
FREE_WORDS = 3 * REPEAT_WORDS

#: rule -> (ratio, slack): how far beyond the fences of the group a ratio may lie.
RULES = {
    "word_length": ("word_chars / n_words", 2.0),
    "symbols": ("n_symbols / word_chars", 0.02),
    "dup_lines": (f"greatest(n_dup_lines - {FREE_LINES}, 0) / n_lines", 0.1),
    "repeats": (f"greatest(n_repeat_words - {FREE_WORDS}, 0) / n_words", 0.05),
}
REACH = 3.0
ACCURACY = 10_000

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_CONTINUED = tokens.byte_class((0x80, 0xBF))
_NOT_NEWLINE = ~tokens.byte_class((0x0A, 0x0A))


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated_words(word: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words of each row that lie in a window which its row has twice or more."""
    names, row, place = tokens.windows_by_row(word, counts, REPEAT_WORDS, whole_short=False)
    begins = np.concatenate([[0], np.cumsum(counts)])
    covered = np.zeros(len(word) + 1, dtype=np.int64)
    if len(names):
        order = np.lexsort((names, row))
        a, r = names[order], row[order]
        same = (a[1:] == a[:-1]) & (r[1:] == r[:-1])
        twice = np.zeros(len(a), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = begins[r[twice]] + place[order][twice]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + REPEAT_WORDS, -1)
    inside = np.cumsum(covered)[:-1] > 0
    return _per_row(inside, begins)


def _duplicate_lines(chunk: tokens.Chunk, word_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that equal an earlier line, by row."""
    starts, ends = chunk.runs(_NOT_NEWLINE)
    worded = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends = starts[worded], ends[worded]
    row = chunk.row_of(starts)
    names = chunk.span_hash(starts, ends)
    lines = np.bincount(row, minlength=len(chunk))
    _, kept = tokens.distinct_by_row(names, row)
    return lines, lines - np.bincount(kept, minlength=len(chunk))


def _counts(chunk: tokens.Chunk) -> np.ndarray:
    starts, ends = chunk.runs(tokens.NON_SPACE)
    n_words = np.diff(np.searchsorted(starts, chunk.offsets))
    # every byte of a word is non-space, and white space never continues a code point
    points = tokens.NON_SPACE[chunk.data] & ~_CONTINUED[chunk.data]
    lines, duplicates = _duplicate_lines(chunk, starts)
    word = chunk.span_hash(starts, ends)
    return np.stack(
        [
            n_words,
            _per_row(points, chunk.offsets),
            _per_row(_SYMBOL[chunk.data], chunk.offsets),
            duplicates,
            _repeated_words(word, n_words),
            lines,
        ]
    )


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [_counts(c) for c in tokens.chunks(batch.column("text"))]
        values = np.concatenate(parts, axis=1) if parts else np.zeros((len(COUNTS), 0))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("lang"), batch.column("source")]
            + [pa.array(v.astype(np.int64)) for v in values],
            names=["doc_id", "lang", "source", *COUNTS],
        )


def text_counts(docs: DataFrame) -> DataFrame:
    """The exact counts of every whole text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    ).mapInArrow(_count_batches, SCHEMA)


def thresholds(counted: DataFrame, reach: float = REACH, accuracy: int = ACCURACY) -> DataFrame:
    """Per (lang, source): the lowest and highest ratio that passes each rule."""
    quartiles = [
        F.percentile_approx(F.expr(ratio), [0.25, 0.75], accuracy).alias(rule)
        for rule, (ratio, _) in RULES.items()
    ]
    distinct = counted.filter("n_words > 0").select("lang", "source", *COUNTS).distinct()
    sketched = distinct.groupBy("lang", "source").agg(*quartiles)
    fences = []
    for rule, (_, slack) in RULES.items():
        low, high = F.col(rule)[0], F.col(rule)[1]
        fences += [
            (low - reach * (high - low) - slack).alias(f"{rule}_low"),
            (high + reach * (high - low) + slack).alias(f"{rule}_high"),
        ]
    return sketched.select("lang", "source", *fences)


def quality_rules(
    docs: DataFrame,
    reach: float = REACH,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per document: its counts, the rules it fails, and whether it is kept."""
    counted = stored(text_counts(docs), "quality")
    limits = thresholds(counted, reach, accuracy)
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    fails = F.filter(
        F.array(
            *[
                # a text without words has no ratios
                F.when(
                    F.col("n_words") > 0,
                    F.when(
                        ~F.expr(ratio).between(F.col(f"{rule}_low"), F.col(f"{rule}_high")),
                        F.lit(rule),
                    ),
                )
                for rule, (ratio, _) in RULES.items()
            ]
        ),
        lambda x: x.isNotNull(),
    )
    joined = counted.alias("d").join(
        limits.alias("t"),
        F.col("d.lang").eqNullSafe(F.col("t.lang"))
        & F.col("d.source").eqNullSafe(F.col("t.source")),
        "left",
    )
    return joined.select(
        "doc_id",
        *COUNTS,
        base.alias("base_failed"),
        fails.alias("failed_rules"),
        (~base & (F.size(fails) == 0)).alias("kept"),
    )


def oracle() -> str:
    """The query's rows in DuckDB, with exact quartiles.

    They are those of distinct count vectors, as the engine's; they equal the sketches' ones
    where a group has fewer of them than the accuracy.
    """
    ratios = {rule: ratio.replace("/", "::DOUBLE /") for rule, (ratio, _) in RULES.items()}
    quartiles = ", ".join(
        f"quantile_disc({ratio}, 0.25) AS {rule}_a, quantile_disc({ratio}, 0.75) AS {rule}_b"
        for rule, ratio in ratios.items()
    )
    passes = " AND ".join(
        f"COALESCE({ratios[rule]} BETWEEN {rule}_a - {REACH} * ({rule}_b - {rule}_a) - {slack}"
        f" AND {rule}_b + {REACH} * ({rule}_b - {rule}_a) + {slack}, TRUE)"
        for rule, (_, slack) in RULES.items()
    )
    worded = "regexp_matches(x, '[^\\x20\\x09-\\x0D]')"
    return f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, COALESCE(text, '') AS t,
    COALESCE(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i : i + {REPEAT_WORDS - 1}], ' ') AS gram
  FROM (SELECT r, w, unnest(range(1, len(w) - {REPEAT_WORDS - 2})) AS i FROM split)),
repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest(range(i, i + {REPEAT_WORDS})) AS p FROM (
      SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS k FROM windows) WHERE k > 1)
  GROUP BY r),
lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT x) AS d
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM split) WHERE {worded} GROUP BY r),
counted AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words,
    COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    COALESCE(d, 0)::BIGINT AS n_dup_lines, COALESCE(repeated.n, 0)::BIGINT AS n_repeat_words,
    COALESCE(lines.n, 0) AS n_lines
  FROM split LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)),
fences AS (
  SELECT lang AS of_lang, source AS of_source, {quartiles}
  FROM (SELECT DISTINCT * EXCLUDE (doc_id) FROM counted WHERE n_words > 0) GROUP BY 1, 2),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counted LEFT JOIN fences
    ON lang IS NOT DISTINCT FROM of_lang AND source IS NOT DISTINCT FROM of_source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {passes} AS kept
FROM judged"""
