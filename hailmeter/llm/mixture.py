"""Operator 1: mixing sources to target weights by a low-discrepancy schedule.

Every source gets a target of words; the mix is a sequence of slots, each of which
takes one block of `block_words` words from one source:

1. Targets. Sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3, ... and
   share the words of all sources. A target stops at `max_repeats` times its
   source's size; the excess is reshared by weight until none is above (solved in
   closed form: by cap / weight, the capped sources are a prefix).
2. Slots. Slot i has the point frac(i * a / n), where n counts all slots and a is
   an integer next to n * 0.618... that has no divisor in common with n: golden-ratio
   points rounded so that each n-th is met once. The cumulative shares of the targets
   map the point to a source, so any stretch of the schedule is near the target
   weights and the whole of it meets them. A slot's rank among its source's slots
   says which block it takes.
3. Blocks. A source's documents, shuffled by a seeded hash, follow each other as
   one stream of words that is cut into equal blocks (the last one may be short).
   Rank r takes block r mod m of the source's m blocks, so a source starts over when
   it is used up; the very last slot is cut where the target is reached.

Slots are ranked, and words are added up, in two levels (within ranges, and over
range totals), so that a source with a third of all rows is never one task's work. Equal
rows are counted first and lie together in the stream; they are dealt out in ranges again
once their place is known. Rows of one doc_id with different texts have places of their own.

Defined results: a null text has no words, takes part and is taken 0 times; null
sources are one source, the last; repeated rows count as often as they stand there;
a null doc_id is shuffled like any other; an empty table gives an empty result;
other input columns are ignored, whatever their names.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hailmeter.llm.common import stored

BLOCK_WORDS = 256
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix"
#: Slots of one range, within which they are ranked by one task.
RANGE_SLOTS = 8192
#: Equal rows that one task deals out at once.
RANGE_COPIES = 8192
#: Hexadecimal digits of the shuffling hash that name a range of documents.
RANGE_DIGITS = 3
GOLDEN = 0.6180339887498949
WORD = r"[^\x20\x09-\x0D]+"

_BEFORE = (Window.unboundedPreceding, -1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, place, copies): place is the hash that shuffles a source."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.col("text").cast("string")
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}|"), doc_id, F.lit("|"), digest)).alias("place"),
    )
    return rows.groupBy("doc_id", "source", "size", "place").agg(F.count("*").alias("copies"))


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per source: its target, and the slots and blocks that reach it.

    The windows here run over one row per source, never over documents.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    everything = Window.partitionBy()
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int")
    )
    shared = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(in_order) - 1)
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", (max_repeats * F.col("source_size")).cast("long"))
        # what the sources before can't take is shared by this one and all after it
        .withColumn("free_words", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(*_BEFORE)), F.lit(0)))
        .withColumn("free_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio.rowsBetween(*_BEFORE)), F.lit(0)))
        .withColumn("level", F.col("free_words") / F.col("free_weight"))
    )
    uncapped = F.col("cap") / F.col("weight") >= F.col("level")
    level = F.min_by(
        "level", F.when(uncapped, F.struct(F.col("cap") / F.col("weight"), F.col("source_no")))
    ).over(everything)
    words = F.least(F.floor(F.col("target") + 0.5), F.col("cap"))
    return (
        shared.withColumn("level", level)
        .withColumn(
            "target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level"))
        )
        .withColumn("words", words)
        .withColumn("n_blocks", F.ceil(F.col("source_size") / block_words))
        .withColumn("epochs", F.expr("if(source_size = 0, 0L, words div source_size)"))
        .withColumn("rest", F.col("words") - F.col("epochs") * F.col("source_size"))
        .withColumn(
            "slots", F.col("epochs") * F.col("n_blocks") + F.ceil(F.col("rest") / block_words)
        )
        .withColumn(
            "first_point",
            F.coalesce(
                F.sum("slots").over(Window.orderBy("source_no").rowsBetween(*_BEFORE)), F.lit(0)
            ),
        )
        .drop("free_words", "free_weight", "level", "cap")
    )


def _largest_quotient(a: int, n: int) -> int:
    """The largest partial quotient of a / n: small for evenly spread multiples."""
    largest = 0
    while a:
        largest = max(largest, n // a)
        n, a = a, n % a
    return largest


def _stride(n: int) -> int:
    """Of the integers next to n * GOLDEN that visit every n-th, the most even one."""
    near = range(max(1, round(n * GOLDEN) - 24), min(n, round(n * GOLDEN) + 25))
    good = [a for a in near if gcd(a, n) == 1] or [1]
    return min(good, key=lambda a: (_largest_quotient(a, n), abs(a - n * GOLDEN)))


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, source_no, rank, block, upto): which block each slot of the mix takes.

    `upto` is where, in the words of the source's stream, the slot's part ends.
    """
    n = targets.agg(F.sum("slots")).first()[0] or 0
    back = pow(_stride(n), -1, n) if n > 1 else 0
    wide = "decimal(19,0)"
    slot = (F.col("point").cast(wide) * F.lit(back).cast(wide)) % F.lit(max(n, 1)).cast(wide)
    points = (
        targets.filter("slots > 0")
        .withColumn(
            "begin",
            F.explode(
                F.expr(
                    f"sequence(first_point, first_point + slots - 1, bigint({RANGE_SLOTS}))"
                )
            ),
        )
        .repartition(F.col("begin"))
        .withColumn(
            "point",
            F.explode(
                F.expr(
                    f"sequence(begin, least(begin + {RANGE_SLOTS}, first_point + slots) - 1)"
                )
            ),
        )
        .withColumn("slot", slot.cast("long"))
        .withColumn("slot_range", F.expr(f"slot div {RANGE_SLOTS}"))
    )
    ranges = (
        points.groupBy("source_no", "slot_range")
        .agg(F.count("*").alias("n"))
        .withColumn(
            "earlier",
            F.coalesce(
                F.sum("n").over(
                    Window.partitionBy("source_no").orderBy("slot_range").rowsBetween(*_BEFORE)
                ),
                F.lit(0),
            ),
        )
        .drop("n")
    )
    inside = Window.partitionBy("source_no", "slot_range").orderBy("slot")
    return (
        points.join(ranges.hint("merge"), ["source_no", "slot_range"])
        .withColumn("rank", F.col("earlier") + F.row_number().over(inside) - 1)
        .withColumn("block", F.col("rank") % F.col("n_blocks"))
        .withColumn(
            "upto",
            F.when(
                (F.col("rank") == F.col("slots") - 1) & (F.col("rest") > 0), F.col("rest")
            ).otherwise(F.least((F.col("block") + 1) * block_words, F.col("source_size"))),
        )
        .select("slot", "source_no", "rank", "block", "upto")
    )


def streams(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Each document: where it begins and ends in its source's stream."""
    words = F.col("size") * F.col("copies")
    known = (
        sizes.alias("d")
        .join(
            targets.select("source", "source_no").alias("s"),
            F.col("d.source").eqNullSafe(F.col("s.source")),
        )
        .select("d.*", "source_no", F.substring("place", 1, RANGE_DIGITS).alias("part"))
    )
    parts = (
        known.groupBy("source_no", "part")
        .agg(F.sum(words).alias("n"))
        .withColumn(
            "earlier",
            F.coalesce(
                F.sum("n").over(
                    Window.partitionBy("source_no").orderBy("part").rowsBetween(*_BEFORE)
                ),
                F.lit(0),
            ),
        )
        .drop("n")
    )
    inside = Window.partitionBy("source_no", "part").orderBy("place", "doc_id", "size")
    groups = (
        known.join(parts.hint("merge"), ["source_no", "part"])
        .withColumn(
            "stop",
            F.col("earlier") + F.sum(words).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .withColumn("begin", F.col("stop") - words)
    )
    copies = f"sequence(0L, copies - 1, bigint({RANGE_COPIES}))"
    return (
        groups.withColumn("from", F.explode(F.expr(copies)))
        .repartition("source_no", "place", "doc_id", "from")
        .withColumn(
            "copy", F.explode(F.expr(f"sequence(from, least(from + {RANGE_COPIES}, copies) - 1)"))
        )
        .withColumn("start", F.col("begin") + F.col("copy") * F.col("size"))
        .withColumn("stop", F.col("start") + F.col("size"))
        .select("doc_id", "source_no", "size", "start", "stop")
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: how many of its words the mix takes, repeats counted."""
    sizes = stored(sized(docs, seed), "mix-sizes")
    totals = sizes.select("source", (F.col("size") * F.col("copies")).alias("size"))
    targets = stored(source_targets(totals, weights, max_repeats, block_words), "mix-targets")
    placed = stored(streams(sizes, targets), "mix-streams")
    takes = (
        schedule(targets, block_words)
        .groupBy("source_no", "block", "upto")
        .agg(F.count("*").alias("times"))
    )
    blocks = f"sequence(start div {block_words}, (stop - 1) div {block_words})"
    pieces = placed.filter("size > 0").withColumn("block", F.explode(F.expr(blocks)))
    overlap = F.greatest(
        F.lit(0),
        F.least("stop", "upto") - F.greatest("start", F.col("block") * block_words),
    )
    taken = (
        pieces.join(takes, ["source_no", "block"], "left")
        .groupBy("source_no", "start", "doc_id", "size")
        .agg(F.coalesce(F.sum(overlap * F.col("times")), F.lit(0)).alias("taken"))
    )
    columns = ["doc_id", "source_no", "size", "taken"]
    empty = placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return (
        taken.select(columns)
        .unionByName(empty.select(columns))
        .join(targets.select("source_no", "source", "source_size", "target"), "source_no")
        .select("doc_id", "source", "size", "source_size", "target", "taken")
    )


def oracle(source: str = "documents") -> str:
    """The same rows in DuckDB, without a schedule: full rounds, then a rest."""
    return f"""
WITH sized AS (
  SELECT doc_id, source,
         COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}|' || COALESCE(doc_id::VARCHAR, '') || '|' || md5(COALESCE(text, ''))) AS place
  FROM {source}),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [{', '.join(map(str, WEIGHTS))}][(source_no % {len(WEIGHTS)} + 1)::INT]::BIGINT AS weight,
         {MAX_REPEATS} * source_size AS cap FROM per),
levels AS (
  SELECT *, cap::DOUBLE / weight AS ratio,
    (sum(source_size) OVER () - COALESCE(sum(cap) OVER w, 0))::DOUBLE
      / (sum(weight) OVER () - COALESCE(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM weighed
  WINDOW w AS (ORDER BY cap::DOUBLE / weight, source_no
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, LEAST(cap::DOUBLE, weight * (
      SELECT level FROM levels WHERE ratio >= level ORDER BY ratio, source_no LIMIT 1)) AS target,
    cap
  FROM levels),
quotas AS (
  SELECT *, LEAST(floor(target + 0.5)::BIGINT, cap) AS words FROM targets),
placed AS (
  SELECT s.doc_id, s.source, s.size, q.source_size, q.target, q.words,
    (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id, s.size
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS stop
  FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, source, size, source_size, target,
  (CASE WHEN source_size = 0 THEN 0 ELSE
    (words // source_size) * size
    + GREATEST(0, LEAST(stop, words % source_size) - (stop - size)) END)::BIGINT AS taken
FROM placed"""
