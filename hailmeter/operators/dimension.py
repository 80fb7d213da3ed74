"""Left joins of a huge fact to a dimension whose size is checked first."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 32
SALTS = 16
# A key with more than this share of all rows is spread; so there are at most
# 1 / HEAVY_SHARE such keys, and their list is small whatever the input.
HEAVY_SHARE = 1 / 256
# Bytes of a dimension that a cell of `attach_all` should hold at most.
CELL_BYTES = 32 * 1024 * 1024
# Lets a join take facts as they lie by their cell, where the join has more keys than that.
PART_OF_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
# Items a heavy-hitter sketch tracks: its error is far below HEAVY_SHARE.
TRACKED_ITEMS = 8_192


def measured_bytes(dim: DataFrame) -> int:
    """Rows x fixed widths plus the text actually held, from one aggregate."""
    return measured(dim)[1]


def measured(dim: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a dimension."""
    texts = [f.name for f in dim.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = ROW_OVERHEAD + 8 * len(dim.columns)
    lengths = [F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in texts]
    text = F.sum(reduce(lambda a, b: a + b, lengths)) if lengths else F.lit(0)
    row = dim.agg(F.count(F.lit(1)).alias("rows"), text.alias("text")).first()
    return row["rows"], row["rows"] * fixed + (row["text"] or 0)


def fits_broadcast(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(dim) <= max_bytes


def attach(
    facts: DataFrame,
    dim: DataFrame,
    on: list[tuple[str, str]],
    small: bool | None = None,
    salts: int = SALTS,
    heavy: Sequence[int] | None = None,
) -> DataFrame:
    """Left equi-join; `on` pairs a fact column with a dimension column.

    A dimension that fits is broadcast, so the fact never moves. `small` is
    None to measure the dimension here, True where its size follows from how
    it was built (a group-by over a bounded domain) or was measured before,
    and False for the shuffle join, which spreads each heavy key over `salts`
    tasks. Both joins return the same rows, and duplicate dimension keys fan
    the fact out in both. `heavy` are the heavy keys where they are known, from one
    pass for several joins (see `heavy_keys`).
    """
    if small is None:
        small = fits_broadcast(dim)
    joined = _map_side(facts, dim, on) if small else _salted(facts, dim, on, salts, heavy)
    return joined.drop(*[_key(i) for i in range(len(on))])


def _key(i: int) -> str:
    return f"_dim_key_{i}"


def _rename_keys(dim: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    return dim.withColumnsRenamed({right: _key(i) for i, (_, right) in enumerate(on)})


def _map_side(facts: DataFrame, dim: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    renamed = _rename_keys(dim, on)
    condition = [F.col(left) == F.col(_key(i)) for i, (left, _) in enumerate(on)]
    return facts.join(F.broadcast(renamed), condition, "left")


def key_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """One long for a key, alike for all integer types; NULL where a part is unknown."""
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    parts = [
        F.col(c).cast("long") if isinstance(df.schema[c].dataType, whole) else F.col(c)
        for c in columns
    ]
    known = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(known, F.xxhash64(*parts))


def heavy_keys(
    facts: DataFrame, joins: Mapping[str, Sequence[str]], share: float = HEAVY_SHARE
) -> dict[str, list[int]]:
    """Per join, the hashes of keys that hold more than `share` of all rows.

    All joins are answered by one scan: mergeable heavy-hitter sketches of bounded size,
    so no key is shuffled. A sketch never counts a key too low by more than its error,
    and a key that is spread without need changes no result.
    """
    return counted_heavy_keys(facts, joins, share)[0]


def counted_heavy_keys(
    facts: DataFrame, joins: Mapping[str, Sequence[str]], share: float = HEAVY_SHARE
) -> tuple[dict[str, list[int]], int]:
    """`heavy_keys`, and the number of rows, from the same scan; 0 without joins."""
    if not joins:
        return {}, 0
    most = int(1 / share)
    hashed = facts.select(
        *[key_hash(facts, columns).alias(f"_h{i}") for i, columns in enumerate(joins.values())]
    )
    row = hashed.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.expr(f"approx_top_k(_h{i}, {most}, {TRACKED_ITEMS})").alias(f"_h{i}")
            for i in range(len(joins))
        ],
    ).first()
    heavy = {
        name: [
            found["item"]
            for found in row[f"_h{i}"]
            if found["item"] is not None and found["count"] > row["n"] * share
        ]
        for i, name in enumerate(joins)
    }
    return heavy, row["n"]


@dataclass(frozen=True)
class Lookup:
    """A dimension too large to broadcast, as `attach_all` takes it."""

    dim: DataFrame
    left: str
    right: str
    heavy: Sequence[int]
    rows: int
    bytes: int


def shares(lookups: Sequence[Lookup], cells: int) -> list[int]:
    """Into how many parts each dimension's keys go; their product is about `cells`.

    A dimension is copied to all parts of the others, so larger ones get more parts. Each
    has enough of them for a cell to hold its share.
    """
    own = [max(1, -(-x.bytes // CELL_BYTES)) for x in lookups]
    while prod(own) < cells:
        best = max(range(len(own)), key=lambda i: lookups[i].bytes / own[i])
        own[best] += 1
    return own


def attach_all(
    facts: DataFrame,
    lookups: Sequence[Lookup],
    n_facts: int,
    derive: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Left joins with several large dimensions, for one shuffle of the facts.

    Facts go to cells, one coordinate for each dimension's key, and a dimension's rows to
    all cells that have their coordinate; so a fact finds all its rows where it is. Facts
    whose key is heavy or absent take any coordinate, by a hash of the row, and heavy rows
    go to all. Where the copies would be more rows than the facts, joins follow each other
    and move them each time. Rows are those of `attach` after `attach`.

    `derive` adds columns, keys maybe, that follow from a row's others: they aren't moved.
    """
    spark = facts.sparkSession
    parts = shares(lookups, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cells = prod(parts)
    if sum(x.rows * cells // n for x, n in zip(lookups, parts, strict=True)) > n_facts:
        facts = derive(facts)
        for x in lookups:
            facts = attach(facts, x.dim, [(x.left, x.right)], small=False, heavy=x.heavy)
        return facts
    spark.conf.set(PART_OF_KEYS, "false")
    whole = derive(facts)
    every = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns])
    cell = F.lit(0)
    for i, (x, n) in enumerate(zip(lookups, parts, strict=True)):
        key = key_hash(whole, [x.left])
        # not a coalesce: nothing is in an empty list, not even an absent key
        is_heavy = key.isNull() | key.isin(*x.heavy)
        own = F.when(is_heavy, F.pmod(F.xxhash64(every, F.lit(i)), F.lit(n)))
        cell = cell * F.lit(n) + own.otherwise(F.pmod(key, F.lit(n))).cast("int")
    # the cells' hashes decide which lie together; the dimensions follow the facts
    out = derive(whole.select(*facts.columns, cell.alias("_cell")).repartition("_cell"))
    for i, (x, n) in enumerate(zip(lookups, parts, strict=True)):
        below = prod(parts[i + 1 :])
        key = key_hash(x.dim, [x.right])
        all_parts = F.sequence(F.lit(0), F.lit(n - 1))
        at = F.when(key.isin(*x.heavy), all_parts).otherwise(F.array(F.pmod(key, F.lit(n)).cast("int")))
        others = F.explode(F.sequence(F.lit(0), F.lit(cells // n - 1)))
        copied = x.dim.withColumn("_at", F.explode(at)).withColumn("_other", others)
        high, low = F.floor(F.col("_other") / F.lit(below)), F.pmod("_other", F.lit(below))
        place = (high * F.lit(n) + F.col("_at")) * F.lit(below) + low
        copied = copied.withColumn("_dim_cell", place.cast("int")).drop("_at", "_other")
        renamed = _rename_keys(copied, [(x.left, x.right)]).hint("shuffle_hash")
        condition = [F.col("_cell") == F.col("_dim_cell"), F.col(x.left) == F.col(_key(0))]
        out = out.join(renamed, condition, "left").drop("_dim_cell", _key(0))
    return out.drop("_cell")


def _salted(
    facts: DataFrame,
    dim: DataFrame,
    on: list[tuple[str, str]],
    salts: int,
    heavy: Sequence[int] | None,
) -> DataFrame:
    """A shuffle join in which heavy and absent keys are salted, on both sides.

    The salt is a hash of the whole row: it spreads a key however its rows lie in
    the input, and a retried task sends them to the same places again. The dimension
    is hashed, so the wide fact rows are shuffled but never sorted.
    """
    lefts, rights = [left for left, _ in on], [right for _, right in on]
    if heavy is None:
        heavy = heavy_keys(facts, {"own": lefts})["own"]
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), F.lit(salts))
    is_heavy = F.coalesce(key_hash(facts, lefts).isin(*heavy), F.lit(True))
    salted = facts.withColumn("_salt", F.when(is_heavy, spread).otherwise(0).cast("int"))
    copies = F.when(key_hash(dim, rights).isin(*heavy), F.lit(salts)).otherwise(F.lit(1))
    copied = dim.withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    condition = [F.col(left) == F.col(_key(i)) for i, (left, _) in enumerate(on)]
    condition.append(F.col("_salt") == F.col("_dim_salt"))
    # The hint keeps a wrong size estimate from broadcasting the copies after all.
    renamed = _rename_keys(copied, on).hint("shuffle_hash")
    return salted.join(renamed, condition, "left").drop("_salt", "_dim_salt")
