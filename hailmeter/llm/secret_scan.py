"""Operator 4: secret scans by corpus-wide ownership frequency, in SQL functions only.

Base spans are found in every whole text by three patterns (assignments, access keys,
hexadecimal keys). The method then looks at what stands there: every candidate value,
of base spans and of any other long mixed token, is hashed, and for each hash the
distinct repositories and owners that hold it are counted over the whole corpus (here a
document is a repository and its source the owner). A value that more than
`MAX_OWNERS` owners or more than `MAX_REPOS` repositories hold is a widely copied
example; one that fewer hold looks like a live credential of theirs. Mixed tokens that
look live are added as spans of kind `live` where they touch no base span; base spans
always stay, with the verdicts counted.

A text is cut at the matches, and each match is written as the length of the piece before
it, its own length and the hash of its value. Positions are running sums of those lengths
in a window over the hits of one text and kind, so the work grows with n log n in the hits
of a text. Frequencies are counted in three steps (hash, owner, repository;
hash, owner; hash), each with map-side combination, so a value that a third of all
documents hold is a few rows per task; the join back may be split by the adaptive
skew join. Only lengths and hashes are shuffled, never texts or values.

Defined results: a null text is empty; a null source or doc_id is an owner or
repository of its own; repeated rows are scanned one by one; a very long text is one
row, its hits rows of their own that may spill; spans of equal start lie by kind; an empty
table gives an empty result; other columns are ignored. Positions count code points, ends
are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hailmeter.llm.common import stored

# The patterns of the three base kinds, and the least length of each.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # a whole run of the class: the same as a run of 32 or more
MIXED = r"[A-Za-z0-9+_=-]{20,}"
KINDS = ("assign", "access", "hex", "live")
COUNTED = ("n_assign", "n_access", "n_hex")
MIN_ASSIGN, MIN_ACCESS = 8, 16

MAX_OWNERS = 2
MAX_REPOS = 100
MIN_DIFFERENT = 10


def _hits(text: Column, pattern: str, group: int, kind: int, keep) -> Column:
    """array of (kind, i, gap, len, keep, hash) of all matches, leftmost first.

    `gap` is the length of the text between the match before and this one. A match to
    drop is there too, since it takes up its place.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.split(text, pattern, -1)
    zipped = F.arrays_zip(
        matches.alias("match"), values.alias("value"), F.slice(pieces, 1, F.size(matches)).alias("piece")
    )
    found = F.transform(
        zipped,
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(m["piece"]).alias("gap"),
            F.length(m["match"]).alias("len"),
            keep(m["value"]).alias("keep"),
            F.xxhash64(m["value"]).alias("hash"),
        ),
    )
    empty = F.expr(
        "cast(array() as array<struct<kind:int,i:int,gap:int,len:int,keep:boolean,hash:bigint>>)"
    )
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(empty)


def all_hits(text: Column) -> Column:
    return F.concat(
        _hits(text, ASSIGN, 2, 0, lambda v: F.length(v) >= MIN_ASSIGN),
        _hits(text, ACCESS, 0, 1, lambda v: F.length(v) >= MIN_ACCESS),
        _hits(text, HEX, 0, 2, lambda v: F.lit(True)),
        _hits(text, MIXED, 0, 3, _mixed),
    )


def _mixed(value: Column) -> Column:
    return (
        F.regexp_like(value, F.lit("[0-9]"))
        & F.regexp_like(value, F.lit("[A-Za-z]"))
        & (F.size(F.array_distinct(F.split(value, ""))) >= MIN_DIFFERENT)
    )


def _written(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document: (row, doc_id, owner, hits)."""
    # the row's number is written with it, so it is the same ever after
    return stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("owner"),
            all_hits(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("hits"),
        ),
        "secret-hits",
    )


def placed(found: DataFrame) -> DataFrame:
    """One row per candidate: (row, owner, repo, kind, start, stop, hash).

    Mixed tokens that touch a base span are none. Base spans that begin at or before one
    touch it if they end in it or after it; others if they begin before its end.
    """
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    spans = (
        found.filter(F.size("hits") > 0)
        .select("row", "owner", F.col("doc_id").alias("repo"), F.explode("hits").alias("hit"))
        .select("row", "owner", "repo", "hit.*")
        .withColumn("stop", F.sum(F.col("gap") + F.col("len")).over(upto))
        .withColumn("start", F.col("stop") - F.col("len"))
        .filter("keep")
    )
    reach = Window.unboundedPreceding, Window.currentRow
    before = Window.partitionBy("row").orderBy(F.col("start").asc()).rangeBetween(*reach)
    # the spans that begin later, as a frame that grows: one that shrinks costs squares
    after = Window.partitionBy("row").orderBy(F.col("start").desc()).rangeBetween(*reach)
    base = F.col("kind") < 3
    touched = F.coalesce(F.col("reached") > F.col("start"), F.lit(False)) | F.coalesce(
        F.col("next") < F.col("stop"), F.lit(False)
    )
    return (
        spans.withColumn("reached", F.max(F.when(base, F.col("stop"))).over(before))
        .withColumn("next", F.min(F.when(base, F.col("start"))).over(after))
        .filter(base | ~touched)
        .select("row", "owner", "repo", "kind", "start", "stop", "hash")
    )


def ownership(values: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos) from rows of (hash, owner, repo)."""
    return (
        values.groupBy("hash", "owner", "repo")
        .agg(F.lit(1).alias("one"))
        .groupBy("hash", "owner")
        .agg(F.count("*").alias("repos"))
        .groupBy("hash")
        .agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))
    )


def scan_secrets(
    docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS
) -> DataFrame:
    """One row per document: counts and spans, n_live and n_copied candidates, and the
    most owners and repositories that hold one of its candidates (0 without one)."""
    found = scanned(docs)
    values = stored(placed(found), "secret-spans")
    judged = values.join(ownership(values), "hash").withColumn(
        "live", (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    )
    span = F.struct("start", "kind", "stop")
    base = F.col("kind") < 3
    verdicts = judged.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(n) for k, n in enumerate(COUNTED)],
        F.array_sort(F.collect_list(F.when(base, span))).alias("base"),
        F.array_sort(F.collect_list(F.when(base | F.col("live"), span))).alias("spans"),
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_copied"),
        F.max("n_owners").alias("most_owners"),
        F.max("n_repos").alias("most_repos"),
    )
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,stop:bigint>>)")
    numbers = lambda *names: [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names]
    return (
        found.select("row", "doc_id")
        .join(verdicts, "row", "left")
        .select(
            "doc_id",
            *numbers(*COUNTED),
            F.sha2(_written(F.coalesce("base", none)), 256).alias("base_sha256"),
            _written(F.coalesce("spans", none)).alias("spans"),
            *numbers("n_live", "n_copied", "most_owners", "most_repos"),
        )
    )


def oracle() -> str:
    """The same rows in DuckDB: matches cut from the text, their places added up."""

    def spans(kind: int, pattern: str, group: int, keep: str) -> str:
        quoted = pattern.replace("'", "''")
        return f"""
  SELECT r, repo, owner, {kind} AS kind, first + before AS start, first + before + length(m) AS stop, v
  FROM (
    SELECT r, repo, owner, m, v,
      COALESCE(sum(length(p) + length(m)) OVER (PARTITION BY r ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
      length(p) AS first
    FROM (
      SELECT r, repo, owner, unnest(ms) AS m, unnest(vs) AS v, unnest(ps[1 : len(ms)]) AS p,
        unnest(range(len(ms))) AS i
      FROM (SELECT r, repo, owner, regexp_extract_all(t, '{quoted}', 0) AS ms,
              regexp_extract_all(t, '{quoted}', {group}) AS vs,
              string_split_regex(t, '{quoted}') AS ps FROM docs)))
  WHERE {keep}"""

    mixed = (
        "length(v) >= 20 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')"
        f" AND len(list_distinct(string_split(v, ''))) >= {MIN_DIFFERENT}"
    )
    written = "string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop)"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id AS repo, source AS owner, COALESCE(text, '') AS t
  FROM documents),
base AS ({spans(0, ASSIGN, 2, f"length(v) >= {MIN_ASSIGN}")}
  UNION ALL {spans(1, ACCESS, 0, f"length(v) >= {MIN_ACCESS}")}
  UNION ALL {spans(2, HEX, 0, "TRUE")}),
mixed AS (
  SELECT * FROM ({spans(3, MIXED, 0, mixed)}) AS m WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.r = m.r AND m.start < b.stop AND b.start < m.stop)),
found AS (SELECT * FROM base UNION ALL SELECT * FROM mixed),
owners AS (
  SELECT v, count(DISTINCT COALESCE('s' || owner, '')) AS n_owners, count(*) AS n_repos
  FROM (SELECT DISTINCT v, owner, repo FROM found) GROUP BY v),
judged AS (
  SELECT f.*, n_owners, n_repos, n_owners <= {MAX_OWNERS} AND n_repos <= {MAX_REPOS} AS live,
    {list(KINDS)}[kind + 1] AS name
  FROM found f JOIN owners USING (v)),
lists AS (
  SELECT r, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
    count(*) FILTER (WHERE kind = 2) AS n_hex,
    COALESCE({written} FILTER (WHERE kind < 3), '') AS base_spans,
    COALESCE({written} FILTER (WHERE kind < 3 OR live), '') AS spans,
    count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_copied,
    max(n_owners) AS most_owners, max(n_repos) AS most_repos
  FROM judged GROUP BY r)
SELECT repo AS doc_id, COALESCE(n_assign, 0)::BIGINT AS n_assign, COALESCE(n_access, 0)::BIGINT
  AS n_access, COALESCE(n_hex, 0)::BIGINT AS n_hex, sha256(COALESCE(base_spans, '')) AS base_sha256,
  COALESCE(spans, '') AS spans, COALESCE(n_live, 0)::BIGINT AS n_live,
  COALESCE(n_copied, 0)::BIGINT AS n_copied, COALESCE(most_owners, 0)::BIGINT AS most_owners,
  COALESCE(most_repos, 0)::BIGINT AS most_repos
FROM docs LEFT JOIN lists USING (r)"""
