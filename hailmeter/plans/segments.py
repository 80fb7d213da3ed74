"""Trip-zone segmentation: features, k-means, Davies-Bouldin index."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from hailmeter.operators.demand import average, known
from hailmeter.operators.dimension import attach, fits_broadcast
from hailmeter.operators.enrich import UnzonedTrips, grouped_sums
from hailmeter.session import materialize

FEATURES = (
    "trip_count",
    "avg_total_amount",
    "avg_fare_amount",
    "avg_tip_amount",
    "avg_duration_minutes",
    "avg_distance",
    "pct_rush_hour",
    "pct_night",
    "pct_weekend",
    "pct_adverse_weather",
)
CLUSTER_COUNTS = (3, 4, 5, 6)
# First centres are drawn from so many rows with the least hashes: a bounded sample that
# depends on the rows alone, not on files, partitions or their number.
SEED_ROWS = 2_000
MAX_STEPS = 20
TOLERANCE = 1e-4
# Centres of a block meet each other in one row; their number has no cap.
BLOCK_CENTRES = 1_000


_AVERAGED = {
    "avg_total_amount": "total_amount",
    "avg_fare_amount": "fare_amount",
    "avg_tip_amount": "tip_amount",
    "avg_duration_minutes": "trip_duration_minutes",
    "avg_distance": "trip_distance",
    "pct_rush_hour": "is_rush_hour",
    "pct_night": "is_night",
    "pct_weekend": "is_weekend",
    "pct_adverse_weather": "is_adverse_weather",
}


def zone_features(
    fact: DataFrame | UnzonedTrips, keys: Sequence[str] = ("pickup_zone_id",)
) -> DataFrame:
    """Ten features per group of trips; the grouping is a parameter.

    The defining query is unpublished. Shares are averages of the flags, an
    unknown flag being left out. Keys that are no zone's attributes need no zones at all.
    """
    sums = {"trip_count": F.lit(1).cast("bigint")}
    for name, source in _AVERAGED.items():
        sums[f"_{name}_total"] = F.col(source).cast("double")
        sums[f"_{name}_known"] = known(source)
    return grouped_sums(fact, keys, sums).select(
        *keys,
        "trip_count",
        *[average(f"_{name}_total", f"_{name}_known").alias(name) for name in _AVERAGED],
    )


def _doubles(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in features})


def scaling(features: Sequence[str] = FEATURES) -> Pipeline:
    """Impute unknowns with the mean, then centre and scale to unit deviation."""
    imputed = [f"_{c}" for c in features]
    return Pipeline(
        stages=[
            Imputer(inputCols=list(features), outputCols=imputed, strategy="mean"),
            VectorAssembler(inputCols=imputed, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="scaled", withMean=True, withStd=True),
        ]
    )


def standardize_features(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """The features replaced by their standard scores."""
    # Both fits and the result read the features: store them once.
    ready = materialize(_doubles(df, features), "features")
    scores = vector_to_array(F.col("scaled"))
    others = [c for c in df.columns if c not in features]
    return (
        scaling(features)
        .fit(ready)
        .transform(ready)
        .select(*others, *[scores[i].alias(c) for i, c in enumerate(features)])
    )


@dataclass
class Segmentation:
    """Scaled features with one cluster column per k, and the centres behind it.

    `centres[k][i]` is the centre of cluster i + 1 in scaled units: k short rows.
    """

    points: DataFrame
    scaler: PipelineModel
    centres: dict[int, list[tuple[float, ...]]]
    features: tuple[str, ...]


def assign_to_centres(
    df: DataFrame, centres: DataFrame, cluster: str, features: Sequence[str], label: str
) -> DataFrame:
    """Each row with the nearest of given centres as `label`; the least one among equals.

    `centres` has one row per cluster with the same features. They travel as one short
    array; where that would be too large to send, rows meet them in blocks.
    """
    point = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    member = F.struct(F.col(cluster).alias("cluster"), point.alias("at"))
    known = centres.filter(F.col(cluster).isNotNull())
    blocks = materialize(_blocks(known, cluster, member), "centres")
    n = 1 + blocks.agg(F.coalesce(F.max("_b"), F.lit(0))).first()[0]
    row, keep = "_row", [F.col(f"`{c}`") for c in df.columns]
    near = F.array_min(
        F.transform(
            "_members",
            lambda m: F.struct(distance(point, m["at"]).alias("d"), m["cluster"].alias("cluster")),
        )
    )
    small = fits_broadcast(blocks)
    if n == 1:
        met = df.withColumn("_block", F.lit(0))
        found = attach(met, blocks, [("_block", "_b")], small=small).withColumn("_near", near)
        return found.select(*keep, F.col("_near.cluster").alias(label))
    # the best of each block, then the best of all: rows are told apart by a stored number
    numbered = materialize(df.withColumn(row, F.monotonically_increasing_id()), "rows")
    met = numbered.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    best = (
        attach(met, blocks, [("_block", "_b")], small=small)
        .groupBy(row)
        .agg(F.min(near).alias("_near"))
    )
    return numbered.join(best, row).select(*keep, F.col("_near.cluster").alias(label))


def _blocks(df: DataFrame, key: str, member: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by, _b, _members): rows dealt by hash to blocks of about BLOCK_CENTRES."""
    n = max(1, -(-df.count() // BLOCK_CENTRES))
    block = F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    return df.groupBy(*by, block.alias("_b")).agg(F.collect_list(member).alias("_members"))


def lloyd_step(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """New centres of an assignment: the mean of each feature, and the number of rows."""
    known = df.filter(F.col(cluster).isNotNull())
    return known.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(c) for c in features]
    )


def centroid_pivot(
    df: DataFrame, cluster: str, features: Sequence[str], clusters: Sequence
) -> DataFrame:
    """Feature x cluster of an assignment, means in the features' own units.

    One aggregate by cluster and feature; `clusters` names the columns.
    """
    tall = df.filter(F.col(cluster).isin(*clusters)).select(
        F.col(cluster).alias("_cluster"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                    for c in features
                ]
            )
        ),
    )
    means = [
        F.avg(F.when(F.col("_cluster") == c, F.col("value"))).alias(f"cluster_{i}")
        for i, c in enumerate(clusters, 1)
    ]
    return tall.groupBy("feature").agg(*means)


def first_centres(sample: Sequence[Sequence[float]], k: int) -> list[tuple[float, ...]]:
    """k rows of a bounded sample: the first, then always the one farthest from those taken."""
    points = np.asarray(sample, dtype=float)
    taken = [0]
    far = np.linalg.norm(points - points[0], axis=1)
    while len(taken) < min(k, len(points)):
        taken.append(int(np.argmax(far)))
        far = np.minimum(far, np.linalg.norm(points - points[taken[-1]], axis=1))
    return [tuple(points[i]) for i in taken]


def _nearest(point: str, centres: Sequence[Sequence[float]]) -> str:
    """SQL: 1-based number of the nearest of a few literal centres; NULL where there are none.

    As text, since a step's plan would take longer to build from columns than to run.
    """
    if not centres:
        return "CAST(NULL AS INT)"
    rows = ", ".join(
        "array(" + ", ".join(f"double('{float(x)!r}')" for x in c) + ")" for c in centres
    )
    square = f"aggregate(zip_with({point}, c, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x)"
    return f"array_min(transform(array({rows}), (c, i) -> struct(sqrt({square}) AS d, i + 1 AS i))).i"


def fit_segments(
    df: DataFrame,
    counts: Sequence[int] = CLUSTER_COUNTS,
    features: Sequence[str] = FEATURES,
    max_steps: int = MAX_STEPS,
) -> Segmentation:
    """One k-means per k over the same scaled rows: Lloyd steps, all models side by side.

    A step is a single aggregate: every row is given the nearest centre of each model and
    the means of all clusters come back, a few short rows. It ends when no centre moves by more than TOLERANCE.
    A cluster that loses all its rows keeps its centre. The rows are written once to the
    shared folder first: a lost executor must not bring back the fact scan.
    """
    stored = materialize(_doubles(df, features), "segments")
    scaler = scaling(features).fit(stored)
    scaled = scaler.transform(stored).drop(*[f"_{c}" for c in features], "_raw")
    points = materialize(scaled.withColumn("scaled", vector_to_array("scaled")), "scaled")
    place = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    sample = points.select("scaled").orderBy(place, "scaled").limit(SEED_ROWS).collect()
    rows = [tuple(r.scaled) for r in sample]
    centres = {k: first_centres(rows, k) if rows else [] for k in counts}
    for _ in range(max_steps if rows else 0):
        choices = ", ".join(
            f"struct({k} AS k, {_nearest('scaled', c)} AS i)" for k, c in centres.items()
        )
        means = ", ".join(f"avg(scaled[{j}])" for j in range(len(features)))
        found = (
            points.select("scaled", F.expr(f"inline(array({choices}))"))
            .groupBy("k", "i")
            .agg(F.expr(f"array({means})").alias("mean"))
            .collect()
        )
        moved = {k: list(c) for k, c in centres.items()}
        for r in found:
            moved[r.k][r.i - 1] = tuple(r["mean"])
        still = all(np.allclose(moved[k], centres[k], rtol=0, atol=TOLERANCE) for k in counts)
        centres = moved
        if still:
            break
    # Ids follow the centre's first feature, so reruns number alike.
    centres = {k: sorted(c) for k, c in centres.items()}
    points = points.withColumns(
        {f"cluster_{k}": F.expr(_nearest("scaled", c)) for k, c in centres.items()}
    )
    return Segmentation(points, scaler, centres, tuple(features))


def davies_bouldin(
    df: DataFrame,
    cluster: str,
    features: Sequence[str],
    clusters: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Index of a given assignment (Davies & Bouldin 1979), lower is better.

    Scatter is the mean Euclidean distance to the own centroid. Centroids are
    one row per cluster; no point ever meets another point. The index compares every two
    clusters: each centroid meets blocks of about BLOCK_CENTRES others and keeps its worst
    ratio, so no row or task holds all of them. `clusters` states their number where it is
    known; without it they are measured before they are broadcast. With `by`, one pass
    scores several assignments, one per value of the `by` columns.
    """
    known = df.filter(F.col(cluster).isNotNull())
    centre = F.array(*[F.avg(c) for c in features])
    keys = [*by, cluster]
    renamed = {k: f"_of_{k}" for k in keys}
    centroids = known.groupBy(*keys).agg(centre.alias("_centre")).withColumnsRenamed(renamed)
    point = F.array(*[F.col(c).cast("double") for c in features])
    scattered = (
        attach(known, centroids, list(renamed.items()), small=True if clusters else None)
        .groupBy(*keys, "_centre")
        .agg(F.avg(distance(point, F.col("_centre"))).alias("_scatter"))
    )
    scattered = materialize(scattered, "scatter")
    member = F.struct(F.col(cluster).alias("_cluster"), "_centre", "_scatter")
    blocks = materialize(_blocks(scattered, cluster, member, by), "scatter-blocks")
    others = F.filter("_members", lambda o: o["_cluster"] != F.col(cluster))
    worst = F.array_max(
        F.transform(
            others,
            lambda o: (F.col("_scatter") + o["_scatter"])
            / F.nullif(distance(F.col("_centre"), o["_centre"]), F.lit(0.0)),
        )
    )
    last = blocks.agg(F.coalesce(F.max("_b"), F.lit(0))).first()[0]
    met = scattered.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(last))))
    on = F.col("_b") == F.col("_of_b")
    for name in by:
        on &= F.col(name) == F.col(f"_by_{name}")
    renamed = blocks.withColumnsRenamed({"_b": "_of_b", **{name: f"_by_{name}" for name in by}})
    judged = (
        met.join(renamed, on)
        .groupBy(*by, cluster)
        .agg(F.max(worst).alias("_worst"))
    )
    known_all = F.count("_worst") == F.count(F.lit(1))
    return judged.groupBy(*by).agg(
        F.count(F.lit(1)).cast("int").alias("clusters"),
        F.when(known_all, F.avg("_worst")).alias("davies_bouldin_index"),
    )


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two equally long arrays."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def davies_bouldin_by_k(segments: Segmentation) -> DataFrame:
    """(model, k, index), one row per fitted k, all scored in one pass."""
    scores = F.col("scaled")
    choices = F.array(
        *[
            F.struct(F.lit(k).alias("k"), F.col(f"cluster_{k}").alias("cluster"))
            for k in segments.centres
        ]
    )
    tall = segments.points.select(
        F.inline(choices), *[scores[i].alias(c) for i, c in enumerate(segments.features)]
    )
    index = davies_bouldin(
        tall, "cluster", segments.features, clusters=sum(segments.centres), by=["k"]
    )
    return index.select(
        F.concat(F.lit("k="), F.col("k")).alias("model"), "k", "davies_bouldin_index"
    ).orderBy("k")


def k_comparison(indices: DataFrame) -> DataFrame:
    """Rank of every k and its gain over the next smaller k (one row per k)."""
    every = Window.partitionBy()
    index = F.col("davies_bouldin_index")
    return indices.select(
        "model",
        "k",
        index,
        F.rank().over(every.orderBy(index)).alias("index_rank"),
        (F.lag(index).over(every.orderBy("k")) - index).alias("gain"),
    )


def centroid_table(segments: Segmentation, k: int) -> DataFrame:
    """Feature x cluster in original units, rounded to one decimal.

    There are k x features numbers; scaling is undone on those.
    """
    centres, scale = segments.centres[k], segments.scaler.stages[-1]
    rows = [
        (feature, *[float(c[i] * scale.std[i] + scale.mean[i]) for c in centres])
        for i, feature in enumerate(segments.features)
    ]
    names = [f"cluster_{n}" for n in range(1, k + 1)]
    schema = ", ".join(["feature string", *[f"{n} double" for n in names]])
    return (
        segments.points.sparkSession.createDataFrame(rows, schema)
        .select("feature", *[F.round(n, 1).alias(n) for n in names])
        .orderBy("feature")
    )


def assign_clusters(segments: Segmentation, k: int) -> DataFrame:
    """Every group of trips with its cluster, ordered by cluster.

    The group's own keys come second in the order, so that one large cluster
    does not end up in one sorting task.
    """
    clusters = {f"cluster_{n}" for n in segments.centres} | {"scaled"}
    rest = [c for c in segments.points.columns if c not in clusters]
    return segments.points.select(F.col(f"cluster_{k}").alias("cluster"), *rest).orderBy(
        "cluster", *rest
    )
