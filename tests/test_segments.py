"""K-means properties and the index against a direct computation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hailmeter.plans import segments

FEATURES = ("trip_count", "a", "b")


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(7)
    rows = []
    for c in range(4):
        for i in range(15):
            x, y, z = rng.normal(0, 0.3, 3) + np.array([10.0 * c, 5.0 * (c % 2), -8.0 * c])
            rows.append((f"g{c}-{i}", c, float(x), float(y), float(z)))
    return spark.createDataFrame(rows, "key string, truth int, trip_count double, a double, b double")


def _direct(points, labels):
    ids = sorted(set(labels))
    centres = {i: points[labels == i].mean(axis=0) for i in ids}
    scatter = {i: np.linalg.norm(points[labels == i] - centres[i], axis=1).mean() for i in ids}
    return np.mean(
        [
            max(
                (scatter[i] + scatter[j]) / np.linalg.norm(centres[i] - centres[j])
                for j in ids
                if j != i
            )
            for i in ids
        ]
    )


@pytest.mark.parametrize("clusters", [None, 4])
def test_index_equals_direct_computation(blobs, clusters):
    got = segments.davies_bouldin(blobs, "truth", FEATURES, clusters).first()
    frame = blobs.toPandas()
    expected = _direct(frame[list(FEATURES)].to_numpy(), frame["truth"].to_numpy())
    assert got.clusters == 4
    assert got.davies_bouldin_index == pytest.approx(expected, rel=1e-12)


def test_scores_have_zero_mean_and_unit_deviation(blobs):
    scores = segments.standardize_features(blobs, FEATURES)
    row = scores.agg(
        *[F.avg(c).alias(f"m_{c}") for c in FEATURES], *[F.stddev(c).alias(c) for c in FEATURES]
    ).first()
    for c in FEATURES:
        assert row[f"m_{c}"] == pytest.approx(0, abs=1e-12)
        assert row[c] == pytest.approx(1)


def test_segments_find_the_blobs(blobs):
    fitted = segments.fit_segments(blobs, (3, 4), FEATURES)
    assigned = segments.assign_clusters(fitted, 4)
    assert assigned.count() == blobs.count()
    pairs = assigned.select("truth", "cluster").distinct().collect()
    assert len(pairs) == 4 and sorted(p.cluster for p in pairs) == [1, 2, 3, 4]
    means = assigned.groupBy("cluster").agg(F.avg("trip_count").alias("m")).orderBy("cluster")
    ordered = [r.m for r in means.collect()]
    assert ordered == sorted(ordered)

    indices = segments.davies_bouldin_by_k(fitted)
    compared = {r.k: r for r in segments.k_comparison(indices).collect()}
    assert compared[4].index_rank == 1
    assert compared[4].gain == pytest.approx(
        compared[3].davies_bouldin_index - compared[4].davies_bouldin_index
    )

    table = {r.feature: r for r in segments.centroid_table(fitted, 4).collect()}
    assert [table["trip_count"][f"cluster_{i}"] for i in range(1, 5)] == [
        pytest.approx(m, abs=0.051) for m in ordered
    ]


def test_partitioning_does_not_change_the_model(blobs):
    def clusters(frame):
        fitted = segments.fit_segments(frame, (3,), FEATURES)
        return {(r.key, r.cluster) for r in segments.assign_clusters(fitted, 3).collect()}

    assert clusters(blobs.coalesce(1)) == clusters(blobs.repartition(7))


def test_unknown_features_are_imputed(spark, blobs):
    holed = blobs.withColumn("a", F.when(F.col("key") != "g0-0", F.col("a")))
    fitted = segments.fit_segments(holed, (4,), FEATURES)
    assert segments.assign_clusters(fitted, 4).count() == blobs.count()


def test_index_in_blocks_equals_the_index_at_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i % 40, *map(float, rng.normal(size=3))) for i in range(400)]
    df = spark.createDataFrame(rows, "c int, x double, y double, z double")
    names = ("x", "y", "z")
    whole = segments.davies_bouldin(df, "c", names).first()
    monkeypatch.setattr(segments, "BLOCK_CENTRES", 3)
    blocked = segments.davies_bouldin(df, "c", names).first()
    points = np.array([r[1:] for r in rows])
    want = _direct(points, np.array([r[0] for r in rows]))
    assert whole.clusters == blocked.clusters == 40
    assert whole.davies_bouldin_index == pytest.approx(want, rel=1e-12)
    assert blocked.davies_bouldin_index == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("block", [3, 1000])
def test_rows_get_the_nearest_centre(spark, monkeypatch, block):
    monkeypatch.setattr(segments, "BLOCK_CENTRES", block)
    rng = np.random.default_rng(4)
    points = [(i, *map(float, rng.normal(size=2))) for i in range(120)] + [(7, 0.5, 0.5)] * 2
    centres = [(i, *map(float, rng.normal(size=2))) for i in range(11)]
    centres += [(100, *centres[2][1:]), (None, 0.0, 0.0)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    near = segments.assign_to_centres(
        df, spark.createDataFrame(centres, "c int, x double, y double"), "c", ("x", "y"), "near"
    )
    own = np.array([c[1:] for c in centres[:11]])
    want = sorted(
        (i, int(np.argmin(np.linalg.norm(own - np.array([x, y]), axis=1)))) for i, x, y in points
    )
    assert sorted((r.id, r.near) for r in near.collect()) == want


def test_a_step_is_the_mean_of_each_cluster(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 9.0)], "c string, x double")
    rows = sorted(tuple(r) for r in segments.lloyd_step(df, "c", ("x",)).collect())
    assert rows == [("a", 2, 2.0), ("b", 1, 5.0)]
    pivot = segments.centroid_pivot(df, "c", ("x",), ("a", "b", "none")).first()
    assert tuple(pivot) == ("x", 2.0, 5.0, None)


def test_training_ends_where_a_step_moves_nothing(blobs):
    fitted = segments.fit_segments(blobs, (4,), FEATURES)
    scaled = fitted.points.select(
        "cluster_4", *[F.col("scaled")[i].alias(c) for i, c in enumerate(FEATURES)]
    )
    for r in segments.lloyd_step(scaled, "cluster_4", FEATURES).collect():
        assert [r[c] for c in FEATURES] == pytest.approx(fitted.centres[4][r.cluster_4 - 1])


def test_nothing_to_fit(blobs):
    fitted = segments.fit_segments(blobs.withColumn("a", F.col("a")).filter("truth = 0").limit(2), (3,), FEATURES)
    assert segments.assign_clusters(fitted, 3).count() == 2
