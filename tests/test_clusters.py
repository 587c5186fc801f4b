import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearkin.operators import clusters, features
from nearkin.schema import SONG_FEATURES, SONG_SCHEMA

NAMES = SONG_SCHEMA.fieldNames()


@pytest.fixture(scope="module")
def matrix(song_rows):
    return np.array([[r[NAMES.index(f)] for f in SONG_FEATURES] for r in song_rows])


@pytest.fixture(scope="module")
def z(matrix):
    return (matrix - matrix.mean(axis=0)) / matrix.std(axis=0)


def lloyd(points, centers, steps):
    centers = np.array(centers)
    for _ in range(steps):
        near = ((points[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        for i in set(near):
            centers[i] = points[near == i].mean(axis=0)
    return centers


def test_feature_stats(songs, matrix):
    rows = features.feature_stats(songs, SONG_FEATURES).orderBy("pos").collect()
    assert [r["feature"] for r in rows] == SONG_FEATURES
    assert [r["mean"] for r in rows] == pytest.approx(matrix.mean(axis=0))
    assert [r["std"] for r in rows] == pytest.approx(matrix.std(axis=0))
    assert [r["total"] for r in rows] == pytest.approx(matrix.sum(axis=0))
    assert [r["total_squares"] for r in rows] == pytest.approx((matrix**2).sum(axis=0))
    assert {r["n"] for r in rows} == {len(matrix)}


def test_no_items_is_an_error(songs):
    with pytest.raises(ValueError, match="no valid items"):
        features.fit_stats(songs.filter("year = 1"), SONG_FEATURES)


def test_invalid_items_go(spark):
    rows = [(1, 1.0, "2"), (2, math.nan, "2"), (3, None, "2"), (4, -math.inf, "2"), (5, 1.0, "x"), (6, 0.0, "-1e2")]
    df = spark.createDataFrame(rows, "id int, a double, b string")
    assert [r["id"] for r in features.valid_items(df, ["a", "b"]).collect()] == [1, 6]


def test_standardize(songs, z):
    stats = features.fit_stats(songs, SONG_FEATURES)
    names = [f + "_z" for f in SONG_FEATURES]
    rows = features.standardize(songs, stats).orderBy("song_id").select(names).collect()
    assert np.allclose(np.array([tuple(r) for r in rows]), z)


def test_lloyd_is_the_plain_algorithm(songs, z):
    model = clusters.start_model(songs, SONG_FEATURES, ["song_id"], 5, steps=3)
    assert np.allclose(np.array(model.centers), lloyd(z, z[:5], 3))


def test_an_empty_cluster_keeps_its_center(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "x double")
    assert clusters.lloyd(df, ["x"], [[0.0], [12.0], [99.0]], steps=5) == ((0.5,), (10.0,), (99.0,))


def test_the_cost_falls_with_every_step(songs):
    stats = features.fit_stats(songs, SONG_FEATURES)
    placed, names = features.with_point(songs, stats), features.z_names(stats)
    costs = []
    for steps in range(4):
        model = clusters.start_model(songs, SONG_FEATURES, ["song_id"], 4, steps=steps)
        costs.append(clusters.total_cost(placed, names, model.centers).first()["wssse"])
    assert costs == sorted(costs, reverse=True)


def test_kmeans(songs, z):
    assigned, model = clusters.cluster_items(songs, SONG_FEATURES, k=3)
    centers = np.array(model.centers)
    assert centers.shape == (3, 4) and model.k == 3 and model.n_items == len(z)
    costs = ((z[:, None] - centers[None]) ** 2).sum(axis=2)
    assert model.wssse == pytest.approx(costs.min(axis=1).sum())
    got = [r["cluster"] for r in assigned.orderBy("song_id").collect()]
    assert got == costs.argmin(axis=1).tolist()
    sizes = {r["cluster"]: r["n_items"] for r in clusters.cluster_sizes(assigned).collect()}
    assert sum(sizes.values()) == len(z)
    report = clusters.cluster_report(assigned, model).orderBy("cluster").collect()
    assert [r["n_items"] for r in report] == [sizes[i] for i in range(3)]
    assert np.allclose([r["center"] for r in report], centers, atol=6e-4)
    assert assigned.columns == [*songs.columns, "cluster"]


def test_fewer_distinct_points_than_centers(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (3.0, 2.0)], "a double, b double")
    assigned, model = clusters.cluster_items(df, ["a", "b"], k=5)
    assert model.k == 5 and len(model.centers) <= 2 and model.wssse == 0.0
    assert assigned.count() == 3


def test_assignment_needs_no_shuffle(songs):
    model = clusters.start_model(songs, SONG_FEATURES, ["song_id"], 4)
    stored = songs.sparkSession.range(8).selectExpr(*[f"double(id) AS {f}" for f in SONG_FEATURES])
    plan = clusters.assign_items(stored, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_a_model_of_many_numbers(spark):
    rnd = np.random.default_rng(2)
    centers = rnd.normal(size=(1200, 1000))
    df = spark.createDataFrame([(i, centers[i].tolist()) for i in (0, 7, 1199)], "i int, v array<double>")
    got = clusters.assign_nearest(df, "v", centers.tolist()).collect()
    assert {r["i"]: r["cluster"] for r in got} == {0: 0, 7: 7, 1199: 1199}


def test_names_that_need_quotes(spark):
    df = spark.createDataFrame([(0.0, 1.0), (4.0, 1.0)], ["my col", "a`b"])
    got = clusters.assign_nearest(df, ["my col", "a`b"], [[4.0, 1.0], [0.0, 0.0]]).collect()
    assert [r["cluster"] for r in got] == [1, 0]
    assert clusters.total_cost(df, ["my col", "a`b"], [[4.0, 1.0], [0.0, 0.0]]).first()["wssse"] == 1.0
    assert clusters.lloyd(df, ["my col", "a`b"], [[0.0, 0.0]], 2) == ((2.0, 1.0),)


def test_a_hot_cluster(spark):
    """Two thirds of the rows are copies of one point."""
    rows = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 < 2, 1.0).otherwise(F.col("id") / 1000).alias("x")
    )
    ((low,), (high,)) = clusters.lloyd(rows, ["x"], [[0.0], [29.0]], steps=1)
    values = [1.0 if i % 3 < 2 else i / 1000 for i in range(30_000)]
    near = [v for v in values if abs(v) <= abs(v - 29.0)]
    assert low == pytest.approx(np.mean(near))
    assert high == pytest.approx(np.mean([v for v in values if abs(v) > abs(v - 29.0)]))


def test_invalid_vectors_go(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [1.0, math.nan]), (5, [None, 1.0]), (6, [0.0, -math.inf])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    assert [r["id"] for r in features.valid_vectors(df, "v", 2).collect()] == [1]
