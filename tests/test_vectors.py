import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nearkin.functions import vectors

QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def value(spark, sql):
    return spark.sql(f"SELECT {sql} AS v").first()["v"]


def frame(spark, points):
    names = [f"x{i}" for i in range(len(points[0]))]
    schema = "id int, " + ", ".join(f"{n} double" for n in names)
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], schema)
    return df, names


def book(p, seed, center, eps=1e-6):
    """The measure with numpy, as a check."""
    divisor = np.where(np.abs(center) > eps, center, eps)
    c, d = np.asarray(seed) / divisor - 1, np.asarray(p) / divisor - 1
    cn, dn = np.linalg.norm(c), np.linalg.norm(d)
    if cn < eps or dn < eps:
        return abs(cn - dn)
    return math.hypot(c @ d / cn / dn, cn - dn)


def test_euclidean(spark):
    assert value(spark, vectors.squared_distance([0.0, 3.0], [4.0, 0.0])) == 25.0
    assert value(spark, vectors.euclidean([0.0, 3.0], [4.0, 0.0])) == 5.0
    assert value(spark, vectors.euclidean([1e-300], [-1e-7])) == pytest.approx(1e-7)


def test_z_scores_with_no_spread(spark):
    df = spark.createDataFrame([(5.0,)], "a double")
    (z,) = vectors.z_scores([F.col("a")], [2.0], [0.0])
    assert df.select(z).first()[0] == 3.0
    (z,) = vectors.z_scores([F.col("a")], [2.0], [2.0])
    assert df.select(z).first()[0] == 1.5


def test_relative_deviation(spark):
    sql = vectors.relative_deviation([3.0, 2.0, -1.0], [2.0, 1e-7, -1e-9])
    got = [value(spark, s) for s in sql]
    assert got == pytest.approx([0.5, 2e6 - 1, -1e6 - 1])


CENTERS = [[0.5, -0.2, 1.0], [1e-8, 0.3, -2.0], [-1e-7, 0.0, 0.1]]


@pytest.mark.parametrize("center", CENTERS)
@pytest.mark.parametrize("as_columns", [False, True])
def test_book_distance(spark, center, as_columns):
    rnd = random.Random(3)
    seed = [0.4, 0.1, 0.9]
    points = [[rnd.gauss(0, 1) for _ in range(3)] for _ in range(30)] + [seed, center]
    df, names = frame(spark, points)
    if as_columns:
        extra = {f"s{i}": F.lit(v) for i, v in enumerate(seed)}
        extra |= {f"m{i}": F.lit(v) for i, v in enumerate(center)}
        df = df.withColumns(extra)
        scored = vectors.with_distance(df, names, ["s0", "s1", "s2"], ["m0", "m1", "m2"], "book")
    else:
        scored = vectors.with_distance(df, names, seed, center, "book")
    assert scored.columns == [*df.columns, "distance"]
    got = {r["id"]: r["distance"] for r in scored.collect()}
    for i, p in enumerate(points):
        assert got[i] == pytest.approx(book(p, seed, np.array(center)), rel=1e-9)


def test_book_distance_of_the_seed_and_of_the_center(spark):
    center = [0.5, -0.25]
    df, names = frame(spark, [[1.0, 1.0], center])
    scored = vectors.with_distance(df, names, [1.0, 1.0], center, "book").orderBy("id").collect()
    assert scored[0]["distance"] == pytest.approx(1.0)
    assert scored[1]["distance"] == pytest.approx(math.hypot(1.0, 5.0))


def test_unknown_metric(spark):
    df, names = frame(spark, [[1.0]])
    with pytest.raises(ValueError, match="cosine"):
        vectors.with_distance(df, names, [1.0], [1.0], "cosine")


def test_ties_go_to_the_lowest_center(spark):
    df, names = frame(spark, [[0.0, 0.0], [4.0, 0.0]])
    centers = [[2.0, 0.0], [-2.0, 0.0], [4.0, 0.0]]
    near = vectors.nearest_center(names, centers)
    assert [tuple(r[0]) for r in df.select(near).orderBy("id").collect()] == [(4.0, 0), (0.0, 2)]
    with pytest.raises(ValueError):
        vectors.nearest_center(names, [])


COORDINATE = st.integers(-3, 3).map(float)


@QUICK
@given(st.data(), st.integers(1, 3), st.integers(1, 6))
def test_nearest_is_the_first_smallest(spark, data, d, k):
    vector = st.lists(COORDINATE, min_size=d, max_size=d)
    points = data.draw(st.lists(vector, min_size=1, max_size=20))
    centers = data.draw(st.lists(vector, min_size=k, max_size=k))
    df, names = frame(spark, points)
    rows = df.select("id", vectors.nearest_center(names, centers).alias("n")).collect()
    for r in rows:
        costs = [sum((a - b) ** 2 for a, b in zip(points[r["id"]], c, strict=True)) for c in centers]
        assert (r["n"]["cost"], r["n"]["cluster"]) == (min(costs), costs.index(min(costs)))


def test_wide_points_take_the_fold_with_the_same_result(spark):
    rnd = np.random.default_rng(1)
    points, centers = rnd.normal(size=(300, 40)), rnd.normal(size=(12, 40))
    centers[7] = centers[2]
    assert centers.size > vectors.MAX_INLINE_TERMS
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, v array<double>")
    near = vectors.nearest_center("v", centers.tolist())
    got = {r["id"]: r["n"] for r in df.repartition(3).select("id", near.alias("n")).collect()}
    costs = ((points[:, None, :] - centers[None]) ** 2).sum(axis=2)
    assert [got[i]["cluster"] for i in range(300)] == costs.argmin(axis=1).tolist()
    assert [got[i]["cost"] for i in range(300)] == pytest.approx(costs.min(axis=1).tolist())
    assert 7 not in {r["cluster"] for r in got.values()}
    narrow = vectors.nearest_center("v", centers[:5].tolist())
    both = df.select("id", narrow.alias("n")).collect()
    assert [r["n"]["cluster"] for r in both] == costs[:, :5].argmin(axis=1).tolist()


@pytest.mark.parametrize("k", [2, 40])
def test_vectors_without_a_nearest_center(spark, k):
    d = 8
    whole = [0.0] * d
    vectors_in = [
        whole, None, [], whole[:-1], [*whole, 0.0], [math.nan, *whole[1:]], [None, *whole[1:]],
        [math.inf, *whole[1:]], [5.0] * d,
    ]
    centers = [[5.0 - i % 2 * 5.0] * d for i in range(k)]
    assert (k * d > vectors.MAX_INLINE_TERMS) == (k == 40)
    df = spark.createDataFrame(list(enumerate(vectors_in)), "i int, v array<double>").coalesce(1)
    rows = df.select("i", vectors.nearest_center("v", centers).alias("n")).orderBy("i").collect()
    got = [None if r["n"] is None else (r["n"]["cost"], r["n"]["cluster"]) for r in rows]
    assert got == [(0.0, 1), None, None, None, None, None, None, (math.inf, 0), (0.0, 0)]


def test_helper_names_do_not_meet_columns(spark):
    df, names = frame(spark, [[1.0, 2.0]])
    clash = df.withColumns({"_md0": F.lit("x"), "_m_cn": F.lit("y")})
    row = vectors.with_distance(clash, names, [1.0, 1.0], [0.5, 0.5], "book").first()
    assert (row["_md0"], row["_m_cn"]) == ("x", "y") and row["distance"] > 0
