"""The pruned join of seeds and rows: the rows of the plain one, from fewer pairs."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from nearkin.functions import vectors
from nearkin.operators import recommend

CENTER = [0.5, -0.25, 1.0]
POINT, START = ["x", "y", "z"], ["a", "b", "c"]


def points(n, seed=3):
    random.seed(seed)
    return [(i % 2, i, f"n{i % 5}", *[random.gauss(m, 1.0) for m in CENTER]) for i in range(n)]


def tables(spark, rows, metric):
    """Rows with their bound, and all of them as seeds (the first of every id)."""
    df = spark.createDataFrame(rows, "g int, id long, name string, x double, y double, z double")
    own = df.withColumn("_bound", F.expr(vectors.center_bound(POINT, CENTER, metric)))
    chosen = df.filter("id IS NOT NULL").dropDuplicates(["id"]).selectExpr("g", "id AS seed_id", "x AS a", "y AS b", "z AS c")
    return own.repartition(3), chosen.withColumn("_seed_bound", F.expr(vectors.center_bound(START, CENTER, metric)))


def both(spark, rows, metric, n):
    """The two joins' rows, and how many pairs the pruned one measured."""
    own, chosen = tables(spark, rows, metric)
    seen = []

    def measured(pairs):
        seen.append(Observation())
        return vectors.with_distance(pairs.observe(seen[-1], F.count(F.lit(1)).alias("n")), POINT, START, CENTER, metric)

    def plain(pairs):
        return vectors.with_distance(pairs, POINT, START, CENTER, metric)

    bounds = [("_bound", "_seed_bound")]
    if metric == "euclidean":
        bounds += list(zip(POINT, START, strict=True))
    ties = ["name", *POINT]
    pruned = recommend.nearest_by_bound(own, chosen, "g", measured, "id", POINT, bounds, n, ties)
    every = recommend.nearest_in_group(own, chosen, "g", plain, "id", n, ties)
    columns = ["seed_id", "rank", "id", "name", "distance"]
    got, expected = (sorted(map(tuple, df.select(*columns).collect()), key=str) for df in (pruned, every))
    return got, expected, sum(o.get["n"] for o in seen)


@pytest.mark.parametrize("metric", ["euclidean", "book"])
@pytest.mark.parametrize("n", [1, 7, 120])
def test_same_rows_as_all_pairs(spark, metric, n):
    got, expected, _ = both(spark, points(300), metric, n)
    assert got == expected and got


@pytest.mark.parametrize("metric", ["euclidean", "book"])
def test_copies_ties_and_odd_ids(spark, metric):
    """A third of the rows are one point, some share an id, some have none; coarse points make ties."""
    rows = [(g, i, name, *[round(v) / 2 for v in p]) for g, i, name, *p in points(240)]
    rows = [(g, i, name, *((1.0, 1.0, 1.0) if i % 3 == 0 else p)) for g, i, name, *p in rows]
    rows = [(g, None if i % 11 == 5 else 6 if i % 7 == 1 else i, name, *p) for g, i, name, *p in rows]
    rows += [(5, 9000, "alone", 1.0, 2.0, 3.0), (0, 9001, "far", 1e9, -1e9, 1e9), (0, 9002, "huge", 1e200, 1.0, 1.0)]
    got, expected, _ = both(spark, rows, metric, 4)
    assert got == expected


@pytest.mark.parametrize("metric", ["euclidean", "book"])
def test_pairs_grow_slower_than_the_square(spark, metric):
    """Eight times the rows of a group; the square would be 64 times the pairs."""
    few, many = points(400), points(3200)
    (*_, before), (got, expected, after) = both(spark, few, metric, 3), both(spark, many, metric, 3)
    assert got == expected
    assert after < 24 * before
    assert after < 0.25 * sum(len([r for r in many if r[0] == g]) ** 2 for g in (0, 1))


def test_pairs_of_a_seed_in_a_large_group(spark):
    """Of 12,000 rows in one group a seed is measured against a hundred at most."""
    own, chosen = tables(spark, [(0, *row[1:]) for row in points(12_000)], "euclidean")
    seen = []

    def measured(pairs):
        seen.append(Observation())
        return vectors.with_distance(pairs.observe(seen[-1], F.count(F.lit(1)).alias("n")), POINT, START, CENTER)

    bounds = [("_bound", "_seed_bound"), *zip(POINT, START, strict=True)]
    best = recommend.nearest_by_bound(own, chosen, "g", measured, "id", POINT, bounds, 3, ["name"])
    assert best.count() == 36_000
    assert sum(o.get["n"] for o in seen) < 100 * 12_000


def test_a_batch_keeps_the_first_of_every_seed(spark):
    rows = [(s, float(d), 10 * d + s) for d in (3, 1, 2, 1) for s in (1, 2)]
    found = spark.createDataFrame(rows, "seed_id long, distance double, _nth long").coalesce(1)
    got = sorted(map(tuple, recommend._first_in_batches(found, 2).collect()))
    assert got == [(s, 1.0, 10 + s) for s in (1, 1, 2, 2)]
    assert recommend._first_in_batches(found.filter("seed_id > 2"), 2).count() == 0


def test_many_copies_make_few_pairs(spark):
    """All rows of a group are one point: the pairs are a multiple of the rows."""
    rows = [(0, i, "n", 1.0, 2.0, 3.0) for i in range(600)]
    got, expected, pairs = both(spark, rows, "euclidean", 3)
    assert got == expected and len(got) == 1800
    assert pairs <= 600 * 4


def test_a_row_without_id_is_no_seed(spark):
    """As the lookup by id finds none of them; among the results they stay."""
    from nearkin.operators import clusters, seeds
    from nearkin.operators.features import FeatureStats
    from nearkin.schema import ItemColumns

    columns = ItemColumns(id="id", name="name", cluster="g", maker_id="m", maker_name="k", year="yy", extra=())
    rows = spark.createDataFrame([(0, None, "a", 1.0), (0, None, "b", 2.0), (0, 3, "c", 4.0)], "g int, id long, name string, x double")
    model = clusters.ClusterModel(FeatureStats(("x",), (0.0,), (1.0,), 3), ((0.0,),), 1)
    assert seeds.find_by_id(rows, None, columns).count() == 0
    best = recommend.recommend_batch(rows, model, rows, 5, "euclidean", columns).orderBy("seed_id", "rank").collect()
    assert [(r["seed_id"], r["id"], r["name"], r["distance"]) for r in best] == [(3, None, "b", 2.0), (3, None, "a", 3.0)]
    only = recommend.recommend_batch(rows, model, rows.filter("id IS NULL"), 5, "euclidean", columns)
    assert only.count() == 0


@pytest.mark.parametrize("metric", ["euclidean", "book"])
def test_the_bound_is_below_the_distance(spark, metric):
    own, chosen = tables(spark, points(120), metric)
    pairs = vectors.with_distance(own.crossJoin(chosen.drop("g")), POINT, START, CENTER, metric)
    gap = F.abs(F.col("_bound") - F.col("_seed_bound")) - F.col("distance")
    assert pairs.agg(F.max(gap).alias("most")).first()["most"] < 1e-9


def test_an_unknown_measure():
    with pytest.raises(ValueError):
        vectors.center_bound(POINT, CENTER, "cosine")
