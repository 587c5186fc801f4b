import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearkin.operators import clusters, recommend, seeds
from nearkin.schema import SONG_FEATURES, SONG_SCHEMA, ItemColumns
from tests.test_vectors import book

NAMES = SONG_SCHEMA.fieldNames()


@pytest.fixture(scope="module")
def model(songs):
    return clusters.start_model(songs, SONG_FEATURES, ["song_id"], 3, steps=2)


@pytest.fixture(scope="module")
def assigned(songs, model):
    return clusters.assign_items(songs, model).persist()


def brute(song_rows, model, seed_id, n, metric):
    """The ranking over plain rows, as a check."""
    ids = [r[NAMES.index("song_id")] for r in song_rows]
    matrix = np.array([[r[NAMES.index(f)] for f in SONG_FEATURES] for r in song_rows])
    z = (matrix - np.array(model.stats.mean)) / np.array(model.stats.std)
    centers = np.array(model.centers)
    cluster = ((z[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    s = ids.index(seed_id)
    scored = []
    for i, one in enumerate(ids):
        if cluster[i] == cluster[s] and one != seed_id:
            d = np.linalg.norm(z[i] - z[s]) if metric == "euclidean" else book(z[i], z[s], centers[cluster[s]])
            scored.append((d, one))
    return [(one, round(d, 6)) for d, one in sorted(scored)[:n]], len(scored)


@pytest.mark.parametrize("metric", ["euclidean", "book"])
@pytest.mark.parametrize("n", [1, 10, 1000])
def test_recommend(song_rows, assigned, model, metric, n):
    seed = recommend.seed_row(seeds.find_by_id(assigned, "S00007"), model)
    rows = recommend.recommend(assigned, model, seed, n, metric).orderBy("rank").collect()
    expected, _ = brute(song_rows, model, "S00007", n, metric)
    assert [r["song_id"] for r in rows] == [one for one, _ in expected]
    assert [r["distance"] for r in rows] == pytest.approx([d for _, d in expected], abs=2e-6)
    assert [r["rank"] for r in rows] == list(range(1, len(expected) + 1))


def test_display_columns(songs, assigned, model):
    seed = recommend.seed_row(seeds.find_by_id(assigned, "S00007"), model)
    row = recommend.recommend(assigned, model, seed, 1).first()
    source = songs.filter(F.col("song_id") == row["song_id"]).first()
    assert set(row.asDict()) == {
        "rank", "song_id", "song_name", "artist_name", "artist_id", "year", "tempo", "loudness", "distance",
    }
    assert row["tempo"] == pytest.approx(source["tempo"], abs=0.0051)
    assert row["loudness"] == pytest.approx(source["loudness"], abs=0.0051)


def test_all_rows_with_the_seed_id_are_left_out(assigned, model):
    twice = assigned.unionByName(assigned.filter("song_id = 'S00007'").withColumn("tempo", F.lit(71.0)))
    seed = recommend.seed_row(seeds.find_by_id(assigned, "S00007"), model)
    ids = [r["song_id"] for r in recommend.recommend(twice, model, seed, 10_000).collect()]
    assert "S00007" not in ids
    same_name = assigned.withColumn("song_name", F.lit("one name"))
    assert recommend.recommend(same_name, model, seed, 5).count() == 5


def test_candidate_counts(song_rows, assigned, model):
    seed = recommend.seed_row(seeds.find_by_id(assigned, "S00010"), model)
    broken = assigned.withColumn("tempo", F.when(F.col("song_id") == "S00013", math.nan).otherwise(F.col("tempo")))
    row = recommend.candidate_counts(broken, seed, model).first()
    _, n = brute(song_rows, model, "S00010", 1, "euclidean")
    assert tuple(row) == (n - 1, len(song_rows))
    assert recommend.candidates(broken, seed, model).count() == n - 1


@pytest.mark.parametrize("metric", ["euclidean", "book"])
@pytest.mark.parametrize("n", [6, 2000])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_a_batch_gives_what_each_seed_gives(spark, song_rows, assigned, model, metric, n, broadcast):
    wanted = ["S00001", "S00002", "S00007", "S00100", "S00399"]
    chosen = assigned.filter(F.col("song_id").isin(wanted))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        best = recommend.recommend_batch(assigned, model, chosen, n, metric)
        got = {}
        for r in best.orderBy("seed_id", "rank").collect():
            got.setdefault(r["seed_id"], []).append((r["song_id"], r["distance"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(got) == wanted
    for one in wanted:
        expected, _ = brute(song_rows, model, one, n, metric)
        assert [i for i, _ in got[one]] == [i for i, _ in expected]
        assert [d for _, d in got[one]] == pytest.approx([d for _, d in expected], abs=2e-6)


def test_every_item_as_seed(assigned, model):
    best = recommend.recommend_batch(assigned, model, assigned, 3)
    assert best.groupBy("seed_id").count().filter("count <> 3").count() == 0
    assert best.select("seed_id").distinct().count() == assigned.count()


def test_pairs_without_a_distance_do_not_count(spark):
    rows = spark.createDataFrame(
        [("g", i, x) for i, x in enumerate([1.0, 2.0, None, math.nan, math.inf, 1.0])] + [("g", None, 1.5)],
        "g string, id int, x double",
    )
    chosen = spark.createDataFrame([("g", 0, 1.0), ("g", 9, 2.0)], "g string, seed_id int, at double")

    def distance(pairs):
        return pairs.withColumn("distance", F.abs(F.col("x") - F.col("at")))

    best = recommend.nearest_in_group(rows, chosen, "g", distance, "id", 10).orderBy("seed_id", "rank")
    got = [(r["seed_id"], r["id"], r["distance"]) for r in best.collect()]
    assert got == [
        (0, 5, 0.0), (0, None, 0.5), (0, 1, 1.0), (0, 4, math.inf),
        (9, 1, 0.0), (9, None, 0.5), (9, 0, 1.0), (9, 5, 1.0), (9, 4, math.inf),
    ]


def test_renamed_columns_and_repeated_ids(assigned, model):
    columns = ItemColumns(cluster="grp", id="the id", name="the name")
    renamed = assigned.withColumnsRenamed({"cluster": "grp", "song_id": "the id", "song_name": "the name"})
    other = renamed.filter(F.col("the id") == "S00007").withColumn("the name", F.lit("0 first"))
    rows = renamed.unionByName(other.withColumn("loudness", F.lit(-1.0)).withColumn("grp", F.lit(1)))
    rows = rows.unionByName(renamed.limit(1).withColumn("the id", F.lit(None).cast("string")))
    seed = recommend.seed_row(seeds.find_by_id(rows, "S00007", columns), model, columns)
    assert seed["the name"] == "0 first" and seed["grp"] == 1
    single = recommend.recommend(rows, model, seed, 5, "book", columns).orderBy("rank").collect()
    found = rows.filter(F.col("the id") == "S00007")
    batch = recommend.recommend_batch(rows, model, found, 5, "book", columns).orderBy("rank").collect()
    assert [(r["the id"], r["distance"]) for r in single] == [(r["the id"], r["distance"]) for r in batch]
    counts = recommend.candidate_counts(rows, seed, model, columns).first()
    assert counts["n_candidates"] == recommend.candidates(rows, seed, model, columns).count()
    document = recommend.recommend_document(rows, model, seed, 2, "book", columns)
    assert document.first()["cluster"] == 1


def test_document(assigned, model):
    seed = recommend.seed_row(seeds.find_by_title(assigned, "tune_1"), model)
    document = recommend.recommend_document(assigned, model, seed, 4, "euclidean")
    body = json.loads(document.toJSON().first())
    assert list(body) == ["name", "artist", "song_id", "year", "cluster", "metric", "date", "similar"]
    assert body["song_id"] == "S00010" and body["name"] == "Tune_10%" and body["metric"] == "euclidean"
    assert len(body["similar"]) == 4
    distances = [entry["distance"] for entry in body["similar"]]
    assert distances == sorted(distances)
    assert list(body["similar"][0]) == [
        "song_id", "song_name", "artist_name", "artist_id", "year", "tempo", "loudness", "distance",
    ]


def test_find_seed(assigned):
    def found(**how):
        return [r["song_id"] for r in seeds.find_seed(assigned, **how).collect()]

    assert found(item_id="S00003", title="Tune", random_seed=1) == ["S00003"]
    assert found(item_id="", title="TUNE_2", random_seed=1) == ["S00002"]
    assert found(title="", random_seed=1) == found(random_seed=1)
    assert len({found(random_seed=i)[0] for i in range(8)}) > 1
    assert found(item_id="none") == [] and found(title="no such") == []
    with pytest.raises(ValueError):
        found(item_id="", title="")


def test_a_seed_that_is_not_there(assigned, model):
    with pytest.raises(LookupError):
        recommend.seed_row(seeds.find_by_id(assigned, "none"), model)
    broken = assigned.withColumn("tempo", F.lit(math.nan))
    with pytest.raises(LookupError):
        recommend.seed_row(seeds.find_by_id(broken, "S00003"), model)


def test_a_stored_table_is_read_in_one_cluster_only(spark, assigned, model, tmp_path):
    from nearkin.sources import items

    path = str(tmp_path / "clustered")
    items.write_clustered(assigned, path)
    stored = items.read_clustered(spark, path)
    seed = recommend.seed_row(seeds.find_by_id(stored, "S00007"), model)
    best = recommend.recommend(stored, model, seed, 5)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert f"(cluster#" in plan and f" = {seed['cluster']})" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "TakeOrderedAndProject" in plan and "duration" not in plan
    expected = recommend.recommend(assigned, model, seed, 5).collect()
    assert [r["song_id"] for r in best.collect()] == [r["song_id"] for r in expected]
