"""What is read, sorted and shuffled: limits, lookups, deep rankings, the jobs."""

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from nearkin.operators import clusters, ranking, seeds
from nearkin.plans import jobs
from nearkin.schema import SONG_FEATURES, ItemColumns
from nearkin.sources import items, models, records

KIND = (
    "path string, first_pos long, metadata array<struct<artist_id string, artist_name string, song_id string, title string, "
    "song_hotttnesss double, artist_hotttnesss double>>, analysis array<struct<loudness double, tempo double, "
    "key_confidence double, mode_confidence double, duration double>>, musicbrainz array<struct<year int>>"
)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df):
    """Rows that the scan of a one-scan query put out, and files it read."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    if "Adaptive" in leaf.getClass().getSimpleName() or "Stage" in leaf.getClass().getSimpleName():
        leaf = leaf.plan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value(), leaf.metrics().apply("numFiles").value()


# ---- limits


def file_part(path, first, n, broken=False):
    meta = [("a", "n", f"{path}:{first + i}", "t", 0.5, 0.5) for i in range(n)]
    return path, first, meta, None if broken else [(1.0,) * 5] * n, [(1990,)] * n


def some_files():
    random.seed(4)
    rows = []
    for i in random.sample(range(100, 160), 40):
        start = 0
        for _ in range(random.choice([1, 1, 3])):
            n = random.choice([0, 1, 2, 30])
            rows.append(file_part(f"f{i}", start, n, broken=i % 9 == 0))
            start += n
    return rows


def test_limits_cut_where_a_sort_would(spark):
    rows = some_files()
    files = spark.createDataFrame(rows, KIND).repartition(5)
    every = sorted((p, f + i) for p, f, meta, analysis, _ in rows if analysis for i in range(len(meta)))
    for limit in (1, 2, 31, 100, len(every) - 1, len(every), len(every) + 1):
        cut = records.find_cut(files, limit)
        assert cut == (every[limit - 1] if limit <= len(every) else None)
        got = records.extract_records(files, limit).select("song_id").collect()
        assert sorted(r["song_id"] for r in got) == sorted(f"{p}:{i}" for p, i in every[:limit])


def test_a_limit_sorts_nothing_and_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame(some_files(), KIND).drop("first_pos").write.parquet(str(tmp_path / "files"))
    files = spark.read.parquet(str(tmp_path / "files")).dropDuplicates(["path"])
    plan = executed(records.extract_records(spark.read.parquet(str(tmp_path / "files")), 3))
    assert "Sort" not in plan and "Exchange" not in plan and "Limit" not in plan
    assert "LessThanOrEqual(path,f" in plan
    report = {r["status"]: tuple(r)[1:] for r in jobs.extract(files, str(tmp_path / "out"), 3).collect()}
    assert report["ok"][1] == 3 == items.read_items(spark, str(tmp_path / "out")).count()


def test_files_without_path_come_first(spark):
    files = spark.createDataFrame([file_part("a", 0, 2), file_part("b", 0, 2), (None, *file_part("x", 0, 2)[1:])], KIND)
    got = [r["song_id"] for r in records.extract_records(files, 3).orderBy("song_id").collect()]
    assert got == ["a:0", "x:0", "x:1"]


# ---- lookups in the clustered table


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = spark.range(0, 40_000, 2).select(
        F.concat(F.lit("S"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("song_id"),
        F.concat(F.lit("name "), F.col("id")).alias("song_name"),
        F.repeat(F.lit("wide "), 20).alias("artist_name"),
        (F.col("id") % 3).cast("int").alias("cluster"),
    )
    path = str(tmp_path_factory.mktemp("stored") / "clustered")
    items.write_clustered(rows.repartition(4), path, row_group_bytes=1 << 14)
    return spark.read.parquet(path)


def test_a_lookup_by_id_reads_a_few_row_groups(stored):
    there, _ = scanned(stored.filter("song_id = 'S020000'"))
    assert 1 <= there <= 4000
    found = seeds.find_by_id(stored, "S020000").collect()
    assert [r["song_name"] for r in found] == ["name 20000"]


def test_an_id_that_is_not_there_reads_nothing(stored):
    """Odd ids lie between stored ones, so only the Bloom filter can tell."""
    assert sum(scanned(stored.filter(f"song_id = 'S{i:06d}'"))[0] for i in (1, 777, 20_001, 33_333)) == 0


def test_titles_and_chance_end_in_a_lookup(stored):
    by_title = seeds.find_by_title(stored, "NAME 1999")
    assert by_title.first()["song_id"] == "S019990"
    assert "EqualTo(song_id" in executed(by_title)
    assert "EqualTo(song_id" in executed(seeds.find_random(stored, 3))
    assert seeds.find_by_title(stored, "no such name").count() == 0
    assert seeds.find_random(stored.filter("false"), 3).count() == 0


def test_a_matching_row_without_id_is_found_last(spark):
    rows = spark.createDataFrame([(None, "tune"), (4, "tune"), (2, "Tune b")], "song_id int, song_name string")
    assert seeds.find_by_title(rows, "tune").first()["song_id"] == 2
    assert seeds.find_by_title(rows.filter("song_id IS NULL"), "tune").first()["song_name"] == "tune"


def test_text_by_cluster_is_read_in_one_cluster(spark, songs, tmp_path):
    model = clusters.start_model(songs, SONG_FEATURES, ["song_id"], 3)
    assigned = clusters.assign_items(songs, model)
    path = str(tmp_path / "text")
    items.write_clustered(assigned, path, format="csv")
    back = items.read_clustered(spark, path, "csv")
    one = back.filter(F.col("cluster") == 1)
    assert "PartitionFilters: [isnotnull(in_cluster" in executed(one)
    _, n_files = scanned(spark.read.text(path).filter("in_cluster = 1"))
    assert n_files < len(spark.read.text(path).inputFiles())
    wanted = assigned.filter("cluster = 1").count()
    assert one.count() == wanted and set(back.columns) == set(assigned.columns)
    lines = spark.read.text(path).filter("in_cluster = 1").select("value").collect()
    assert all(r["value"].endswith(",1") for r in lines) and len(lines) == wanted
    single = str(tmp_path / "plain")
    items.write_items(assigned, single, header=False)
    assert items.read_clustered(spark, single, "csv").filter("cluster = 1").count() == wanted


# ---- deep rankings

DEEP = ItemColumns(id="id", name="name", popularity="p", year="year", maker_name="maker")


def ranked(rows, n):
    out = []
    for year in {r[3] for r in rows}:
        own = sorted({(-p, i, name, maker) for i, name, p, y, maker in rows if y == year and p == p})
        out += [(year, k, i, -p) for k, (p, i, _, _) in enumerate(own[:n], 1)]
    return sorted(out)


@pytest.mark.parametrize("shape", ["spread", "coarse", "one value", "few rows", "copies"])
def test_deep_rankings(spark, monkeypatch, shape):
    """With a low limit, so that few rows reach the histogram; also where it cannot cut."""
    monkeypatch.setattr(ranking, "WINDOW_LIMIT", 10)
    random.seed(6)
    value = {"coarse": lambda: float(random.randrange(4)), "one value": lambda: 1.0}.get(shape, random.random)
    n_rows = {"few rows": 30, "copies": 300}.get(shape, 3000)
    rows = [(i, f"n{i % 3}", value(), 1990 + (i % 10 == 0), "m") for i in range(n_rows)]
    rows += [(5000, "nan", float("nan"), 1990, "m")]
    rows = rows * (20 if shape == "copies" else 1)
    df = spark.createDataFrame(rows, "id int, name string, p double, year int, maker string").repartition(4)
    got = ranking.top_songs(df, 1900, 2000, 50, DEEP).select("year", "rank", "id", "p").collect()
    assert sorted(map(tuple, got)) == ranked(rows, 50)


def test_the_cut_leaves_few_rows(spark):
    n = 2000
    df = spark.range(200_000).select((F.col("id") % 2).alias("g"), "id", F.rand(3).alias("p"))
    left = ranking.above_cut(df, "g", "p", n).groupBy("g").count().collect()
    assert len(left) == 2 and all(n <= r["count"] <= 4 * n for r in left)
    plan = executed(ranking.top_distinct(df, "g", [F.desc("p"), F.col("id")], n, "p"))
    assert "_least" in plan


# ---- the clustering job and its model


def test_the_job_parses_once_and_reads_nothing_back(spark, songs, tmp_path, monkeypatch):
    items.write_items(songs, str(tmp_path / "in"))
    parsed, parse = [], items.parse_lines
    songs.count()
    kept_before = len(spark._jsc.getPersistentRDDs())
    monkeypatch.setattr(items, "parse_lines", lambda *a, **b: parsed.append(parse(*a, **b)) or parsed[-1])
    monkeypatch.setattr(items, "read_clustered", lambda *a, **b: pytest.fail("read back"))
    for format in ("parquet", "csv"):
        out, saved = str(tmp_path / format), str(tmp_path / f"model-{format}")
        report = jobs.cluster(spark, str(tmp_path / "in"), out, saved, k=3, format=format).collect()
        assert len(parsed) == 1
        parsed.clear()
        assert len(spark._jsc.getPersistentRDDs()) == kept_before
        monkeypatch.undo()
        model = models.load_model(spark, saved)
        written = items.read_clustered(spark, out, format)
        assert report == clusters.cluster_report(written, model).collect()
        _, again = clusters.cluster_items(items.read_items(spark, str(tmp_path / "in")), k=3)
        assert model.wssse == pytest.approx(again.wssse) and model.n_items == again.n_items
        monkeypatch.setattr(items, "parse_lines", lambda *a, **b: parsed.append(parse(*a, **b)) or parsed[-1])
        monkeypatch.setattr(items, "read_clustered", lambda *a, **b: pytest.fail("read back"))


def test_a_reader_never_meets_half_a_model(spark, songs, tmp_path, monkeypatch):
    path = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, path)
    first = dataclasses.replace(clusters.start_model(songs, SONG_FEATURES, ["song_id"], 3), wssse=1.0)
    second = dataclasses.replace(clusters.start_model(songs, SONG_FEATURES, ["song_id"], 4, steps=1), wssse=2.0)
    models.save_model(spark, first, path)
    tables = models.model_tables

    def stopped(spark, model):
        made = tables(spark, model)
        yield "centers", made["centers"]
        yield "feature_stats", made["feature_stats"]
        raise OSError("lost")

    monkeypatch.setattr(models, "model_tables", lambda *a: type("T", (), {"items": lambda self: stopped(*a)})())
    with pytest.raises(OSError):
        models.save_model(spark, second, path)
    monkeypatch.undo()
    assert models.load_model(spark, path) == first
    models.save_model(spark, second, path)
    assert models.load_model(spark, path) == second
    left = sorted(p.name for p in (tmp_path / "model").iterdir() if p.name.startswith("version="))
    assert len(left) == 2 and f"version={models.current_version(spark, path)}" in left


# ---- listing


def test_hidden_names_are_listed_in_pages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(items, "LISTING_PAGE", 2)
    for name in ("a.h5", "_b.h5", ".c.h5", "d.txt", "_sub/e.H5", ".sub/f.h5"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name)
    rows = items.list_files(spark, str(tmp_path)).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in rows] == [".c.h5", "f.h5", "_b.h5", "e.H5", "a.h5"]
    assert [r["length"] for r in rows] == [5, 9, 5, 9, 4]
    (tmp_path / "empty").mkdir()
    assert items.list_files(spark, str(tmp_path / "empty")).count() == 0
