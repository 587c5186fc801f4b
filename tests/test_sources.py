import json
import math
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from nearkin.operators import clusters
from nearkin.plans import jobs
from nearkin.schema import CLUSTERED_SCHEMA, SONG_FEATURES, SONG_SCHEMA
from nearkin.sources import items, models, records
from nearkin.sources.scratch import clear_scratch, scratch_path


def rows_of(df):
    def cell(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    return sorted(tuple(cell(v) for v in r) for r in df.collect())


def test_items_survive_a_file(spark, songs, tmp_path):
    path = str(tmp_path / "songs.csv")
    items.write_items(songs, path)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines.count(",".join(SONG_SCHEMA.fieldNames())) == len(list((tmp_path / "songs.csv").glob("*.csv")))
    assert any(",nan," in line for line in lines)
    assert rows_of(items.read_items(spark, path)) == rows_of(songs)


def test_line_ends(spark, songs, tmp_path):
    items.write_items(songs.limit(3).coalesce(1), str(tmp_path / "few"))
    (part,) = (tmp_path / "few").glob("*.csv")
    assert part.read_bytes().count(b"\r\n") == 4


def test_a_target_that_exists(spark, songs, tmp_path):
    path = str(tmp_path / "out")
    few = songs.limit(2)
    for write in (items.write_items, items.write_json):
        write(few, path, overwrite=True)
        with pytest.raises(AnalysisException):
            write(few, path)
        write(few.limit(1), path, overwrite=True)
    assert spark.read.json(path).count() == 1


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_clustered_items(spark, songs, tmp_path, format):
    model = clusters.start_model(songs, SONG_FEATURES, ["song_id"], 3)
    assigned = clusters.assign_items(songs, model)
    path = str(tmp_path / "clustered")
    items.write_clustered(assigned, path, format=format)
    back = items.read_clustered(spark, path, format)
    assert sorted(back.columns) == sorted(CLUSTERED_SCHEMA.fieldNames())
    assert rows_of(back.select(assigned.columns)) == rows_of(assigned)
    if format == "parquet":
        files = list((tmp_path / "clustered").rglob("*.parquet"))
        assert len(files) == assigned.select("cluster").distinct().count()
    else:
        assert "artist_id" not in {r["value"].split(",")[0] for r in spark.read.text(path).collect()}
    with pytest.raises(AnalysisException):
        items.write_clustered(assigned, path, format=format)
    with pytest.raises(ValueError):
        items.write_clustered(assigned, path, format="xml")
    with pytest.raises(ValueError):
        items.read_clustered(spark, path, format="xml")


def test_models_survive(spark, songs, tmp_path):
    model = clusters.fit_kmeans(songs, SONG_FEATURES, k=3)
    models.save_model(spark, model, str(tmp_path / "model"))
    models.save_model(spark, model, str(tmp_path / "model"))
    assert models.load_model(spark, str(tmp_path / "model")) == model


def test_file_inventory(spark, tmp_path):
    for name in ("b/two.H5", "b/one.h5", "a.h5", "a.txt", "b/c/three.h5"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    rows = items.list_files(spark, str(tmp_path)).collect()
    names = [r["path"].split(str(tmp_path))[1] for r in rows]
    assert names == ["/a.h5", "/b/c/three.h5", "/b/one.h5", "/b/two.H5"]
    assert {r["length"] for r in rows} == {5}
    assert items.list_files(spark, str(tmp_path / "a.txt")).count() == 1


FILES_SCHEMA = """path string,
metadata array<struct<artist_id: binary, artist_name: binary, song_id: binary, title: binary,
  song_hotttnesss: double, artist_hotttnesss: double>>,
analysis array<struct<loudness: double, tempo: double, key_confidence: double, mode_confidence: double,
  duration: double>>,
musicbrainz array<struct<year: int>>"""


def file_row(path, n, analysis=True, years=None):
    meta = [(b"a%d" % i, b"n\xff", f"{path}{i}".encode(), b"t\xc3\xa9", None, 0.5) for i in range(n)]
    measures = [(-1.0 * i, 100.0 + i, 0.1, 0.2, None) for i in range(n + 1)]
    return path, meta, measures if analysis else None, [(1990 + i,) for i in range(n if years is None else years)]


@pytest.fixture(scope="module")
def nested(spark):
    rows = [
        file_row("p1", 2), file_row("p3", 3), file_row("p2", 0), file_row("bad1", 2, analysis=False),
        file_row("bad2", 2, years=1),
    ]
    return spark.createDataFrame(rows, FILES_SCHEMA).repartition(3)


def test_records(nested):
    got = records.extract_records(nested).orderBy("song_id").collect()
    assert [r["song_id"] for r in got] == ["p10", "p11", "p30", "p31", "p32"]
    row = got[-1].asDict()
    assert row["artist_id"] == "a2" and row["artist_name"] == "n" and row["song_name"] == "té"
    assert (row["loudness"], row["tempo"], row["year"]) == (-2.0, 102.0, 1992)
    assert math.isnan(row["song_hotttnesss"]) and math.isnan(row["duration"])
    assert list(row) == SONG_SCHEMA.fieldNames()


def test_zipping_needs_no_shuffle(nested, spark, tmp_path):
    nested.write.parquet(str(tmp_path / "nested"))
    rows = records.zip_records(spark.read.parquet(str(tmp_path / "nested")))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_record_limit(nested):
    assert [r["song_id"] for r in records.extract_records(nested, 3).collect()] == ["p10", "p11", "p30"]
    assert records.extract_records(nested, 0).count() == 5


def test_ingest_report(nested):
    got = {r["status"]: (r["n_files"], r["n_records"]) for r in records.ingest_report(nested).collect()}
    assert got == {"ok": (3, 5), "failed": (2, 0)}
    errors = {r["path"]: r["error"] for r in records.with_status(nested).filter("error IS NOT NULL").collect()}
    assert errors == {"bad1": "missing analysis", "bad2": "short musicbrainz"}


def test_no_records_is_an_error(nested):
    with pytest.raises(ValueError, match="no records"):
        records.extract_records(nested.filter("path = 'p2'"), require_rows=True)


def test_the_jobs_from_end_to_end(spark, songs, nested, tmp_path):
    def at(name):
        return str(tmp_path / name)

    report = jobs.extract(nested, at("extracted"))
    assert {r["status"] for r in report.collect()} == {"ok", "failed"}
    assert items.read_items(spark, at("extracted")).count() == 5

    items.write_items(songs, at("songs"))
    artists, top = jobs.top_by_year(spark, at("songs"), 1990, 1992, 5, at("top.json"))
    assert artists.count() == 10 and top.count() == 10
    (line,) = [r["value"] for r in spark.read.text(at("top.json")).collect()]
    document = json.loads(line)
    assert {y: len(d["top_songs"]) for y, d in document.items()} == {"1990": 5, "1991": 5, "1992": 0}

    written = jobs.cluster(spark, at("songs"), at("clustered"), at("model"), k=3)
    assert sum(r["n_items"] for r in written.collect()) == songs.count()
    best = jobs.similar(spark, at("clustered"), at("model"), title="tune_10", n=4, output_json=at("similar.json"))
    assert best.count() == 4
    (post,) = spark.read.json(at("similar.json")).collect()
    assert post["song_id"] == "S00010"
    assert [e["song_id"] for e in post["similar"]] == [r["song_id"] for r in best.orderBy("rank").collect()]


def test_a_job_refuses_a_target_that_exists_before_any_work(spark, songs, nested, tmp_path):
    there = tmp_path / "there"
    there.mkdir()
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    with pytest.raises(FileExistsError):
        jobs.cluster(spark, "no such source", str(there), str(tmp_path / "m"))
    with pytest.raises(FileExistsError):
        jobs.extract(nested, str(there))
    with pytest.raises(FileExistsError):
        jobs.top_by_year(spark, "no such source", output_json=str(there))
    with pytest.raises(FileExistsError):
        jobs.similar(spark, "no such table", "no such model", title="x", output_json=str(there))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == before


def test_counts_under_a_limit_are_those_written(nested, spark, tmp_path):
    def report(name, limit):
        found = jobs.extract(nested, str(tmp_path / name), limit).collect()
        return {r["status"]: (r["n_files"], r["n_records"]) for r in found}

    # bad1, bad2, p1 (2 records), p2 (none), p3 (3 records)
    assert report("one", 1) == {"failed": (2, 0), "ok": (1, 1)}
    assert report("three", 3) == {"failed": (2, 0), "ok": (3, 3)}
    assert report("many", 99) == report("all", 0) == {"failed": (2, 0), "ok": (3, 5)}
    assert items.read_items(spark, str(tmp_path / "three")).count() == 3
    with pytest.raises(ValueError, match="no records"):
        jobs.extract(nested.filter("path = 'p2'"), str(tmp_path / "none"))


def test_clustered_text_is_what_was_read(spark, tmp_path):
    lines = [f"a{i},n,{i},t,-0.{i}0,nan,12{i}.0,.5,1e-1,abc,+1,x" for i in range(1, 8)]
    (tmp_path / "in.csv").write_text("\n".join(lines))
    report = jobs.cluster(
        spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), str(tmp_path / "m"), k=2, format="csv"
    )
    got = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(line.rsplit(",", 1)[0] for line in got) == lines
    clusters_listed = [r["cluster"] for r in report.collect()]
    assert clusters_listed == sorted(clusters_listed)


def test_positions_beyond_32_bits(spark):
    row = spark.createDataFrame([file_row("p", 1)], FILES_SCHEMA).withColumn("first_pos", F.lit(2**40))
    assert records.zip_records(row).first()["pos"] == 2**40


def test_null_fields_stay_in_json(spark, tmp_path):
    items.write_json(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "n"))
    assert spark.read.text(str(tmp_path / "n")).first()["value"] == '{"a":1,"b":null}'


def test_scratch_paths(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(root)
    spark.range(3).write.parquet(first)
    clear_scratch(spark)
    assert not os.path.exists(first)


def test_text_is_not_changed_by_json(spark, tmp_path):
    df = spark.createDataFrame([("é中\"",)], "t string")
    items.write_json(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()["value"] == '{"t":"é中\\""}'
    assert spark.read.json(str(tmp_path / "j")).filter(F.col("t") == "é中\"").count() == 1
