import json
import math

import pytest
from pyspark.sql import functions as F

from nearkin.functions import casts
from nearkin.operators import ranking
from nearkin.schema import SONG_SCHEMA, ItemColumns

NAMES = SONG_SCHEMA.fieldNames()


def expected_songs(rows, first, last, n):
    at = {name: NAMES.index(name) for name in NAMES}
    result = []
    for year in range(first, last + 1):
        kept = {
            (-r[at["song_hotttnesss"]], r[at["song_id"]], r[at["song_name"]], r[at["artist_name"]])
            for r in rows
            if r[at["year"]] == year and math.isfinite(r[at["song_hotttnesss"]])
        }
        for rank, (neg, song, name, maker) in enumerate(sorted(kept)[:n], 1):
            result.append((year, rank, song, name, maker, -neg))
    return result


def got_songs(ranked):
    rows = ranked.select("year", "rank", "song_id", "song_name", "artist_name", "song_hotttnesss")
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("n", [1, 10, 2000])
def test_top_songs(songs, song_rows, n):
    assert got_songs(ranking.top_songs(songs, 1990, 1999, n)) == expected_songs(song_rows, 1990, 1999, n)


def test_the_unknown_year_is_a_year(songs, song_rows):
    assert got_songs(ranking.top_songs(songs, 0, 0, 5)) == expected_songs(song_rows, 0, 0, 5)


def test_text_columns_give_the_same_ranking(songs, song_rows):
    as_text = songs.select(*[F.col(c).cast("string").alias(c) for c in songs.columns])
    assert got_songs(ranking.top_songs(as_text, 1990, 1999, 7)) == expected_songs(song_rows, 1990, 1999, 7)


def test_a_maker_is_the_whole_row(spark):
    rows = [("a", "X", 0.9, 1990), ("a", "X", 0.9, 1990), ("a", "X.", 0.9, 1990), ("a", "X", 0.8, 1990)]
    df = spark.createDataFrame(rows, "artist_id string, artist_name string, artist_hotttnesss double, year int")
    got = [tuple(r) for r in ranking.top_artists(df, 1990, 1990, 10).orderBy("rank").collect()]
    assert got == [("a", "X", 0.9, 1990, 1), ("a", "X.", 0.9, 1990, 2), ("a", "X", 0.8, 1990, 3)]


def test_many_copies_and_one_hot_year(spark):
    """A third of all rows are copies of the best row; nearly all are in one year."""
    copies = spark.range(0, 20_000, 1, 7).selectExpr(
        "'top' AS song_id", "'t' AS song_name", "2.0D AS song_hotttnesss", "1990 AS year", "'m' AS artist_name"
    )
    others = spark.range(0, 40_000, 1, 7).selectExpr(
        "CAST(id AS STRING) AS song_id", "'o' AS song_name", "id / 40000 AS song_hotttnesss",
        "IF(id % 1000 = 0, 1991, 1990) AS year", "'m' AS artist_name",
    )
    rows = ranking.top_songs(copies.unionByName(others), 1990, 1991, 3).orderBy("year", "rank").collect()
    assert [(r["year"], r["rank"], r["song_id"]) for r in rows] == [
        (1990, 1, "top"), (1990, 2, "39999"), (1990, 3, "39998"),
        (1991, 1, "39000"), (1991, 2, "38000"), (1991, 3, "37000"),
    ]


def test_rows_are_limited_before_the_first_shuffle(songs):
    plan = ranking.top_songs(songs, 1990, 1999, 10)._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rindex("Exchange hashpartitioning(year")
    assert "WindowGroupLimit" in plan[first_exchange:]


def test_missing_numbers_never_rank(spark):
    rows = [("a", math.nan), ("b", None), ("c", math.inf), ("d", 0.1)]
    df = spark.createDataFrame(rows, "song_id string, song_hotttnesss double").selectExpr(
        "*", "'n' AS song_name", "1990 AS year", "'m' AS artist_name"
    )
    assert [r["song_id"] for r in ranking.top_songs(df, 1990, 1990, 9).collect()] == ["d"]


def test_spine(spark, songs):
    ranked = ranking.top_songs(songs, 1989, 1993, 2)
    full = ranking.on_every_year(ranked, 1989, 1993)
    counts = {r["year"]: r["n"] for r in full.groupBy("year").agg(F.count("rank").alias("n")).collect()}
    assert counts == {1989: 0, 1990: 2, 1991: 2, 1992: 0, 1993: 2}
    assert ranking.year_spine(spark, 5, 4).count() == 0
    assert ranking.on_every_year(ranked, 5, 4).count() == 0


def test_document(songs):
    documents = ranking.top_by_year_document(songs, 1990, 1992, 4)
    by_year = {r["year"]: r for r in documents.collect()}
    assert sorted(by_year) == [1990, 1991, 1992]
    assert by_year[1992]["top_songs"] == [] and by_year[1992]["top_artists"] == []
    for year in (1990, 1991):
        for name in ("top_songs", "top_artists"):
            values = [entry["hotttnesss"] for entry in by_year[year][name]]
            assert len(values) == 4 and values == sorted(values, reverse=True)
    whole = json.loads(ranking.as_one_document(documents).first()["value"])
    assert list(whole) == ["1990", "1991", "1992"]
    assert set(whole["1990"]["top_songs"][0]) == {"song_id", "song_name", "artist_name", "hotttnesss"}
    assert set(whole["1990"]["top_artists"][0]) == {"artist_id", "artist_name", "hotttnesss"}


def test_filters_reach_the_scan(spark, songs, tmp_path):
    songs.write.parquet(str(tmp_path / "songs"))
    stored = spark.read.parquet(str(tmp_path / "songs"))
    ranked = ranking.top_songs(stored, 1990, 1999, 3, ItemColumns())
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(year,1990)" in plan
    assert "LessThan(song_hotttnesss,Infinity)" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "duration" not in plan


def test_range_with_zero_takes_missing_years(spark):
    df = spark.createDataFrame([(None,), (0,), (3,)], "year int")
    assert df.filter(casts.in_range(df, "year", 0, 2)).count() == 2
    assert df.filter(casts.in_range(df, "year", 1, 3)).count() == 1
