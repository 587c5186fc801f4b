"""The four jobs as a user runs them, from files to files.

Each takes a SparkSession and any URI Spark can open.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nearkin.functions.once import computed_once
from nearkin.operators import clusters, ranking, recommend, seeds
from nearkin.schema import (
    DEFAULT_K,
    DEFAULT_MAX_ITER,
    DEFAULT_SEED,
    DEFAULT_TOP,
    DEFAULT_YEARS,
    SONG_FEATURES,
    SONG_SCHEMA,
    SONGS,
)
from nearkin.sources import items, models, records
from nearkin.sources.scratch import kept


def extract(files: DataFrame, output: str, limit: int = 0, overwrite: bool = False) -> DataFrame:
    """Nested records to delimited text; returns the counts per file status.

    The counts are those of what was written. With a limit, files behind the one
    in which it is reached count as not read. Without rows this is an error,
    found after the empty target has been written.
    """
    spark = files.sparkSession
    items.refuse_existing(spark, output, overwrite)
    cut = records.find_cut(files, limit) if limit > 0 else None
    read = records.files_until(files, cut)
    of_files, of_rows = Observation(), Observation()
    ok, failed = (F.count_if(F.col("status") == status).alias(status) for status in ("ok", "failed"))
    seen = records.with_status(read).observe(of_files, ok, failed).drop("status", "error", "n_records")
    rows = records.records_until(seen, cut).drop("path", "pos")
    items.write_items(rows.observe(of_rows, F.count(F.lit(1)).alias("n")), output, overwrite)
    n_files, n_records = of_files.get, of_rows.get["n"]
    if n_records == 0:
        raise ValueError("no records read")
    if "first_pos" in files.columns:  # a file in several rows counts once
        counts = records.ingest_report(read).select("status", "n_files").collect()
        n_files = {"ok": 0, "failed": 0} | {row["status"]: row["n_files"] for row in counts}
    report = [("ok", n_files["ok"], n_records), ("failed", n_files["failed"], 0)]
    return spark.createDataFrame([r for r in report if r[1]], "status string, n_files long, n_records long")


def top_by_year(
    spark: SparkSession,
    source: str,
    first: int = DEFAULT_YEARS[0],
    last: int = DEFAULT_YEARS[1],
    n: int = DEFAULT_TOP,
    output_json: str = "",
    overwrite: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The rankings of makers and items per year; on request also as JSON.

    The source is read once; both rankings, which have at most ``n`` rows a
    year, are kept for what follows.
    """
    if output_json:
        items.refuse_existing(spark, output_json, overwrite)
    table = items.read_items(spark, source)
    c = SONGS
    needed = [c.id, c.name, c.popularity, c.maker_id, c.maker_name, c.maker_popularity]
    # The year is cast once; the filter on it goes first.
    dated = computed_once(table.select(*needed, c.year), c.year)
    rows = ranking.in_years(dated, c.year, first, last).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        artists, songs = (kept(r) for r in ranking.top_by_year(rows, first, last, n))
    finally:
        rows.unpersist()
    if output_json:
        documents = ranking.year_documents(artists, songs, first, last)
        items.write_document(ranking.as_one_document(documents), output_json, overwrite)
    return artists, songs


def cluster(
    spark: SparkSession,
    source: str,
    output: str,
    model_path: str,
    features: Sequence[str] = SONG_FEATURES,
    k: int = DEFAULT_K,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int = DEFAULT_SEED,
    overwrite: bool = False,
    format: str = "parquet",
) -> DataFrame:
    """Train, save the model, write the assigned items; returns the report.

    Delimited text is written with the fields as they were read, parquet with
    their types. A target that exists is an error before anything is read.

    The text is parsed once; its rows are kept in memory and on the executors' disks
    between training and assignment. Cost and sizes are taken from the rows on their
    way to the files. The model is saved after them.
    """
    items.refuse_existing(spark, output, overwrite)
    texts = items.parse_lines(spark.read.text(source), SONG_SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        typed = items.typed(texts, SONG_SCHEMA, features)
        model = clusters.fit_kmeans(typed, features, k, max_iter, seed, with_cost=False)
        seen = Observation()
        assigned = clusters.assign_observed(texts if format == "csv" else typed, model, seen)
        items.write_clustered(assigned.select(*SONG_SCHEMA.fieldNames(), SONGS.cluster), output, overwrite, format)
        found = seen.get
    finally:
        texts.unpersist()
    model = dataclasses.replace(model, wssse=float(found["cost"]))
    models.save_model(spark, model, model_path)
    sizes = [(i, found[f"n{i}"]) for i in range(len(model.centers)) if found[f"n{i}"]]
    return clusters.report_of_sizes(spark.createDataFrame(sizes, "cluster int, n_items long"), model)


def similar(
    spark: SparkSession,
    clustered: str,
    model_path: str,
    item_id: str = "",
    title: str = "",
    random_seed: int | None = None,
    n: int = DEFAULT_TOP,
    metric: str = "euclidean",
    output_json: str = "",
    overwrite: bool = False,
    format: str = "parquet",
) -> DataFrame:
    """The items most similar to one item; on request also as JSON."""
    if output_json:
        items.refuse_existing(spark, output_json, overwrite)
    model = models.load_model(spark, model_path)
    assigned = items.read_clustered(spark, clustered, format)
    found = seeds.find_seed(assigned, item_id, title, random_seed)
    seed = recommend.seed_row(found, model, SONGS)
    if output_json:
        document = recommend.recommend_document(assigned, model, seed, n, metric)
        items.write_json(document, output_json, overwrite)
    return recommend.recommend(assigned, model, seed, n, metric)
