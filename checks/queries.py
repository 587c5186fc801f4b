"""Every operator as a query over the given tables.

Roles of the tables: orders are items with a year and a popularity, customers
their makers; parts with the averages of their line items are the catalogue
that is clustered; embeddings are wide vectors with a group label; documents,
events and pages are raw text.
"""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.functions import casts, csvlines, vectors
from nearkin.operators import clusters, features, ranking, recommend, seeds
from nearkin.plans import jobs
from nearkin.schema import ItemColumns
from nearkin.sources import items, models, records
from nearkin.sources.scratch import kept, scratch_path

FIRST_YEAR, LAST_YEAR = 1996, 2000
SPINE_YEARS = (1993, 2003)
TOP = 10
DEEP = 5000
K = 10
CATALOG_FEATURES = ["quantity", "price", "discount", "tax"]
EMBEDDING_DIM = 64
SEED_TITLE = "BLUE"
SEED_ID = 100
RANDOM_SEED = 7
MEANS_TOLERANCE = 0.05

ORDERS = ItemColumns(
    id="o_orderkey", name="o_orderpriority", popularity="o_totalprice", year="year",
    maker_name="o_custkey", extra=(("o_totalprice", 2),),
)
CUSTOMERS = ItemColumns(
    maker_id="c_custkey", maker_name="c_name", maker_popularity="c_acctbal", year="year"
)
SALES = ItemColumns(
    id="o_orderkey", name="o_orderpriority", popularity="o_totalprice", year="year",
    maker_id="c_custkey", maker_name="c_name", maker_popularity="c_acctbal",
)
CATALOG = ItemColumns(
    id="p_partkey", name="p_name", maker_id="p_type", maker_name="p_brand", year="p_size",
    extra=(("price", 2), ("quantity", 2)),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _round(name: str, digits: int = 6) -> Column:
    return F.round(name, digits).alias(name)


# --- ranking ---------------------------------------------------------------


def orders_in(spark: SparkSession, sf_dir: str, first: int, last: int) -> DataFrame:
    """Orders of a span of years; the price of pending ones is not a number.

    The dates are compared as they are stored, so that the span reaches the scan.
    """
    orders = table(spark, sf_dir, "orders")
    dates = F.col("o_orderdate")
    span = (dates >= F.lit(f"{first}-01-01").cast("timestamp_ntz")) & (
        dates < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz")
    )
    pending = F.col("o_orderstatus") == "P"
    return orders.filter(span).select(
        "o_orderkey",
        "o_orderpriority",
        F.when(pending, F.lit(casts.NAN)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_custkey",
        F.year(dates).alias("year"),
    )


def active_customers(spark: SparkSession, sf_dir: str, first: int, last: int) -> DataFrame:
    """Customers with each year they ordered in; the pairs are made unique first."""
    pairs = orders_in(spark, sf_dir, first, last).select("o_custkey", "year").distinct()
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return pairs.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")


def top_orders(spark: SparkSession, sf_dir: str, first: int, last: int) -> DataFrame:
    """The dearest orders per year; the customer's name joins the few winners."""
    orders = orders_in(spark, sf_dir, first, last)
    ranked = ranking.top_songs(orders, first, last, TOP, ORDERS)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # At most years x TOP rows, so broadcasting the ranking is safe.
    return customers.join(F.broadcast(ranked), F.col("c_custkey") == F.col("o_custkey"))


def top_items_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_orders(spark, sf_dir, FIRST_YEAR, LAST_YEAR).select(
        "year", "rank", "o_orderkey", "o_orderpriority", "o_custkey", "c_name",
        _round("o_totalprice", 4),
    )


def top_groups_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = active_customers(spark, sf_dir, FIRST_YEAR, LAST_YEAR)
    ranked = ranking.top_artists(customers, FIRST_YEAR, LAST_YEAR, TOP, CUSTOMERS)
    return ranked.select("year", "rank", "c_custkey", "c_name", _round("c_acctbal", 4))


def top_by_year_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_in(spark, sf_dir, *SPINE_YEARS)
    ranked = ranking.top_songs(orders, *SPINE_YEARS, TOP, ORDERS)
    return ranking.on_every_year(ranked, *SPINE_YEARS, ORDERS).select(
        "year", "rank", "o_orderkey", _round("o_totalprice", 4)
    )


def top_items_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five thousand places per decade, with every order twice."""
    orders = orders_in(spark, sf_dir, 1980, 2009)
    decade = (F.floor(F.col("year") / 10) * 10).cast("int")
    twice = orders.withColumn("year", decade).withColumn("nth", F.explode(F.array(F.lit(1), F.lit(2)))).drop("nth")
    ranked = ranking.top_songs(twice, 1980, 2000, DEEP, ORDERS)
    return ranked.select("year", "rank", "o_orderkey", "o_custkey", _round("o_totalprice", 4))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year documents of orders (as items) and customers (as makers)."""
    customers = active_customers(spark, sf_dir, *SPINE_YEARS)
    makers = ranking.top_artists(customers, *SPINE_YEARS, TOP, CUSTOMERS)
    orders = top_orders(spark, sf_dir, *SPINE_YEARS)
    return ranking.year_documents(makers, orders, *SPINE_YEARS, SALES)


def _flat_documents(documents: DataFrame) -> DataFrame:
    def flat(name: str, key: str) -> Column:
        text = F.transform(
            name, lambda e: F.concat_ws(":", e[key].cast("string"), F.format_string("%.4f", e["hotttnesss"]))
        )
        return F.array_join(text, ";").alias(name)

    return documents.select(
        "year",
        F.size("top_artists").alias("n_artists"),
        F.size("top_songs").alias("n_songs"),
        flat("top_artists", "artist_id"),
        flat("top_songs", "song_id"),
    )


def top_by_year_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_documents(_documents(spark, sf_dir))


def top_by_year_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents written as one JSON text and read back."""
    documents = _documents(spark, sf_dir)
    path = scratch_path(spark, "top_by_year")
    items.write_document(ranking.as_one_document(documents), path)
    body = documents.schema.simpleString().replace("struct<year:int,", "struct<", 1)
    whole = spark.read.text(path, wholetext=True).select(
        F.from_json("value", f"map<string,{body}>").alias("by_year")
    )
    rows = whole.select(F.explode("by_year").alias("year", "body"))
    return _flat_documents(rows.select(F.col("year").cast("int").alias("year"), "body.*"))


def display_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display columns of all orders; the year of pending orders is unknown (0)."""
    orders = table(spark, sf_dir, "orders")
    year = F.when(F.col("o_orderstatus") == "P", 0).otherwise(F.year("o_orderdate"))
    shown = recommend.describe(orders.withColumn("year", year), ORDERS)
    return shown.withColumn("known_year", casts.known_year(F.col("year")))


# --- text in and out -------------------------------------------------------


def one_line(name: str) -> Column:
    """Text with its line ends turned into blanks: a record is one line."""
    blank = F.lit(" ")
    return F.replace(F.replace(name, F.lit("\n"), blank), F.lit("\r"), blank).alias(name)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    names = ["doc_id", "text", "lang", "source"]
    rows = documents.select("doc_id", one_line("text"), "lang", "source")
    lines = rows.select(csvlines.join_line([F.col(n) for n in names]).alias("value"))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return items.parse_lines(lines, schema).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def csv_data_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good, long, short, empty and header lines of every event; two kinds stay."""
    names = ["event_id", "event_type", "props", "value"]
    good = csvlines.join_line([F.col(n) for n in names])
    short = csvlines.join_line([F.col("event_type"), F.col("props")])
    kinds = {
        "good": good,
        "long": F.concat(good, F.lit(",more")),
        "wide": F.concat(good, F.repeat(F.lit(",x"), F.when(F.col("event_id") % 500 == 0, 25_001).otherwise(9))),
        "short": short,
        "empty": F.lit(""),
        "header": F.lit(",".join(names)),
    }
    lines = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()])
    events = table(spark, sf_dir, "events").select(F.inline(lines))
    schema = T.StructType(
        [
            T.StructField("event_id", T.StringType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("props", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    rows = items.typed(items.parse_lines(events, schema), schema)
    return rows.withColumn("event_id", F.col("event_id").cast("bigint"))


def csv_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue written as delimited text and scanned again."""
    rows = catalog(spark, sf_dir).select("p_name", "p_brand", "p_partkey", *CATALOG_FEATURES)
    path = scratch_path(spark, "catalog")
    items.write_items(rows, path)
    back = items.read_items(spark, path, rows.schema)
    return back.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "p_brand",
        *[F.when(casts.is_finite(F.col(f)), F.col(f)).alias(f) for f in CATALOG_FEATURES],
    )


def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number casts of good and bad text made from every event."""
    value = F.col("value").cast("string")
    variants = {
        "plain": value,
        "blanks": F.concat(F.lit("  "), value, F.lit(" ")),
        "minus": F.concat(F.lit("-"), value),
        "power": F.concat(value, F.lit("e2")),
        "tail": F.concat(value, F.lit("x")),
        "word": F.col("event_type"),
        "json": F.col("props"),
        "nan": F.lit("nan"),
        "inf": F.lit("-inf"),
        "empty": F.lit(""),
        "null": F.lit(None).cast("string"),
    }
    texts = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("t")) for k, v in variants.items()])
    rows = table(spark, sf_dir, "events").select("event_id", F.inline(texts))
    as_float = casts.safe_float(F.col("t"))
    return rows.select(
        "event_id",
        "kind",
        casts.is_finite(as_float).alias("is_number"),
        F.when(casts.is_finite(as_float), as_float).alias("as_float"),
        casts.safe_int(F.col("t")).alias("as_int"),
    )


def clean_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document between bytes that are not UTF-8; the text comes back."""
    raw = F.concat(F.unhex(F.lit("FF")), F.encode("text", "UTF-8"), F.unhex(F.lit("C3")))
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", casts.clean_utf8(raw).alias("text"))


# --- nested records --------------------------------------------------------


def _files_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a source file, every line of it as a record."""
    lines = F.split("text", "\n")
    documents = table(spark, sf_dir, "documents")
    arrays = F.struct(
        F.transform(
            lines,
            lambda line, i: F.struct(
                F.col("source").alias("artist_id"),
                F.col("lang").alias("artist_name"),
                F.concat_ws("-", F.col("doc_id"), i).alias("song_id"),
                line.alias("title"),
                F.lit("nan").alias("song_hotttnesss"),
                F.col("n_chars").alias("artist_hotttnesss"),
            ),
        ).alias("metadata"),
        F.transform(
            lines,
            lambda line, i: F.struct(
                F.length(line).cast("double").alias("loudness"),
                i.alias("tempo"),
                F.lit(0.5).alias("key_confidence"),
                F.lit(0.25).alias("mode_confidence"),
                F.size(F.split(line, " ")).alias("duration"),
            ),
        ).alias("analysis"),
        F.transform(lines, lambda line, i: F.struct((i + 1990).alias("year"))).alias("musicbrainz"),
    )
    # Unfolded, so that the arrays are built once and not in every expression that uses them.
    return documents.select(F.col("doc_id").cast("string").alias("path"), F.inline(F.array(arrays)))


def zip_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records.zip_records(_files_of_lines(spark, sf_dir))
    return rows.select(
        "path", "pos", "artist_id", "artist_name", "song_id", "song_name", "loudness", "tempo",
        "year", "artist_hotttnesss", "duration",
    )


def ingest_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first records over all files, by path and position."""
    rows = records.extract_records(_files_of_lines(spark, sf_dir), limit=500)
    return rows.select("song_id", "song_name", "loudness", "year")


def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files of paragraphs; those with a query part lack an array, the
    German ones have a short one."""
    parts = F.split("html", "<p>")
    years = F.transform(parts, lambda p: F.struct(F.length(p).alias("year")))
    german = F.contains("url", F.lit("/de/"))
    analysis = F.transform(parts, lambda p: F.struct(F.length(p).alias("tempo")))
    files = table(spark, sf_dir, "pages").select(
        F.col("url").alias("path"),
        F.transform(parts, lambda p: F.struct(p.alias("title"))).alias("metadata"),
        F.when(~F.contains("url", F.lit("?")), analysis).alias("analysis"),
        F.when(german, F.slice(years, F.lit(1), F.size(years) - 1)).otherwise(years).alias("musicbrainz"),
    )
    return records.ingest_report(files)


# The given tables.
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the tables, with the rows that came from each table's files."""
    name = F.regexp_extract("path", r"([a-z]+)\.parquet", 1)
    files = items.list_files(spark, sf_dir, ".parquet")
    listed = files.groupBy(name.alias("table_name")).agg(
        (F.sum("length") > 0).alias("has_bytes")
    )
    paths = [table(spark, sf_dir, t).select(F.col("_metadata.file_path").alias("path")) for t in TABLES]
    # One row per file first, then the expression on the few paths.
    files_rows = reduce(DataFrame.unionByName, paths).groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    counts = files_rows.groupBy(name.alias("table_name")).agg(F.sum("n").alias("n_rows"))
    return listed.join(counts, "table_name", "left")


def hidden_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables written under names that begin with ``_`` and ``.``, as they are listed."""
    root = scratch_path(spark, "hidden")
    for name, folder in (("nation", "_x"), ("region", ".x")):
        table(spark, sf_dir, name).coalesce(1).write.parquet(f"{root}/{folder}")
    files = items.list_files(spark, root, ".parquet")
    folder = F.regexp_extract("path", r"/([^/]*)/[^/]*$", 1)
    rows = files.select(folder.alias("folder"), (F.col("length") > 0).alias("has_bytes"))
    return rows.groupBy("folder", "has_bytes").agg(F.count(F.lit(1)).alias("n_files"))


# --- features --------------------------------------------------------------


def _average(name: str) -> Column:
    hundredths = F.rint(F.col(name) * 100).cast("bigint")
    return F.sum(hundredths).cast("double") / (F.count(name) * 100)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the averages of their line items as features.

    Three sizes of part have features that are missing, no number or infinite.
    The averages are taken before the join, so that a part with very many line
    items arrives as one row. They are averages of whole hundredths, so that
    they do not depend on the order of the line items.
    """
    lines = table(spark, sf_dir, "lineitem")
    averages = lines.groupBy("l_partkey").agg(
        _average("l_quantity").alias("quantity"),
        _average("l_extendedprice").alias("price"),
        _average("l_discount").alias("discount"),
        _average("l_tax").alias("tax"),
    )
    size = F.col("p_size")
    parts = table(spark, sf_dir, "part")
    joined = parts.join(averages, F.col("p_partkey") == F.col("l_partkey"), "left")
    return joined.select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size",
        F.when(size != 1, F.col("quantity")).alias("quantity"),
        F.when(size == 2, F.lit(casts.NAN)).otherwise(F.col("price")).alias("price"),
        F.when(size == 3, F.lit(float("inf"))).otherwise(F.col("discount")).alias("discount"),
        "tax",
    )


def kept_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue, kept in files for queries that read it several times."""
    return kept(catalog(spark, sf_dir))


def valid_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.valid_items(catalog(spark, sf_dir), CATALOG_FEATURES)
    return rows.select("p_partkey", "p_name", *CATALOG_FEATURES)


def feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.valid_items(catalog(spark, sf_dir), CATALOG_FEATURES)
    return features.feature_stats(rows, CATALOG_FEATURES).select(
        "pos", "feature", "n", _round("mean"), _round("std"), _round("total", 2),
        F.round(F.col("total_squares") / F.col("n"), 2).alias("mean_square"),
    )


def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.valid_items(kept_catalog(spark, sf_dir), CATALOG_FEATURES)
    stats = features.fit_stats(rows, CATALOG_FEATURES)
    scaled = features.standardize(rows, stats)
    return scaled.select("p_partkey", *[_round(f + "_z") for f in CATALOG_FEATURES])


# --- clusters --------------------------------------------------------------


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    doubles = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    return features.valid_vectors(doubles, "embedding", EMBEDDING_DIM)


def label_means(spark: SparkSession, sf_dir: str) -> list[tuple[float, ...]]:
    """The mean embedding per label, in the order of the labels."""
    rows = _embeddings(spark, sf_dir)
    entries = vectors.entries("embedding", EMBEDDING_DIM)
    means = rows.groupBy("label").agg(*[F.expr(f"avg({e}) AS _{i}") for i, e in enumerate(entries)])
    return [tuple(row[1:]) for row in means.orderBy("label").collect()]


def assign_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide vectors: the nearest label mean of every embedding."""
    assigned = clusters.assign_nearest(
        _embeddings(spark, sf_dir), "embedding", label_means(spark, sf_dir)
    )
    return assigned.select("vec_id", "label", "cluster")


def wssse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _embeddings(spark, sf_dir)
    cost = clusters.total_cost(rows, "embedding", label_means(spark, sf_dir))
    return cost.select(_round("wssse"))


def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_sizes(assign_nearest(spark, sf_dir))


def _start_model(rows: DataFrame, steps: int = 0) -> clusters.ClusterModel:
    """Centers that start at the first K valid parts."""
    return clusters.start_model(rows, CATALOG_FEATURES, ["p_partkey"], K, steps)


def assign_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few features: the cluster of every valid part."""
    rows = kept_catalog(spark, sf_dir)
    assigned = clusters.assign_items(rows, _start_model(rows))
    return assigned.select("p_partkey", "p_name", "cluster")


def lloyd_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _start_model(kept_catalog(spark, sf_dir), steps=2)
    centers = clusters.centers_table(spark, model)
    rows = centers.select("cluster", F.posexplode("center").alias("pos", "value"))
    return rows.select("cluster", "pos", _round("value"))


def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kept_catalog(spark, sf_dir)
    model = _start_model(rows)
    report = clusters.cluster_report(clusters.assign_items(rows, model), model)
    text = F.transform("center", lambda x: F.format_string("%.3f", x))
    return report.select("cluster", "n_items", F.array_join(text, " ").alias("center"))


def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trained model held against its own rows, with plain joins and sums.

    Of every valid part: whether its label is the nearest of the centers (worked
    out from the centers as a table). Of the whole: whether the sizes add up to the
    valid parts, the stated cost is the sum over the rows and below that of one
    center, and every center is the mean of its rows.
    """
    rows = kept_catalog(spark, sf_dir)
    assigned, model = clusters.cluster_items(rows, CATALOG_FEATURES, K)
    z = [f"_z{i}" for i in range(len(CATALOG_FEATURES))]
    placed = kept(features.with_point(assigned, model.stats).select("p_partkey", "cluster", F.array(*z).alias("z")))
    centers = F.array(*[F.array(*map(F.lit, center)) for center in model.centers])
    costs = F.transform(
        centers,
        lambda center: F.aggregate(
            F.zip_with("z", center, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, x: total + x
        ),
    )
    best = placed.withColumn("costs", costs).select(
        "p_partkey", F.get("costs", F.col("cluster")).alias("own"), F.array_min("costs").alias("best")
    )
    means = placed.groupBy("cluster").agg(*[F.avg(F.col("z")[i]).alias(n) for i, n in enumerate(z)]).collect()
    moved = max(
        abs(row[n] - model.centers[row["cluster"]][i]) for row in means for i, n in enumerate(z)
    )
    total = best.agg(F.sum("best").alias("cost"), F.count("*").alias("n")).first()
    whole = (
        total["n"] == model.n_items
        and abs(total["cost"] - model.wssse) <= 1e-6 * model.wssse
        and 0.0 < model.wssse < model.n_items * len(CATALOG_FEATURES)
    )
    return best.select(
        "p_partkey",
        (F.col("own") <= F.col("best") + 1e-9).alias("is_nearest"),
        F.lit(moved < MEANS_TOLERANCE).alias("centers_are_means"),
        F.lit(whole).alias("sums_agree"),
    )


def nearest_of_any_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of which some are missing, too short, too long or hold NaN: the
    nearest of all label means (wide form) and of the first two (written out)."""
    middles = label_means(spark, sf_dir)
    v = F.col("embedding")
    broken = (
        F.when(F.col("vec_id") % 7 == 1, F.lit(None))
        .when(F.col("vec_id") % 7 == 2, F.slice(v, 1, EMBEDDING_DIM - 1))
        .when(F.col("vec_id") % 7 == 3, F.concat(v, F.array(F.lit(0.0))))
        .when(F.col("vec_id") % 7 == 4, F.concat(F.slice(v, 1, EMBEDDING_DIM - 1), F.array(F.lit(casts.NAN))))
        .otherwise(v)
    )
    rows = _embeddings(spark, sf_dir).withColumn("embedding", broken)
    wide = clusters.assign_nearest(rows, "embedding", middles, "wide")
    return clusters.assign_nearest(wide, "embedding", middles[:2], "narrow").select("vec_id", "wide", "narrow")


def batch_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every valid part as a seed, book distance; the three most similar."""
    assigned, model = _assigned(spark, sf_dir)
    best = recommend.recommend_batch(assigned, model, assigned, 3, "book", CATALOG)
    return best.select("seed_id", "rank", "p_partkey", "distance")


def batch_of_all_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the plain distance."""
    assigned, model = _assigned(spark, sf_dir)
    best = recommend.recommend_batch(assigned, model, assigned, 3, "euclidean", CATALOG)
    return best.select("seed_id", "rank", "p_partkey", "distance")


def batch_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first part of every cluster, two thousand places deep."""
    assigned, model = _assigned(spark, sf_dir)
    first = F.min(F.struct("p_partkey", *CATALOG_FEATURES)).alias("first")
    chosen = assigned.groupBy("cluster").agg(first).select("cluster", "first.*")
    best = recommend.recommend_batch(assigned, model, chosen, 2000, "euclidean", CATALOG)
    return best.select("seed_id", "rank", "p_partkey", "distance")


def renamed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another name for the cluster, ids that repeat and are missing: the parts of
    one type share its name as id, and one type has none."""
    assigned, model = _assigned(spark, sf_dir)
    columns = dataclasses.replace(CATALOG, id="kind", cluster="grp", maker_id="p_partkey", extra=())
    rows = assigned.withColumnRenamed("cluster", "grp").withColumn(
        "kind", F.when(F.col("p_size") != 5, F.col("p_type"))
    )
    best = recommend.recommend_batch(rows, model, rows.filter("kind IS NOT NULL"), 4, "euclidean", columns)
    return best.select("seed_id", "rank", "kind", "p_partkey", "distance")


def extract_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extraction job with a limit: its report."""
    path = scratch_path(spark, "extracted")
    return jobs.extract(_files_of_lines(spark, sf_dir), path, limit=500)


def clustered_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustering job on delimited text: the lines it writes, without the label,
    are the lines it read."""
    rows = features.valid_items(catalog(spark, sf_dir), CATALOG_FEATURES)
    text = [F.col("p_partkey"), F.col("p_brand"), F.col("p_partkey"), F.col("p_name")]
    quantity, price, discount, tax = (
        F.concat(F.lit("+"), F.floor(F.col(f) * 1000).cast("string"), F.lit(".50")) for f in CATALOG_FEATURES
    )
    columns = [*text, quantity, F.lit("x"), price, discount, tax, F.lit("about 1990"), F.lit(""), F.lit("-0.50")]
    lines = rows.select(csvlines.join_line([c.cast("string") for c in columns]).alias("value"))
    source, target, model = (scratch_path(spark, name) for name in ("source", "target", "model"))
    lines.write.text(source)
    jobs.cluster(spark, source, target, model, k=4, format="csv")
    return spark.read.text(target).select(F.regexp_replace("value", ",[0-9]+$", "").alias("line"))


def recommend_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document of a seed without a maker, written as JSON and read back as text."""
    assigned, model = _assigned(spark, sf_dir)
    nameless = assigned.withColumn("p_brand", F.lit(None).cast("string"))
    seed = recommend.seed_row(seeds.find_by_title(nameless, SEED_TITLE, CATALOG), model, CATALOG)
    path = scratch_path(spark, "similar")
    items.write_json(recommend.recommend_document(nameless, model, seed, 3, "euclidean", CATALOG), path)
    text = spark.read.text(path)
    return text.select(
        F.get_json_object("value", "$.song_id").cast("bigint").alias("song_id"),
        F.contains("value", F.lit('"artist":null')).alias("has_artist"),
        F.size(F.regexp_extract_all("value", F.lit('"p_brand":null'), F.lit(0))).alias("n_makers"),
    )


def cluster_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing of cluster sizes with the place of each row."""
    sizes = cluster_sizes(spark, sf_dir).coalesce(1)
    return sizes.withColumn("place", F.monotonically_increasing_id()).select("place", "cluster")


def model_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model saved, loaded and laid out as rows."""
    path = scratch_path(spark, "model")
    models.save_model(spark, _start_model(kept_catalog(spark, sf_dir)), path)
    tables = models.model_tables(spark, models.load_model(spark, path))
    centers = tables["centers"].select(
        F.lit("center").alias("entry"), "cluster", F.posexplode("center").alias("pos", "value")
    )
    stats = tables["feature_stats"]
    no_cluster = F.lit(-1).alias("cluster")
    mean = stats.select(F.lit("mean").alias("entry"), no_cluster, "pos", F.col("mean").alias("value"))
    std = stats.select(F.lit("std").alias("entry"), no_cluster, "pos", F.col("std").alias("value"))
    rows = centers.unionByName(mean).unionByName(std)
    return rows.select("entry", "cluster", "pos", _round("value"))


def clustered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assigned catalogue written by cluster; the seed's cluster read back."""
    rows = kept_catalog(spark, sf_dir)
    model = _start_model(rows)
    path = scratch_path(spark, "clustered")
    items.write_clustered(clusters.assign_items(rows, model), path)
    written = items.read_clustered(spark, path)
    seed = recommend.seed_row(seeds.find_by_title(written, SEED_TITLE, CATALOG), model, CATALOG)
    inside = written.filter(F.col("cluster") == seed["cluster"])
    return inside.select("p_partkey", "p_name", "cluster", *CATALOG_FEATURES)


def clustered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One part of the clustered table by its id, one by its name and one at random."""
    rows = kept_catalog(spark, sf_dir)
    path = scratch_path(spark, "clustered")
    items.write_clustered(clusters.assign_items(rows, _start_model(rows)), path, item_id=CATALOG.id)
    stored = items.read_clustered(spark, path)
    by_id = seeds.find_seed(stored, item_id=SEED_ID, columns=CATALOG).select(F.lit("id").alias("how"), "p_partkey", "cluster")
    by_name = seeds.find_seed(stored, title=SEED_TITLE, columns=CATALOG).select(F.lit("title").alias("how"), "p_partkey", "cluster")
    chance = seeds.find_seed(stored, random_seed=RANDOM_SEED, columns=CATALOG)
    return by_id.unionByName(by_name).unionByName(chance.select(F.lit("chance").alias("how"), "p_partkey", "cluster"))


def clustered_csv_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustered text, read in the cluster of the seed only."""
    rows = kept_catalog(spark, sf_dir)
    model = _start_model(rows)
    assigned = clusters.assign_items(rows, model)
    path = scratch_path(spark, "clustered_csv")
    items.write_clustered(assigned, path, format="csv")
    back = items.read_clustered(spark, path, "csv", assigned.schema)
    seed = recommend.seed_row(seeds.find_by_title(assigned, SEED_TITLE, CATALOG), model, CATALOG)
    inside = back.filter(F.col("cluster") == seed["cluster"])
    return inside.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "cluster", *CATALOG_FEATURES)


def clustered_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as delimited text, all clusters."""
    rows = kept_catalog(spark, sf_dir)
    assigned = clusters.assign_items(rows, _start_model(rows))
    path = scratch_path(spark, "clustered_csv")
    items.write_clustered(assigned, path, format="csv")
    back = items.read_clustered(spark, path, "csv", assigned.schema)
    return back.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "cluster",
        *CATALOG_FEATURES,
    )


# --- similar items ---------------------------------------------------------


def title_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return seeds.match_title(parts, SEED_TITLE, CATALOG)


def find_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return seeds.find_seed(parts, title=SEED_TITLE, columns=CATALOG)


def find_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return seeds.find_seed(parts, item_id=SEED_ID, title=SEED_TITLE, columns=CATALOG)


def find_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return seeds.find_seed(parts, random_seed=RANDOM_SEED, columns=CATALOG)


def _assigned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, clusters.ClusterModel]:
    rows = kept_catalog(spark, sf_dir)
    model = _start_model(rows)
    return clusters.assign_items(rows, model), model


def _seeded(spark: SparkSession, sf_dir: str):
    assigned, model = _assigned(spark, sf_dir)
    found = seeds.find_by_title(assigned, SEED_TITLE, CATALOG)
    return assigned, model, recommend.seed_row(found, model, CATALOG)


def recommend_euclidean(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, model, seed = _seeded(spark, sf_dir)
    return recommend.recommend(assigned, model, seed, TOP, "euclidean", CATALOG)


def recommend_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, model, seed = _seeded(spark, sf_dir)
    return recommend.recommend(assigned, model, seed, TOP, "book", CATALOG)


def recommend_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, model, seed = _seeded(spark, sf_dir)
    document = recommend.recommend_document(assigned, model, seed, TOP, "euclidean", CATALOG)
    entry = F.transform(
        "similar",
        lambda e: F.concat_ws(":", e["p_partkey"].cast("string"), F.format_string("%.6f", e["distance"])),
    )
    return document.select(
        "name", "artist", "song_id", "year", "cluster", "metric",
        F.array_join(entry, ";").alias("similar"),
    )


def item_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both distances of every valid part from the seed."""
    assigned, model, seed = _seeded(spark, sf_dir)
    scored = recommend.with_seed_distance(assigned, seed, model, "euclidean", "euclidean")
    scored = recommend.with_seed_distance(scored, seed, model, "book", "book")
    return scored.select("p_partkey", _round("euclidean"), _round("book"))


def candidate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, model, seed = _seeded(spark, sf_dir)
    return recommend.candidate_counts(assigned, seed, model, CATALOG)


def recommend_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One seed per cluster (its first part), book distance."""
    assigned, model = _assigned(spark, sf_dir)
    first = F.min(F.struct("p_partkey", *CATALOG_FEATURES)).alias("first")
    chosen = assigned.groupBy("cluster").agg(first).select("cluster", "first.*")
    best = recommend.recommend_batch(assigned, model, chosen, TOP, "book", CATALOG)
    return best.select("seed_id", "rank", "p_partkey", "p_name", "price", "distance")


def nearest_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest embeddings of the same label, for the first one of each label."""
    rows = _embeddings(spark, sf_dir)
    first = F.min(F.struct("vec_id", "embedding")).alias("first")
    chosen = rows.groupBy("label").agg(first).select(
        "label",
        F.col("first.vec_id").alias("seed_id"),
        F.col("first.embedding").alias("seed_embedding"),
    )
    distance = vectors.euclidean(
        vectors.entries("embedding", EMBEDDING_DIM), vectors.entries("seed_embedding", EMBEDDING_DIM)
    )

    def with_distance(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("distance", F.expr(distance))

    best = recommend.nearest_in_group(rows, chosen, "label", with_distance, "vec_id", TOP)
    return best.select("label", "seed_id", "rank", "vec_id", _round("distance"))


QUERIES = {
    f.__name__: f
    for f in (
        top_items_by_year, top_groups_by_year, top_items_deep, top_by_year_spine, top_by_year_document,
        top_by_year_json, display_items, csv_roundtrip, csv_data_rows, csv_table_roundtrip,
        safe_casts, clean_bytes, zip_records, ingest_limit, ingest_status, file_inventory, hidden_files,
        valid_items, feature_stats, zscore, assign_nearest, wssse, cluster_sizes, assign_items,
        lloyd_steps, cluster_report, kmeans_fit, model_tables, clustered_scan,
        nearest_of_any_vector, batch_of_all, batch_of_all_near, batch_deep, renamed_batch, extract_limited,
        clustered_text, recommend_json, cluster_order,
        clustered_csv_scan, clustered_csv_seed, clustered_lookup, title_search, find_by_title, find_by_id, find_random,
        recommend_euclidean, recommend_book, recommend_document, item_distances,
        candidate_counts, recommend_batch, nearest_embeddings,
    )
}
