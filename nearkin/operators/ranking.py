"""Top-N rankings per group, and their nested documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nearkin.functions import casts
from nearkin.functions.vectors import quoted, unused
from nearkin.schema import DEFAULT_TOP, DEFAULT_YEARS, SONGS, ItemColumns


def in_years(df: DataFrame, year: str, first: int, last: int) -> DataFrame:
    """Rows whose year lies in the range, both ends included."""
    return df.filter(casts.in_range(df, year, first, last))


def artist_rows(df: DataFrame, columns: ItemColumns = SONGS) -> DataFrame:
    """The four columns that describe a maker in a year."""
    return df.select(
        F.col(columns.maker_id),
        F.col(columns.maker_name),
        casts.number(df, columns.maker_popularity).alias(columns.maker_popularity),
        casts.whole_number(df, columns.year).alias(columns.year),
    )


def song_rows(df: DataFrame, columns: ItemColumns = SONGS) -> DataFrame:
    """The five columns that describe an item in a year."""
    return df.select(
        F.col(columns.id),
        F.col(columns.name),
        casts.number(df, columns.popularity).alias(columns.popularity),
        casts.whole_number(df, columns.year).alias(columns.year),
        F.col(columns.maker_name),
    )


# The planner keeps the first rows of a window before a shuffle up to this rank.
WINDOW_LIMIT = 1000
# Bins of the popularity histogram: the upper half of a group, the upper quarter, ...
HALVINGS = 13
BITMAP_BITS = 1 << 15


def popularity_cut(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """group, _least: a value at or above which the group surely has ``n`` distinct rows.

    A histogram from above: the bins of a group end at its median, its upper quarter,
    eighth and so on. The distinct rows of a bin are counted by a bitmap of their
    hashes, made in the tasks; two rows on one bit count as one, so there are never
    fewer than counted. Groups with fewer than ``n`` rows counted have no row here.
    A task sends a bitmap of 4 KB at most per group and bin, and as many times that
    as ``n`` fills.
    """
    fractions = ", ".join(str(1.0 - 2.0**-k) for k in range(HALVINGS + 1))
    edges = F.expr(f"percentile_approx({quoted(value)}, array({fractions}), {1 << (HALVINGS + 1)})")
    # One row per group; groups are the years asked for.
    cuts = F.broadcast(df.groupBy(F.col(group).alias("_of")).agg(edges.alias("_edges")))
    names = [F.col(quoted(name)) for name in df.columns]
    place = F.pmod(F.xxhash64(*names), F.lit(BITMAP_BITS * -(-4 * n // BITMAP_BITS)))
    hashed = df.select(F.col(group), F.col(value).alias("_value"), place.alias("_place"))
    joined = hashed.join(cuts, F.col(group).eqNullSafe(F.col("_of")))
    bin_of = sum((F.col("_value") >= F.get("_edges", F.lit(k))).cast("int") for k in range(HALVINGS + 1))
    binned = joined.select("_of", "_edges", bin_of.alias("_bin"), "_place").filter(F.col("_bin") > 0)
    bits = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("_place")))
    counted = binned.groupBy("_of", "_edges", "_bin", F.bitmap_bucket_number("_place")).agg(bits.alias("_n"))
    sums = counted.groupBy("_of", "_edges", "_bin").agg(F.sum("_n").alias("_n"))
    above = F.sum("_n").over(W.partitionBy("_of").orderBy(F.desc("_bin")))
    enough = sums.withColumn("_above", above).filter(F.col("_above") >= n)
    return enough.groupBy("_of").agg(F.max(F.get("_edges", F.col("_bin") - 1)).alias("_least"))


def above_cut(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """The rows that can be among the first ``n`` distinct ones of their group by ``value``."""
    cuts = F.broadcast(popularity_cut(df, group, value, n))
    joined = df.join(cuts, F.col(group).eqNullSafe(F.col("_of")), "left")
    return joined.filter(F.col("_least").isNull() | (F.col(value) >= F.col("_least"))).select(*df.columns)


def top_distinct(
    df: DataFrame, group: str, order: Sequence[Column], n: int, value: str | None = None
) -> DataFrame:
    """The first ``n`` distinct rows of every group, with ``rank`` from 1.

    ``order`` must cover all columns but ``group``, so that equal places in the
    order are equal rows. ``value`` is the column that comes first in it, downwards,
    if that is a number.

    Up to ``WINDOW_LIMIT`` places the planner cuts before the shuffle; beyond it,
    rows below :func:`popularity_cut` go first. Every input partition first keeps its own first ``n`` distinct rows per
    group (dense rank, before any shuffle). What is left meets per group and
    slice of input partitions, so that neither a group with a third of all rows
    nor a row with that many copies lands in one task. Copies are dropped then,
    and the last ranking sees at most slices x n rows per group.
    """
    if n > WINDOW_LIMIT and value is not None:
        overall = W.partitionBy(group).orderBy(*order)
        few = above_cut(df, group, value, n).distinct()
        return few.withColumn("rank", F.row_number().over(overall)).filter(F.col("rank") <= n)
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, place = unused(df, "_slice"), unused(df, "_place")
    sliced = df.withColumn(part, F.pmod(F.spark_partition_id(), F.lit(slices)))
    local = W.partitionBy(group, part).orderBy(*order)
    survivors = (
        sliced.withColumn(place, F.dense_rank().over(local))
        .filter(F.col(place) <= n)
        .drop(place, part)
        .distinct()
    )
    overall = W.partitionBy(group).orderBy(*order)
    return survivors.withColumn("rank", F.row_number().over(overall)).filter(F.col("rank") <= n)


def top_artists(
    df: DataFrame, first: int, last: int, n: int = DEFAULT_TOP, columns: ItemColumns = SONGS
) -> DataFrame:
    """The ``n`` most popular makers of every year of the range.

    A maker is the whole row: one id with two names or two popularity values
    takes two ranks. Equal popularity is ordered by id, then name.
    """
    popular = df.filter(casts.has_number(df, columns.maker_popularity))
    rows = artist_rows(in_years(popular, columns.year, first, last), columns)
    popularity = F.col(columns.maker_popularity)
    order = [popularity.desc(), F.col(columns.maker_id), F.col(columns.maker_name)]
    return top_distinct(rows, columns.year, order, n, columns.maker_popularity)


def top_songs(
    df: DataFrame, first: int, last: int, n: int = DEFAULT_TOP, columns: ItemColumns = SONGS
) -> DataFrame:
    """The ``n`` most popular items of every year of the range.

    Equal popularity is ordered by id, name and maker.
    """
    popular = df.filter(casts.has_number(df, columns.popularity))
    rows = song_rows(in_years(popular, columns.year, first, last), columns)
    popularity = F.col(columns.popularity)
    order = [
        popularity.desc(),
        F.col(columns.id),
        F.col(columns.name),
        F.col(columns.maker_name),
    ]
    return top_distinct(rows, columns.year, order, n, columns.popularity)


def top_by_year(
    df: DataFrame,
    first: int = DEFAULT_YEARS[0],
    last: int = DEFAULT_YEARS[1],
    n: int = DEFAULT_TOP,
    columns: ItemColumns = SONGS,
) -> tuple[DataFrame, DataFrame]:
    """The two rankings: makers and items."""
    return top_artists(df, first, last, n, columns), top_songs(df, first, last, n, columns)


def year_spine(spark: SparkSession, first: int, last: int, year: str = "year") -> DataFrame:
    """One row per year of the range; none if the range is empty."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias(year))


def on_every_year(
    ranked: DataFrame, first: int, last: int, columns: ItemColumns = SONGS
) -> DataFrame:
    """The ranking with one row of NULLs for each year without any."""
    spine = year_spine(ranked.sparkSession, first, last, columns.year)
    return spine.join(ranked, columns.year, "left")


def _lists(ranked: DataFrame, year: str, name: str, fields: Sequence[Column]) -> DataFrame:
    entry = F.struct(F.col("rank").alias("_rank"), F.struct(*fields).alias("_entry"))
    ordered = F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["_entry"])
    return ranked.groupBy(year).agg(ordered.alias(name))


def year_documents(
    artists: DataFrame, songs: DataFrame, first: int, last: int, columns: ItemColumns = SONGS
) -> DataFrame:
    """One row per year: ``top_artists`` and ``top_songs``, empty where no data.

    Takes the two rankings; the lists hold as many entries as those have per
    year, popularity rounded to 4 digits.
    """
    c = columns
    artist_lists = _lists(
        artists,
        c.year,
        "top_artists",
        [
            F.col(c.maker_id).alias("artist_id"),
            F.col(c.maker_name).alias("artist_name"),
            F.round(c.maker_popularity, 4).alias("hotttnesss"),
        ],
    )
    song_lists = _lists(
        songs,
        c.year,
        "top_songs",
        [
            F.col(c.id).alias("song_id"),
            F.col(c.name).alias("song_name"),
            F.col(c.maker_name).alias("artist_name"),
            F.round(c.popularity, 4).alias("hotttnesss"),
        ],
    )
    spine = year_spine(songs.sparkSession, first, last, c.year)
    joined = spine.join(artist_lists, c.year, "left").join(song_lists, c.year, "left")
    return joined.select(
        F.col(c.year).alias("year"),
        F.coalesce("top_artists", F.array()).alias("top_artists"),
        F.coalesce("top_songs", F.array()).alias("top_songs"),
    )


def top_by_year_document(
    df: DataFrame,
    first: int = DEFAULT_YEARS[0],
    last: int = DEFAULT_YEARS[1],
    n: int = DEFAULT_TOP,
    columns: ItemColumns = SONGS,
) -> DataFrame:
    """:func:`year_documents` of the two rankings of one table."""
    return year_documents(*top_by_year(df, first, last, n, columns), first, last, columns)


def as_one_document(documents: DataFrame) -> DataFrame:
    """All years as one JSON text: year -> {top_artists, top_songs}.

    The size is bounded by years x n entries.
    """
    body = F.struct("top_artists", "top_songs")
    pairs = F.sort_array(F.collect_list(F.struct(F.col("year"), body.alias("body"))))
    whole = F.to_json(F.map_from_entries(pairs), {"ignoreNullFields": "false"})
    return documents.agg(whole.alias("value"))
