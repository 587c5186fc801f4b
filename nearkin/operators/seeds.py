"""Finding the item to start from: by id, by part of the name, at random."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nearkin.functions import casts
from nearkin.functions.vectors import quoted, unused
from nearkin.schema import SONGS, ItemColumns


def total_order(df: DataFrame, columns: ItemColumns = SONGS) -> list[Column]:
    """An order over whole rows: by name and maker, then by all other columns.

    Ids need not be unique; this settles which row stands for one. Columns that
    cannot be ordered (maps) do not count.
    """
    first = [c for c in (columns.name, columns.maker_name) if c in df.columns]
    types = {f.name: f.dataType for f in df.schema.fields}
    others = [c for c in df.columns if c not in first and "map<" not in types[c].simpleString()]
    return [F.col(quoted(name)) for name in first + others]


def find_by_id(df: DataFrame, item_id, columns: ItemColumns = SONGS) -> DataFrame:
    """The item with this id; of several rows the first in :func:`total_order`."""
    found = df.filter(F.col(columns.id) == F.lit(item_id))
    return found.orderBy(*total_order(df, columns)).limit(1)


def first_per_id(df: DataFrame, columns: ItemColumns = SONGS) -> DataFrame:
    """Of the rows of every id the one that :func:`find_by_id` finds.

    Rows without id are none of them: no lookup by id finds one.
    """
    place = unused(df, "_place")
    order = W.partitionBy(columns.id).orderBy(*total_order(df, columns))
    return df.filter(F.col(columns.id).isNotNull()).withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1).drop(place)


def match_title(df: DataFrame, title: str, columns: ItemColumns = SONGS) -> DataFrame:
    """All items whose name holds the fragment."""
    return df.filter(casts.contains_fragment(F.col(columns.name), title))


def find_by_title(df: DataFrame, title: str, columns: ItemColumns = SONGS) -> DataFrame:
    """The item with the smallest id among those whose name holds the fragment.

    Names and ids are scanned now, for the id; the other columns are read by that
    id alone, which the clustered table answers from a few row groups.
    """
    found = match_title(df, title, columns)
    least = found.agg(F.min(columns.id).alias("least")).first()["least"]
    same = F.col(columns.id).isNull() if least is None else F.col(columns.id) == F.lit(least)
    return found.filter(same).orderBy(*total_order(df, columns)).limit(1)


def find_random(df: DataFrame, random_seed: int, columns: ItemColumns = SONGS) -> DataFrame:
    """A random item; the same seed finds the same item on any partitioning.

    Ids are scanned now, the other columns read by the chosen id alone.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(random_seed)), F.col(columns.id).cast("string")))
    chosen = df.agg(F.min(F.struct(key.alias("key"), F.col(columns.id).alias("id"))).alias("least")).first()["least"]
    missing = chosen is None or chosen["id"] is None
    same = F.col(columns.id).isNull() if missing else F.col(columns.id) == F.lit(chosen["id"])
    return df.filter(same).orderBy(*total_order(df, columns)).limit(1)


def find_seed(
    df: DataFrame,
    item_id=None,
    title: str | None = None,
    random_seed: int | None = None,
    columns: ItemColumns = SONGS,
) -> DataFrame:
    """At most one row. The id goes before the title, the title before chance.

    Empty text counts as not given.
    """
    if item_id is not None and item_id != "":
        return find_by_id(df, item_id, columns)
    if title:
        return find_by_title(df, title, columns)
    if random_seed is not None:
        return find_random(df, random_seed, columns)
    raise ValueError("name an item id, a title or a random seed")
