"""Column roles, the song schema and the defaults shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Names, order and types of the item file.
SONG_SCHEMA = T.StructType(
    [
        T.StructField("artist_id", T.StringType()),
        T.StructField("artist_name", T.StringType()),
        T.StructField("song_id", T.StringType()),
        T.StructField("song_name", T.StringType()),
        T.StructField("loudness", T.DoubleType()),
        T.StructField("song_hotttnesss", T.DoubleType()),
        T.StructField("tempo", T.DoubleType()),
        T.StructField("key_confidence", T.DoubleType()),
        T.StructField("mode_confidence", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("artist_hotttnesss", T.DoubleType()),
        T.StructField("duration", T.DoubleType()),
    ]
)
CLUSTERED_SCHEMA = T.StructType(SONG_SCHEMA.fields + [T.StructField("cluster", T.IntegerType())])

# The features that are clustered unless the caller names others.
SONG_FEATURES = ["loudness", "tempo", "key_confidence", "mode_confidence"]

# Defaults of the reports and of the clustering.
DEFAULT_K = 10
DEFAULT_TOP = 10
DEFAULT_MAX_ITER = 100
DEFAULT_SEED = 42
DEFAULT_YEARS = (1990, 1999)


@dataclass(frozen=True)
class ItemColumns:
    """Which column of a table plays which role.

    The defaults name the columns of ``SONG_SCHEMA``; any other table is used by
    naming its own columns. ``extra`` holds (column, digits) pairs that a
    recommendation shows rounded next to the item.
    """

    id: str = "song_id"
    name: str = "song_name"
    popularity: str = "song_hotttnesss"
    maker_id: str = "artist_id"
    maker_name: str = "artist_name"
    maker_popularity: str = "artist_hotttnesss"
    year: str = "year"
    cluster: str = "cluster"
    extra: tuple[tuple[str, int], ...] = (("tempo", 2), ("loudness", 2))


SONGS = ItemColumns()
