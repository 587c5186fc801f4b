"""Rankings, clusters and similar items over item catalogues, on Spark SQL."""

from nearkin.schema import CLUSTERED_SCHEMA, SONG_FEATURES, SONG_SCHEMA, ItemColumns

__all__ = ["CLUSTERED_SCHEMA", "SONG_FEATURES", "SONG_SCHEMA", "ItemColumns"]
