"""Nested records: one row per source file, three arrays joined by position.

The input has ``path`` and the arrays of structs ``metadata``, ``analysis`` and
``musicbrainz``. A file yields one item per entry of ``metadata``. Two more
columns may be there: ``first_pos``, the position of the first entry where a
file comes in several rows, and ``problem``, why it could not be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.functions import casts
from nearkin.sources.scratch import kept

# Output column -> (array, field of its structs).
RECORD_FIELDS = {
    "artist_id": ("metadata", "artist_id"),
    "artist_name": ("metadata", "artist_name"),
    "song_id": ("metadata", "song_id"),
    "song_name": ("metadata", "title"),
    "loudness": ("analysis", "loudness"),
    "song_hotttnesss": ("metadata", "song_hotttnesss"),
    "tempo": ("analysis", "tempo"),
    "key_confidence": ("analysis", "key_confidence"),
    "mode_confidence": ("analysis", "mode_confidence"),
    "year": ("musicbrainz", "year"),
    "artist_hotttnesss": ("metadata", "artist_hotttnesss"),
    "duration": ("analysis", "duration"),
}
ARRAYS = ("metadata", "analysis", "musicbrainz")


def with_status(files: DataFrame) -> DataFrame:
    """Add ``status`` (``ok`` or ``failed``), ``error`` and ``n_records``.

    A file fails as a whole if an array is missing or shorter than ``metadata``.
    """
    missing = [F.when(F.col(name).isNull(), F.lit(f"missing {name}")) for name in ARRAYS]
    short = [
        F.when(F.size(name) < F.size("metadata"), F.lit(f"short {name}")) for name in ARRAYS[1:]
    ]
    problem = [F.col("problem")] if "problem" in files.columns else []
    error = F.coalesce(*problem, *missing, *short)
    return files.select(
        "*",
        F.when(error.isNull(), F.lit("ok")).otherwise(F.lit("failed")).alias("status"),
        error.alias("error"),
        F.when(error.isNull(), F.size("metadata")).otherwise(F.lit(0)).alias("n_records"),
    )


def _field(files: DataFrame, array: str, field: str) -> tuple[Column, T.DataType]:
    dtype = files.schema[array].dataType.elementType[field].dataType
    return F.col("_entry").getField(array).getField(field), dtype


def _as_number(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.NumericType):
        return F.coalesce(value.cast("double"), F.lit(casts.NAN))
    return casts.safe_float(value.cast("string"))


def zip_records(files: DataFrame) -> DataFrame:
    """One row per record of the readable files: path, pos and the item columns.

    The arrays are zipped inside the row, so nothing is shuffled.
    """
    readable = with_status(files).filter(F.col("status") == "ok")
    n = F.size("metadata")
    zipped = F.arrays_zip(
        F.col("metadata"), *[F.slice(F.col(a), F.lit(1), n).alias(a) for a in ARRAYS[1:]]
    )
    first = F.col("first_pos") if "first_pos" in files.columns else F.lit(0)
    rows = readable.select(
        "path", first.cast("bigint").alias("_first"), F.posexplode(zipped).alias("pos", "_entry")
    )
    columns = []
    for name, (array, field) in RECORD_FIELDS.items():
        value, dtype = _field(files, array, field)
        if name == "year":
            value = casts.cut_to_int(_as_number(value, dtype))
        elif name.endswith(("_id", "_name")):
            value = casts.as_text(value, dtype)
        else:
            value = _as_number(value, dtype)
        columns.append(value.alias(name))
    return rows.select("path", (F.col("_first") + F.col("pos")).alias("pos"), *columns)


def _place(name: str = "path") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def find_cut(files: DataFrame, limit: int) -> tuple[str, int] | None:
    """Path and position of the ``limit``-th record; None if there are fewer.

    Records are counted, not sorted: path and number of records of every file are
    written once and dealt out by ranges of the path, the sums of the ranges are
    added up on the driver (one number per range), and only the range that holds the
    cut is added up file by file.
    """
    first = F.col("first_pos") if "first_pos" in files.columns else F.lit(0)
    counted = with_status(files).filter("n_records > 0").select(
        _place().alias("path"), first.cast("bigint").alias("first"), F.col("n_records").cast("bigint").alias("n")
    )
    ranges = kept(kept(counted).repartitionByRange("path", "first").withColumn("part", F.spark_partition_id()))
    before = 0
    for part, n in sorted(map(tuple, ranges.groupBy("part").agg(F.sum("n")).collect())):
        if before + n >= limit:
            order = W.orderBy("path", "first").rowsBetween(W.unboundedPreceding, W.currentRow)
            sums = ranges.filter(F.col("part") == part).withColumn("until", F.sum("n").over(order) + before)
            cut = sums.filter(F.col("until") >= limit).orderBy("until").limit(1).first()
            return cut["path"], cut["first"] + cut["n"] - 1 - (cut["until"] - limit)
        before += n
    return None


def files_until(files: DataFrame, cut: tuple[str, int] | None) -> DataFrame:
    """The files up to the one with the cut; the condition reaches the scan."""
    if cut is None:
        return files
    return files.filter(F.col("path").isNull() | (F.col("path") <= cut[0]))


def records_until(files: DataFrame, cut: tuple[str, int] | None) -> DataFrame:
    """:func:`zip_records` of the files up to the cut, the record there included."""
    rows = zip_records(files_until(files, cut))
    if cut is None:
        return rows
    return rows.filter((_place() < cut[0]) | (F.col("pos") <= cut[1]))


def extract_records(files: DataFrame, limit: int = 0, require_rows: bool = False) -> DataFrame:
    """The item rows of all readable files; the first ``limit`` of them if > 0.

    First means by path, then by position; a path (with its ``first_pos``) stands
    for one row of ``files``. A limit starts a job that counts the records per
    file; files behind the cut are not unfolded. With ``require_rows`` an empty
    result is an error; this starts a job that stops at the first row.
    """
    cut = find_cut(files, limit) if limit > 0 else None
    items = records_until(files, cut).drop("path", "pos")
    if require_rows and items.isEmpty():
        raise ValueError("no records read")
    return items


def ingest_report(files: DataFrame) -> DataFrame:
    """Per status: number of files and of records."""
    rows = with_status(files).select("path", "status", "n_records")
    if "first_pos" in files.columns:
        # A file in several rows counts once, and as failed if one of them did.
        rows = rows.groupBy("path").agg(
            F.min("status").alias("status"), F.sum("n_records").alias("n_records")
        )
    return rows.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_records").alias("n_records")
    )
