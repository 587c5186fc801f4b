"""Item tables: delimited text files and directories, clustered tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.functions import casts, csvlines
from nearkin.functions.once import computed_once
from nearkin.schema import CLUSTERED_SCHEMA, SONG_SCHEMA, SONGS
from nearkin.sources.scratch import scratch_path

CSV_HEADER_LINE_END = "\r\n"
# The folders of clustered text; the cluster is in the lines, too.
IN_CLUSTER = "in_cluster"
ROW_GROUP_BYTES = 32 << 20
LISTING_PAGE = 10_000
LISTING = "path string, length long, modificationTime timestamp"


def parse_lines(
    lines: DataFrame, schema: T.StructType, value: str = "value", header: str | None = None
) -> DataFrame:
    """Lines to rows of text columns; headers and lines that are too short go.

    A header is a line whose first field is ``header``, by default the name of
    the first column. Other columns of ``lines`` are kept in front. The split
    is unfolded with ``inline``, which keeps the optimizer from repeating it in
    every expression that uses a field.
    """
    names = schema.fieldNames()
    others = [F.col(name) for name in lines.columns if name != value]
    line = F.col(value)
    split = lines.select(
        *others, line.alias("_line"), F.inline(F.array(csvlines.split_line(line, len(names))))
    )
    fields = [F.col(f"_{i}") for i in range(len(names))]
    marker = names[0] if header is None else header
    kept = split.filter(csvlines.is_data_line(F.col("_line"), fields, marker))
    texts = [csvlines.field_text(f).alias(name) for f, name in zip(fields, names, strict=True)]
    return kept.select(*others, *texts)


def typed(rows: DataFrame, schema: T.StructType, fixed: Sequence[str] = ()) -> DataFrame:
    """Text columns to the types of ``schema`` with the forgiving casts.

    Only the columns that are read are cast. Those named in ``fixed`` are always
    cast, and come last; a filter on one of them does not repeat its cast.
    """
    names = schema.fieldNames()
    numeric = [n for n in names if isinstance(schema[n].dataType, T.NumericType)]
    whole = [n for n in names if isinstance(schema[n].dataType, T.IntegralType)]
    floats = rows.select(
        *[
            casts.safe_float(F.col(name)).alias(name) if name in numeric else F.col(name)
            for name in rows.columns
        ]
    )
    columns = [
        casts.cut_to_int(F.col(name)).alias(name) if name in whole else F.col(name)
        for name in rows.columns
    ]
    cast = floats.select(*columns)
    return computed_once(cast, *fixed) if fixed else cast


def read_items(spark: SparkSession, path: str, schema: T.StructType = SONG_SCHEMA) -> DataFrame:
    """Scan delimited text: a file, a directory or any URI Spark can open."""
    return typed(parse_lines(spark.read.text(path), schema), schema)


def read_clustered(
    spark: SparkSession, path: str, format: str = "parquet", schema: T.StructType = CLUSTERED_SCHEMA
) -> DataFrame:
    """Scan the output of :func:`write_clustered`.

    Both forms have a folder per cluster, so that a filter on the cluster opens
    only the files of that cluster. Text without such folders is read as it is.
    """
    if format == "parquet":
        return spark.read.parquet(path)
    if format == "csv":
        rows = read_items(spark, path, schema)
        if IN_CLUSTER not in rows.columns:
            return rows
        cluster = schema.fieldNames()[-1]
        return rows.withColumn(cluster, F.col(IN_CLUSTER).cast(schema[cluster].dataType)).drop(IN_CLUSTER)
    raise ValueError(f"unknown format {format!r}")


def refuse_existing(spark: SparkSession, path: str, overwrite: bool = False) -> None:
    """Raise FileExistsError if the target is there; called before any work."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not overwrite and store.exists(target):
        raise FileExistsError(f"{path} exists; pass overwrite=True to replace it")


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def _csv_text(df: DataFrame) -> list[Column]:
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(F.isnan(column), F.lit("nan")).otherwise(column.cast("string"))
        columns.append(column.cast("string").alias(field.name))
    return columns


def write_items(
    df: DataFrame, path: str, overwrite: bool = False, header: bool = True, folders: str | None = None
) -> None:
    """Write delimited text with a header per part file; missing numbers as ``nan``.

    ``folders`` names a column (which stays in the lines) of which every value gets
    a folder. Fails if the target exists unless ``overwrite`` is set. The table must
    not be read from ``path`` itself.
    """
    options = dict(csvlines.WRITE_OPTIONS, header=str(header).lower(), lineSep=CSV_HEADER_LINE_END)
    columns = _csv_text(df)
    if folders is not None:
        columns.append(F.col(folders).alias(IN_CLUSTER))
    writer = df.select(*columns).write.mode(_mode(overwrite)).options(**options)
    if folders is not None:
        writer = writer.partitionBy(IN_CLUSTER)
    writer.csv(path)


def write_clustered(
    df: DataFrame,
    path: str,
    overwrite: bool = False,
    format: str = "parquet",
    cluster: str = "cluster",
    rebalance: bool = True,
    item_id: str = SONGS.id,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Write the assigned table, as parquet or as text, in a folder per cluster.

    The rows are first brought together by cluster (a rebalance hint): the adaptive
    planner splits a big cluster over many tasks and files and joins small ones, where
    otherwise every task would write a small file per cluster.

    In parquet every file is sorted by ``item_id`` and its row groups have a Bloom
    filter on it, so that a lookup by id skips the files and row groups that cannot
    hold it. The text form has no header and the cluster as last column of the line;
    its folders are named after ``IN_CLUSTER``.
    """
    rows = df.hint("rebalance", F.col(cluster)) if rebalance else df
    if format == "parquet":
        options = {"parquet.block.size": str(row_group_bytes)}
        if item_id in df.columns:
            rows = rows.sortWithinPartitions(cluster, item_id)
            options[f"parquet.bloom.filter.enabled#{item_id}"] = "true"
        rows.write.mode(_mode(overwrite)).options(**options).partitionBy(cluster).parquet(path)
    elif format == "csv":
        others = [name for name in rows.columns if name != cluster]
        write_items(rows.select(*others, cluster), path, overwrite, header=False, folders=cluster)
    else:
        raise ValueError(f"unknown format {format!r}")


def write_json(documents: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write documents as JSON, one per line; text is kept as it is, NULL fields too."""
    documents.write.mode(_mode(overwrite)).option("ignoreNullFields", "false").json(path)


def write_document(document: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write a single JSON text (one row, one column)."""
    document.coalesce(1).write.mode(_mode(overwrite)).text(path)


def only_files(files: DataFrame, root: str, suffix: str) -> DataFrame:
    """Rows whose ``path`` has the suffix, upper and lower case alike, or is
    ``root`` itself (a file, given by its absolute path)."""
    scheme = "^[A-Za-z0-9+.-]+:(//[^/]*)?(?=/)"
    wanted = F.endswith(F.lower("path"), F.lit(suffix.lower()))
    itself = F.regexp_replace("path", scheme, "") == re.sub(scheme, "", root)
    return files.filter(wanted | itself)


def list_files(spark: SparkSession, root: str, suffix: str = ".h5") -> DataFrame:
    """path, length and modification time of a file or of the files below a folder.

    Contents are not read. Names that begin with ``_`` or ``.`` are listed like all
    others. The store's own recursive listing is read in pages, each written to the
    scratch folder, so that the driver never holds more than one page.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(target, True)
    folder = scratch_path(spark, "listing")
    page: list[tuple] = []

    def turn_page() -> None:
        rows = spark.createDataFrame(page, "path string, length long, at long").coalesce(1)
        listed = rows.select("path", "length", F.timestamp_millis("at").alias("modificationTime"))
        only_files(listed, target.toUri().getPath(), suffix).write.mode("append").parquet(folder)
        page.clear()

    while found.hasNext():
        file = found.next()
        page.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
        if len(page) == LISTING_PAGE:
            turn_page()
    turn_page()
    return spark.read.schema(LISTING).parquet(folder).orderBy("path")
