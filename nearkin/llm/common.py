"""What the operators of this subpackage share: tables, text columns, scratch."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table, read by Spark whatever store it lies in."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share.

    That is the one the session names. A local master may do without it; then
    the context's checkpoint folder is taken, and set if there is none.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {SETTING} to a folder all executors can reach")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="nearkin-"))
    return spark.sparkContext.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """The table worked out now and cut from its lineage, by a reliable checkpoint.

    The shuffle files behind it go as soon as it is written.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        # The setting counts when a query is made, so this makes it anew.
        return df.select("*").checkpoint()
    finally:
        spark.conf.set(CLEAN_UP, before)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job of this subpackage wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shuffles(spark: SparkSession) -> int:
    """The number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_held: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], object]):
    """What a worker keeps from task to task, made when its key is new.

    That is one thing at a time: a worker serves the stages of a pipeline one after
    the other, and what one has gathered goes before the next one gathers its own.
    """
    if key not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[key] = make()
    return _held[key]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its n + 1 offsets; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``size`` bytes of text, one row at least."""
    for batch in batches:
        if len(batch) == 0:
            continue
        _, offsets = utf8(batch.column(text))
        start = 0
        while start < len(batch):
            stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
            stop = min(max(stop, start + 1), len(batch))
            yield batch.slice(start, stop - start)
            start = stop
