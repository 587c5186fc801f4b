"""Operator 8: token ids in ORC files, written in the order of the documents.

The texts are range-partitioned and sorted by document id, encoded, and written
as ORC: the writer run-length encodes the integers of every stripe and adds row
indexes and Bloom filters on the document id. Every row also holds the number of
its ids and of the ids before it in its file, so that places in the whole
sequence follow from the small columns and one sum per file. A read is split by
stripes; a filter on document ids is pushed to the footer, the row indexes and
the Bloom filters, and reads only the row groups that can hold them.

Defined results: a NULL or empty text has the end id alone; rows with the same
document id are ordered by their text; an empty table gives files without rows;
other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nearkin.llm import tokenizer_files
from nearkin.llm.byte_bpe import id_lists
from nearkin.llm.common import shared_folder, shuffles, slices
from nearkin.llm.pretokens import values_of

STRIPE_BYTES = 8 << 20
ROW_GROUP = 1000
BLOOM_FPP = 0.01


def encode_sorted(
    docs: DataFrame, path: str, pattern: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, before (ids before it in its partition), n_tokens, ids; ordered by doc_id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_files.load(path, pattern)
        table = tokenizer_files.id_table(path, pattern)
        end = np.array([end_id], "<u4").tobytes()
        before = 0

        for batch in slices(batches, "text"):
            packed = []
            for value in batch.column("text").to_pylist():
                if value and tokenizer.has_added(value):
                    ids = np.array(tokenizer.library_ids(value), "<u4").tobytes()
                else:
                    ids = b"".join(values_of(value, table, tokenizer.chunk)) if value else b""
                packed.append(ids + end)
            counts = np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed))
            places = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(places), pa.array(counts), id_lists(packed)],
                names=["doc_id", "before", "n_tokens", "ids"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(shuffles(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, "doc_id long, before long, n_tokens long, ids array<int>")


def write_tokens(
    docs: DataFrame, target: str, path: str, pattern: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Write the ids of all texts as ORC files below ``target``, which must not exist.

    One file per partition, whatever limit of records the session sets for files:
    the places in a file are counted from its partition's start.
    """
    encoded = encode_sorted(docs, path, pattern, end_id, doc_id, text)
    options = {
        "compression": "zstd",
        "orc.stripe.size": str(STRIPE_BYTES),
        "orc.create.index": "true",
        "orc.row.index.stride": str(ROW_GROUP),
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": str(BLOOM_FPP),
        "maxRecordsPerFile": "0",
    }
    encoded.write.options(**options).orc(target)


def read_tokens(spark: SparkSession, target: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """doc_id, before, n_tokens, ids as written; on request only some documents."""
    schema = "doc_id long, before long, n_tokens long, ids array<int>"
    rows = spark.read.schema(schema).orc(target)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(*doc_ids))


def file_starts(spark: SparkSession, target: str) -> DataFrame:
    """file, file_start: the number of ids in all files before it.

    Reads the small columns only. The last window sees one row per file.
    """
    rows = read_tokens(spark, target).select(
        F.col("_metadata.file_path").alias("file"), "doc_id", (F.col("before") + F.col("n_tokens")).alias("after")
    )
    files = rows.groupBy("file").agg(F.min("doc_id").alias("first"), F.max("after").alias("n"))
    earlier = W.orderBy(F.col("first").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("file_start"))


def _checksums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy()
        flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        sums = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in ("file", "doc_id", "before", "n_tokens")), pa.array(sums, pa.int64())],
            names=["file", "doc_id", "before", "n_tokens", "ids_crc32"],
        )


def token_places(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    rows = read_tokens(spark, target).select(
        F.col("_metadata.file_path").alias("file"), "doc_id", "before", "n_tokens", "ids"
    )
    summed = rows.mapInArrow(
        _checksums, "file string, doc_id long, before long, n_tokens long, ids_crc32 long"
    )
    placed = summed.join(file_starts(spark, target), "file")
    start = (F.col("file_start") + F.col("before")).alias("start")
    return placed.select("doc_id", start, "n_tokens", "ids_crc32")


def written_and_read(docs: DataFrame, path: str, pattern: str, end_id: int) -> DataFrame:
    """:func:`token_places` of files written to a new place in the shared folder."""
    target = f"{shared_folder(docs.sparkSession)}/token-ids-{uuid.uuid4().hex}"
    write_tokens(docs, target, path, pattern, end_id)
    return token_places(docs.sparkSession, target)
