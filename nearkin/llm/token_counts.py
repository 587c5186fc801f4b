"""Operator 1: token counts by a two-tier lookup on the map side.

A first pass counts chunks of pre-tokens over all texts with a bounded counter
per task. The most frequent ones, encoded once, form a compact table (chunks
and lengths) of bounded size that is broadcast. The second pass adds up lengths:
frequent chunks come from the table, the others from a cache in the worker that
the tokenizer fills. No pre-token is ever shuffled; only the bounded counters of
the first pass meet.

Defined results: a NULL or empty text has 0 bytes and 0 tokens; repeated rows
are counted each; an empty table gives an empty result; other columns are
ignored. Texts are never cut short.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm import tokenizer_files
from nearkin.llm.common import slices
from nearkin.llm.pretokens import LONGEST_KEPT, Irregular, Memo, fast_chunks, is_regular, safe_chunks, values_of

#: Chunks that a task's counter holds, hands on, and that the broadcast table holds.
COUNTER_SIZE = 200_000
PER_TASK = 16_384
TABLE_SIZE = 65_536

_SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def _chunks(text: str) -> list[str]:
    try:
        return fast_chunks(text)
    except Irregular:
        return safe_chunks(text)


def frequent_chunks(
    docs: DataFrame, text: str = "text", table_size: int = TABLE_SIZE, per_task: int = PER_TASK
) -> DataFrame:
    """The most frequent chunks over all texts: chunk, n.

    Every task keeps a lossy counter (when it overflows, all counts go down by
    the median and what reaches 0 leaves), so counts are lower bounds. They
    decide only what is cached, never a result.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[str] = Counter()
        for batch in slices(batches, text):
            for value in batch.column(text).to_pylist():
                if value:
                    counter.update(_chunks(value))
            if len(counter) > COUNTER_SIZE:
                floor = int(np.median(np.fromiter(counter.values(), np.int64, len(counter))))
                counter = Counter({k: v - floor for k, v in counter.items() if v > floor})
        top = [(k, v) for k, v in counter.most_common(per_task) if 0 < len(k) <= LONGEST_KEPT]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in top], pa.string()), pa.array([v for _, v in top], pa.int64())],
            names=["chunk", "n"],
        )

    counted = docs.select(text).mapInArrow(count, "chunk string, n long")
    summed = counted.groupBy("chunk").agg(F.sum("n").alias("n"))
    return summed.orderBy(F.desc("n"), "chunk").limit(table_size)


class Lengths(dict):
    """The frequent tier; what it lacks is asked of the worker's cache."""

    def __init__(self, chunks: list[str], lengths: bytes, cache: Memo):
        super().__init__(zip(chunks, np.frombuffer(lengths, "<u2").tolist(), strict=True))
        self.cache = cache

    def __missing__(self, key: str) -> int:
        return self.cache[key]


_tables: dict[str, Lengths] = {}


def _lengths(key: str, packed, path: str, pattern: str) -> Lengths:
    if key not in _tables:
        _tables.clear()
        tokenizer = tokenizer_files.load(path, pattern)
        cache = Memo(lambda c: len(tokenizer.chunk(c)) // 4, tokenizer_files.KEPT_CHUNKS, check=True)
        _tables[key] = Lengths(*packed.value, cache)
    return _tables[key]


def token_counts(
    docs: DataFrame,
    path: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    table_size: int = TABLE_SIZE,
) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every text under the tokenizer file ``path``."""
    spark = docs.sparkSession
    tokenizer = tokenizer_files.load(path, pattern)
    # At most table_size short texts come to the driver.
    frequent = [r["chunk"] for r in frequent_chunks(docs, text, table_size).collect()]
    frequent = [c for c in frequent if is_regular(c)]
    lengths = np.array([len(tokenizer.chunk(c)) // 4 for c in frequent], "<u2")
    packed = spark.sparkContext.broadcast((frequent, lengths.tobytes()))
    name = uuid.uuid4().hex

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_files.load(path, pattern)
        table = _lengths(name, packed, path, pattern)

        def direct(chunk: str) -> int:
            return len(tokenizer.chunk(chunk)) // 4

        for batch in slices(batches, "text"):
            column = batch.column("text")
            counts = [
                0
                if not value
                else len(tokenizer.library_ids(value))
                if tokenizer.has_added(value)
                else sum(values_of(value, table, direct))
                for value in column.to_pylist()
            ]
            n_bytes = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), n_bytes, pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(count, _SCHEMA)
