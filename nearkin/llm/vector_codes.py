"""Vectors as four codes of one byte: product quantization in whole numbers.

Components become floor(1024 * x); a vector is cut into ``PARTS`` parts, each with
a codebook of ``ENTRIES`` entries. A round assigns every part to its nearest
entry (squared distance, ties to the lower index) and moves each entry to the
floor of the mean of its parts; entries without parts stay.

Assignment looks at active entries only: every part keeps its entry and its exact
distance. If that entry stayed where it was, no entry that stayed can have come
nearer, so the part is compared with the moved entries alone. Parts whose entry
moved are compared with all. Rows, codes and distances are written as Parquet in
the shared folder after each round (the round before is then removed), so a lost
executor costs no more than its part of one round. Sums per entry are made in the
tasks; 4 x 256 rows of them come to the driver, and as many entries go out.

Handling of odd rows: a vector that is NULL or empty or has a NULL, NaN or infinite
component goes, and so does one whose length is not the commonest among the
multiples of four (of equally common ones the shortest). Rows without id are
coded, but give start entries only after all others; rows that repeat an id all
count, in the order of their vectors. Fewer than 256 rows give fewer entries.
A whole number beyond +-``limit(length)`` (134,217,727 for 64 components, which is x =
131,072) counts as that, so that every distance fits a LONG; a sum per label that
does not is the largest LONG. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm.common import remove, shared_folder

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LARGEST = 2**63 - 1
EXACT_DOUBLE = 1 << 53

STATE = "vec_id long, label long, v array<int>, code array<int>, gap array<long>"
RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"

Books = tuple[np.ndarray, ...]


def limit(dimension: int) -> int:
    """The largest component: with it, an error is at most 2 ** 62."""
    return min(math.isqrt(2**62 // dimension) // 2, 2**31) - 1


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points from all entries, as int64.

    Through a product of matrices while every number in it is a whole number that
    a double holds exactly, else entry by entry.
    """
    largest = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * points.shape[1] * int(largest) ** 2 < EXACT_DOUBLE:
        p, e = points.astype("float64"), entries.astype("float64")
        own = np.einsum("ij,ij->i", p, p)[:, None] + np.einsum("ij,ij->i", e, e)
        return (own - 2.0 * (p @ e.T)).astype("int64")
    return np.stack([((points - entry) ** 2).sum(axis=1) for entry in entries], axis=1)


def full_scan(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry, lowest index first, and its distance."""
    gaps = squared(points, entries)
    code = gaps.argmin(axis=1)
    return code.astype("int32"), gaps[np.arange(len(points)), code]


def active_scan(
    points: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, gap: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """:func:`full_scan`, given what was nearest before the entries of ``moved`` moved."""
    code, gap = code.copy(), gap.copy()
    stale = moved[code]
    if stale.any():
        code[stale], gap[stale] = full_scan(points[stale], entries)
    still, places = np.flatnonzero(~stale), np.flatnonzero(moved)
    if len(still) and len(places):
        near, new = full_scan(points[still], entries[places])
        near = places[near].astype("int32")
        better = (new < gap[still]) | ((new == gap[still]) & (near < code[still]))
        code[still[better]], gap[still[better]] = near[better], new[better]
    return code, gap


def _matrix(column: pa.Array, width: int, kind: str = "int64") -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype="int32")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).ravel(), kind))


def usable(df: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, v: the rows that are coded, v in whole numbers; no rows if there are none."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    fine = rows.filter((F.size("v") > 0) & (F.size("v") % PARTS == 0) & whole)
    common = fine.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    dimension = common[0]["size"] if common else PARTS
    most = limit(dimension)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(2), dimension, "float64")
            with np.errstate(over="ignore"):
                values = np.clip(np.floor(values * SCALE), -most, most).astype("int32")
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], _lists(values, pa.int32())], names=batch.schema.names)

    alike = fine.filter(F.size("v") == dimension)
    return alike.mapInArrow(run, "vec_id long, label long, v array<int>")


def assigned(rows: DataFrame, books: Books, moved: Sequence[np.ndarray] | None, width: int) -> DataFrame:
    """Rows with the code and the distance of every part; ``moved`` is None in the first round."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(2), PARTS * width)
            code, gap = np.empty((len(values), PARTS), "int32"), np.empty((len(values), PARTS), "int64")
            if moved is not None:
                old, far = _matrix(batch.column(3), PARTS, "int32"), _matrix(batch.column(4), PARTS)
            for p, entries in enumerate(books):
                points = values[:, p * width : (p + 1) * width]
                if moved is None:
                    code[:, p], gap[:, p] = full_scan(points, entries)
                else:
                    code[:, p], gap[:, p] = active_scan(points, entries, moved[p], old[:, p], far[:, p])
            columns = [*batch.columns[:3], _lists(code, pa.int32()), _lists(gap, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "v", "code", "gap"])

    return rows.mapInArrow(run, STATE)


def entry_sums(state: DataFrame, width: int) -> DataFrame:
    """part, entry, n and a sum per component: one row per entry that has parts."""
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, ENTRIES, width), "int64")
        counts = np.zeros((PARTS, ENTRIES), "int64")
        for batch in batches:
            values, code = _matrix(batch.column(0), PARTS * width), _matrix(batch.column(1), PARTS)
            for p in range(PARTS):
                np.add.at(sums[p], code[:, p], values[:, p * width : (p + 1) * width])
                counts[p] += np.bincount(code[:, p], minlength=ENTRIES)
        part, entry = np.nonzero(counts)
        if len(part):
            columns = [part, entry, counts[part, entry], *sums[part, entry].T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns],
                                             names=["part", "entry", "n", *names])

    schema = ", ".join(f"{name} long" for name in ("part", "entry", "n", *names))
    partial = state.select("v", "code").mapInArrow(run, schema)
    return partial.groupBy("part", "entry").agg(*[F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("n", *names)])


def _moved(books: Books, sums: DataFrame) -> tuple[Books, list[np.ndarray]]:
    """The entries at the floor of their means, and which of them are new."""
    new = [entries.copy() for entries in books]
    for part, entry, n, *totals in sums.collect():
        new[part][entry] = [int(total) // int(n) for total in totals]
    return tuple(new), [(a != b).any(axis=1) for a, b in zip(books, new, strict=True)]


def digest(books: Books) -> str:
    """SHA-256 of all components as text, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for entries in books for x in entries.ravel()).encode()).hexdigest()


def codebooks(rows: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Books] | None:
    """The state after the last assignment, and the entries; None without rows."""
    spark = rows.sparkSession
    folder = f"{shared_folder(spark)}/vector-codes-{uuid.uuid4().hex}"

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    state = written(rows, "rows")
    first = state.orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES).select("v").collect()
    if not first:
        remove(spark, folder)
        return None
    start = np.array([r["v"] for r in first], "int64")
    width = start.shape[1] // PARTS
    books: Books = tuple(start[:, p * width : (p + 1) * width] for p in range(PARTS))
    moved, before = None, "rows"
    for turn in range(rounds + 1):
        name = f"round-{turn}"
        state = written(assigned(state, books, moved, width), name)
        remove(spark, f"{folder}/{before}")
        before = name
        if turn < rounds:
            books, moved = _moved(books, entry_sums(state, width))
    return state, books


def coded(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row with a usable vector."""
    made = codebooks(usable(df, vec_id, vector, label))
    if made is None:
        return df.sparkSession.createDataFrame([], RESULT)
    state, books = made
    hexed = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    rows = state.select(
        "vec_id", "label", hexed.alias("code"), F.aggregate("gap", F.lit(0).cast("long"), lambda a, x: a + x).alias("error")
    )
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)"))
    by_label = rows.groupBy(F.col("label").alias("of")).agg(total.cast("long").alias("label_error"))
    joined = rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle_sql(dimension: int = 64, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same by SQL over ``embeddings``, every assignment a scan of all entries."""
    width = dimension // PARTS
    steps = []
    for turn in range(rounds + 1):
        steps.append(f"""
a{turn} AS MATERIALIZED (
  SELECT vec_id, part, min(d * {entries} + entry) AS best
  FROM (SELECT vec_id, part, entry, sum((vals.x - c.x) * (vals.x - c.x))::BIGINT AS d
        FROM vals JOIN c{turn} c USING (part, pos) GROUP BY ALL) GROUP BY ALL)""")
        if turn < rounds:
            steps.append(f"""
m{turn} AS (
  SELECT part, best % {entries} AS entry, pos, sum(x)::BIGINT AS s, count(*) AS n
  FROM a{turn} JOIN vals USING (vec_id, part) GROUP BY ALL),
c{turn + 1} AS MATERIALIZED (
  SELECT part, entry, pos, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM c{turn} LEFT JOIN m{turn} USING (part, entry, pos))""")
    return f"""
WITH usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dimension} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
vals AS MATERIALIZED (
  SELECT vec_id, i // {width} AS part, i % {width} AS pos, v[i + 1] AS x FROM usable, range({dimension}) r(i)),
starts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM usable ORDER BY vec_id LIMIT {entries}),
c0 AS MATERIALIZED (SELECT part, entry, pos, x FROM vals JOIN starts USING (vec_id)),{','.join(steps)},
coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(best % {entries})), 2, '0'), '' ORDER BY part) AS code,
         sum(best // {entries})::BIGINT AS error
  FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
FROM coded JOIN usable USING (vec_id)"""
