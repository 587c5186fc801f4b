"""Windows that also start earlier in the corpus: the exchange behind operators 4 and 7.

Documents are dealt into groups of bounded size, near copies together. Three
rounds follow; in each, every group works on its own texts, and what must be
compared across groups goes through buckets of a hash space as sorted, packed
keys, of which a group sends every distinct one once. So neither a string with a
third of all places nor a large group of copies meets in one task.

1. Anchors: the operator names places of every text and a key for each. A bucket
   tells which keys occur again somewhere.
2. Windows: those that reach an anchor which occurs again are sorted by key, one
   bucket at a time. A bucket tells each group which of its keys start in an
   earlier document of another group.
3. Every group marks its windows and hands the marked stretches to the operator.

What comes back from a bucket is one bit per key, in the order they were sent;
the group works its keys out again, so that nothing else need be kept. Exact
copies of whole texts are found first and take no part.

An order "earlier" means a smaller document id, within an id the order of the
texts (rows with one id count as several documents; NULL comes first), within a
text the smaller place.
"""

from __future__ import annotations

import hashlib
import operator
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.functions.once import computed_once
from nearkin.llm import textarrays as ta
from nearkin.llm.common import kept, shuffles, utf8

GROUP_BYTES = 12 << 20
LIKENESS_CHARS = 512
SLICE_BYTES = 2 << 20
ANCHOR_BITS = 40
KEYS_PER_BUCKET = 3_000_000

_COPIES, _ANCHORS, _WINDOWS = 0, 1, 2
_REPLY = "g int, kind int, bucket int, data binary"
_NULL_ID = np.iinfo(np.int64).min
_SIGN = np.uint64(1 << 63)


@dataclass(frozen=True)
class Method:
    """How an operator looks at a text.

    ``read(data, offsets)`` gives a reading of a slice of texts with ``bounds``
    (n + 1 offsets of each text in units), ``anchors()`` -> (places, keys,
    is_reference) and ``keys(places)`` of windows -> (keys, checks); windows are
    equal if both are. An anchor at p may belong to
    the windows that start in [p - reach, p].
    """

    read: Callable
    window: int
    reach: int
    anchors_per_byte: float
    windows_per_byte: float


def groups_of(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, int]:
    """(g, doc_id, text), the ids of later exact copies by group, and the number of groups.

    A text's group follows from the least hash of its runs of words, so that most
    near copies meet in one group, where a window that all of them have counts
    once. What would fill more than an eighth of a group is dealt by document id
    over as many parts. The place of a text has no effect on the result, so the
    hash looks at its beginning only. Where ids repeat, the id alone decides, as
    texts of one id are ordered within their group.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    spark = docs.sparkSession
    likeness = _likeness(rows)
    marks = likeness.select(
        "doc_id", "like", F.md5(F.encode("text", "UTF-8")).alias("mark"), F.octet_length("text").alias("n")
    )
    firsts = marks.groupBy("mark").agg(
        F.min("doc_id").alias("first"),
        F.min("like").alias("like"),
        F.count("*").alias("n_rows"),
        F.sum("n").alias("n_bytes"),
    )
    firsts = kept(firsts)
    total = firsts.agg(F.sum("n_bytes")).first()[0] or 0
    n_groups = max(shuffles(spark), -(-total // GROUP_BYTES))
    if rows.groupBy("doc_id").count().filter("count > 1").isEmpty():
        # Fewer rows than eight for each group, of two numbers.
        part = max(GROUP_BYTES // 8, 1)
        parts = firsts.groupBy("like").agg(F.ceil(F.sum("n_bytes") / part).alias("n_parts")).filter("n_parts > 1")
        # As a local table its size is known, and so the planner broadcasts it.
        parts = spark.createDataFrame(parts.toArrow())
        nth = F.coalesce(F.pmod(F.xxhash64("doc_id"), "n_parts"), F.lit(0))
        g = F.pmod(F.xxhash64("like", nth), F.lit(n_groups)).cast("int").alias("g")
        placed, marks = (df.join(parts, "like", "left") for df in (likeness, marks))
    else:
        g = F.pmod(F.xxhash64("doc_id"), F.lit(n_groups)).cast("int").alias("g")
        placed = rows
    repeated = firsts.filter("n_rows > 1").select("mark", "first")
    copies = marks.join(repeated, "mark").filter(F.col("doc_id") > F.col("first"))
    packed = copies.select(g, "doc_id", F.unhex("mark").alias("mark")).groupBy("g").applyInArrow(_pack_copies, _REPLY)
    return placed.select(g, "doc_id", "text"), kept(packed), n_groups


def _likeness(rows: DataFrame) -> DataFrame:
    """The rows with ``like``: the least hash of three words in a row, of the first hundred words or so."""
    words = rows.withColumn("ws", F.split(F.substring("text", 1, LIKENESS_CHARS), " "))
    words = computed_once(words, "ws")
    runs = F.transform("ws", lambda w, i: F.xxhash64(w, F.get("ws", i + 1), F.get("ws", i + 2)))
    return computed_once(words.select("doc_id", "text", F.array_min(runs).alias("like")), "like")


def _pack_copies(copies: pa.Table) -> pa.Table:
    """The document ids, then the marks of their texts, 16 bytes each."""
    ids = copies["doc_id"].to_numpy().astype("<i8").tobytes()
    return _reply(copies["g"][0].as_py(), _COPIES, 0, ids + b"".join(copies["mark"].to_pylist()))


def _reply(g: int, kind: int, bucket: int, data: bytes) -> pa.Table:
    return pa.table(
        {
            "g": pa.array([g], pa.int32()),
            "kind": pa.array([kind], pa.int32()),
            "bucket": pa.array([bucket], pa.int32()),
            "data": pa.array([data], pa.binary()),
        }
    )


class Group:
    """The texts of one group in order, and what the buckets replied."""

    def __init__(self, docs: pa.Table, replies: pa.Table, method: Method):
        self.method = method
        ids = docs["doc_id"].fill_null(_NULL_ID).to_numpy()
        order = np.argsort(ids, kind="stable")
        repeated_ids = len(np.unique(ids)) < len(ids)
        if repeated_ids:
            texts = docs["text"].to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i])), np.int64)
        self.doc_ids = ids[order]
        self.data, self.offsets = utf8(docs["text"].combine_chunks().take(pa.array(order)))
        self.replies = {
            (row["kind"], row["bucket"]): row["data"] for row in replies.select(["kind", "bucket", "data"]).to_pylist()
        }
        copies = self.replies.get((_COPIES, 0), b"")
        known = np.frombuffer(copies, np.int64, len(copies) // 24)
        self.is_copy = np.isin(self.doc_ids, known)
        if repeated_ids:  # then the id alone does not tell which of its texts is the copy
            marks = {(i, copies[8 * len(known) + 16 * n :][:16]) for n, i in enumerate(known.tolist())}
            for row in np.flatnonzero(self.is_copy).tolist():
                own = self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()
                self.is_copy[row] = (int(self.doc_ids[row]), hashlib.md5(own).digest()) in marks

    def slices(self):
        """(first row, last row, data, offsets) of stretches of texts of bounded size."""
        start, n = 0, len(self.doc_ids)
        while start < n:
            stop = int(np.searchsorted(self.offsets, self.offsets[start] + SLICE_BYTES, side="right")) - 1
            stop = min(max(stop, start + 1), n)
            yield start, stop, self.data[self.offsets[start] : self.offsets[stop]], (
                self.offsets[start : stop + 1] - self.offsets[start]
            )
            start = stop

    def readings(self):
        for start, stop, data, offsets in self.slices():
            yield start, stop, self.method.read(data, offsets)

    def _live(self, start: int, stop: int, bounds: np.ndarray, places: np.ndarray) -> np.ndarray:
        rows = np.searchsorted(bounds, places, side="right") - 1
        return ~self.is_copy[start:stop][rows]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchor keys, and of each: 1 if seen twice here, 2 if a reference."""
        keys, flags = [], []
        for start, stop, reading in self.readings():
            places, found, reference = reading.anchors()
            live = self._live(start, stop, reading.bounds, places)
            keys.append(found[live] >> np.uint64(64 - ANCHOR_BITS))
            flags.append(reference[live])
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        flags = np.concatenate(flags) if flags else np.zeros(0, bool)
        order = np.argsort(keys)
        keys, flags = keys[order], flags[order]
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
        if len(first) == 0:
            return keys, np.zeros(0, np.uint8)
        counts = np.diff(first, append=len(keys))
        return keys[first], (counts > 1).astype(np.uint8) | (np.logical_or.reduceat(flags, first) * np.uint8(2))

    def _bits(self, kind: int, keys: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """The replied bits of ascending keys."""
        result = np.zeros(len(keys), bool)
        cuts = np.searchsorted(keys, edges)
        for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            data = self.replies.get((kind, bucket))
            if data is not None and b > a:
                result[a:b] = np.unpackbits(np.frombuffer(data, np.uint8), count=b - a)
        return result

    def windows(self, n_buckets: int):
        """(start row, stop row, reading, places, keys, checks) of windows that reach an anchor that occurs again."""
        known, _ = self.anchors()
        hit_keys = known[self._bits(_ANCHORS, known, edges(n_buckets, ANCHOR_BITS))]
        for start, stop, reading in self.readings():
            places, found, _ = reading.anchors()
            live = self._live(start, stop, reading.bounds, places)
            places, found = places[live], found[live] >> np.uint64(64 - ANCHOR_BITS)
            at = np.minimum(np.searchsorted(hit_keys, found), max(len(hit_keys) - 1, 0))
            hits = places[hit_keys[at] == found] if len(hit_keys) else places[:0]
            rows = np.searchsorted(reading.bounds, hits, side="right") - 1
            size = int(reading.bounds[-1])
            steps = np.zeros(size + 1, np.int64)
            np.add.at(steps, np.maximum(hits - self.method.reach, reading.bounds[rows]), 1)
            np.add.at(steps, hits + 1, -1)
            chosen = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
            ends = reading.bounds[np.searchsorted(reading.bounds, chosen, side="right")]
            chosen = chosen[chosen + self.method.window <= ends]
            yield start, stop, reading, chosen, *reading.keys(chosen)


def edges(n_buckets: int, bits: int) -> np.ndarray:
    """The n + 1 bounds of equal stretches of a key space."""
    return np.array([(i << bits) // n_buckets if i < n_buckets else min(1 << bits, 2**64 - 1) for i in range(n_buckets + 1)], np.uint64)


def _with_replies(rows: DataFrame, replies: DataFrame, work, schema: str) -> DataFrame:
    return rows.groupBy("g").cogroup(replies.groupBy("g")).applyInArrow(work, schema)


def _send(g: int, keys: np.ndarray, bounds: np.ndarray, extra: Callable) -> pa.Table:
    cuts = np.searchsorted(keys, bounds)
    cuts[-1] = len(keys)
    cells = [(b, int(x), int(y)) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]
    return pa.table(
        {
            "bucket": pa.array([b for b, _, _ in cells], pa.int32()),
            "g": pa.array([g] * len(cells), pa.int32()),
            "keys": pa.array([ta.pack_sorted(keys[x:y]) for _, x, y in cells], pa.binary()),
            "extra": pa.array([extra(x, y) for _, x, y in cells], pa.binary()),
            "ids": pa.array([None] * len(cells), pa.binary()),
            "checks": pa.array([None] * len(cells), pa.binary()),
        }
    )


_SENT = "bucket int, g int, keys binary, extra binary, ids binary, checks binary"


def _gathered(cells: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray]:
    groups = cells["g"].to_pylist()
    keys = [ta.unpack_sorted(k) for k in cells["keys"].to_pylist()]
    source = np.repeat(np.arange(len(keys), dtype=np.int32), [len(k) for k in keys])
    return groups, keys, np.concatenate(keys), source


def _replies(groups: list[int], keys: list[np.ndarray], kind: int, bucket: int, bits: np.ndarray) -> pa.Table:
    ends = np.cumsum([len(k) for k in keys])
    starts = ends - [len(k) for k in keys]
    data = [np.packbits(bits[a:b]).tobytes() for a, b in zip(starts, ends, strict=True)]
    n = len(groups)
    return pa.table(
        {
            "g": pa.array(groups, pa.int32()),
            "kind": pa.array([kind] * n, pa.int32()),
            "bucket": pa.array([bucket] * n, pa.int32()),
            "data": pa.array(data, pa.binary()),
        }
    )


def _anchors_again(cells: pa.Table) -> pa.Table:
    """A key occurs again if it was seen twice and one of those is a reference."""
    groups, keys, every, _ = _gathered(cells)
    flags = np.concatenate([np.frombuffer(e, np.uint8) for e in cells["extra"].to_pylist()])
    order = np.argsort(every, kind="stable")
    first = np.flatnonzero(np.diff(every[order], prepend=~every[order[:1]]) != 0)
    sizes = np.diff(first, append=len(every))
    twice = (sizes > 1) | (np.bitwise_or.reduceat(flags[order], first) & 1 > 0)
    again = twice & (np.bitwise_or.reduceat(flags[order], first) & 2 > 0)
    bits = np.empty(len(every), bool)
    bits[order] = np.repeat(again, sizes)
    return _replies(groups, keys, _ANCHORS, cells["bucket"][0].as_py(), bits)


def _by_key(keys: np.ndarray, checks: np.ndarray, ids: np.ndarray | None = None):
    """The order by key, check and id, else by place; the keys in it; where a window is that before it."""

    def again(order: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, bool]:
        same = np.zeros(len(order), bool)
        same[1:] = ordered[1:] == ordered[:-1]
        at = np.flatnonzero(same)
        same[at] = checks[order[at]] == checks[order[at - 1]]
        return same, bool(same[at].all())

    order = np.argsort(keys, kind="stable") if ids is None else np.lexsort((ids, keys))
    ordered = keys[order]
    same, sure = again(order, ordered)
    if not sure:  # different windows of one key
        order = np.lexsort((checks, keys) if ids is None else (ids, checks, keys))
        same, _ = again(order, ordered)
    return order, ordered, same


def _index_type(n: int):
    """The smallest type that numbers ``n`` things."""
    return np.uint8 if n <= 1 << 8 else np.uint16 if n <= 1 << 16 else np.uint32


def _windows_earlier(cells: pa.Table) -> pa.Table:
    """A group's key starts earlier elsewhere unless the group has its first document."""
    groups, keys, every, _ = _gathered(cells)
    ids = []
    for extra, known in zip(cells["extra"].to_pylist(), cells["ids"].to_pylist(), strict=True):
        known = (ta.unpack_sorted(known) ^ _SIGN).view(np.int64)
        ids.append(known[np.frombuffer(extra, _index_type(len(known)))])
    checks = np.concatenate([np.frombuffer(c, np.uint64) for c in cells["checks"].to_pylist()])
    order, _, again = _by_key(every, checks, np.concatenate(ids))
    bits = np.zeros(len(every), bool)
    bits[order] = again
    return _replies(groups, keys, _WINDOWS, cells["bucket"][0].as_py(), bits)


def _binary(numbers: np.ndarray, cuts: list[int]) -> pa.Array:
    """Stretches of 64-bit numbers as binary values, without a copy."""
    offsets = np.array([8 * c for c in cuts], np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(numbers, "<u8"))]
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, buffers)


def _distinct(group: Group, n_anchor_buckets: int, with_parts: bool = True):
    """All windows of a group: per reading, and the distinct ones with their first place."""
    parts, rows, keys, checks = [], [], [], []
    for start, stop, reading, places, found, checked in group.windows(n_anchor_buckets):
        row = np.searchsorted(reading.bounds, places, side="right") - 1
        if with_parts:
            parts.append((start, stop, reading.bounds, places))
        rows.append((row + start).astype(np.int32))
        keys.append(found)
        checks.append(checked)
    keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    checks = np.concatenate(checks) if checks else np.zeros(0, np.uint64)
    rows = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    order, ordered, again = _by_key(keys, checks)
    return parts, rows, order, ordered, checks, np.flatnonzero(~again)


def marked(
    docs: DataFrame, method: Method, finish: Callable, schema: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``finish(doc_ids, data, offsets, rows)`` for every group, as rows of ``schema``.

    ``rows`` yields per stretch of texts (start row, stop row, bounds in units,
    mask of covered units); a copy is covered wholly if it has a window at all.
    """
    spark = docs.sparkSession
    rows, replies, n_groups = groups_of(docs, doc_id, text)
    total = n_groups * GROUP_BYTES
    least = min(n_groups, shuffles(spark))
    n_anchor = max(least, int(total * method.anchors_per_byte) // KEYS_PER_BUCKET)
    n_window = max(least, int(total * method.windows_per_byte) // KEYS_PER_BUCKET)

    def send_anchors(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if len(docs) == 0:
            return _send(0, np.zeros(0, np.uint64), edges(1, ANCHOR_BITS), None)
        keys, flags = Group(docs, replies, method).anchors()
        return _send(
            docs["g"][0].as_py(), keys, edges(n_anchor, ANCHOR_BITS), lambda a, b: flags[a:b].tobytes()
        )

    def send_windows(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if len(docs) == 0:
            return _send(0, np.zeros(0, np.uint64), edges(1, 64), None)
        group = Group(docs, replies, method)
        owners, order, ordered, checks, first = _distinct(group, n_anchor, with_parts=False)[1:]
        ordered, checks, firsts = ordered[first], checks[order[first]], owners[order[first]]
        del owners, order
        known, places = np.unique(firsts, return_inverse=True)
        g = docs["g"][0].as_py()
        cuts = np.searchsorted(ordered, edges(n_window, 64))
        cuts[-1] = len(first)
        cells = [(b, int(x), int(y)) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]
        packed = []
        for _, x, y in cells:
            used, at = np.unique(places[x:y], return_inverse=True)
            ids = group.doc_ids[known[used]].view(np.uint64) ^ _SIGN
            packed.append((at.astype(_index_type(len(ids))).tobytes(), ta.pack_sorted(ids)))
        return pa.table(
            {
                "bucket": pa.array([b for b, _, _ in cells], pa.int32()),
                "g": pa.array([g] * len(cells), pa.int32()),
                "keys": pa.array([ta.pack_sorted(ordered[x:y]) for _, x, y in cells], pa.binary()),
                "extra": pa.array([p for p, _ in packed], pa.binary()),
                "ids": pa.array([i for _, i in packed], pa.binary()),
                "checks": _binary(checks, [x for _, x, _ in cells] + [len(checks)]),
            }
        )

    def mark(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if len(docs) == 0:
            return finish(np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(1, np.int64), iter(()))
        group = Group(docs, replies, method)
        parts, order, ordered, first = operator.itemgetter(0, 2, 3, 5)(_distinct(group, n_anchor))
        earlier = group._bits(_WINDOWS, ordered[first], edges(n_window, 64))
        flags = np.ones(len(order), bool)
        flags[order[first[~earlier]]] = False

        def stretches():
            at = 0
            for start, stop, bounds, places in parts:
                found = places[flags[at : at + len(places)]]
                at += len(places)
                steps = np.zeros(int(bounds[-1]) + 1, np.int32)
                np.add.at(steps, found, 1)
                np.add.at(steps, found + method.window, -1)
                covered = np.cumsum(steps[:-1]) > 0
                sizes = np.diff(bounds)
                whole = group.is_copy[start:stop] & (sizes >= method.window)
                yield start, stop, bounds, covered | np.repeat(whole, sizes)

        return finish(group.doc_ids, group.data, group.offsets, stretches())

    sent = _with_replies(rows, replies, send_anchors, _SENT)
    replies = replies.unionByName(kept(sent.groupBy("bucket").applyInArrow(_anchors_again, _REPLY)))
    sent = _with_replies(rows, replies, send_windows, _SENT)
    replies = replies.unionByName(kept(sent.groupBy("bucket").applyInArrow(_windows_earlier, _REPLY)))
    return _with_replies(rows, replies, mark, schema)


def ids_back(doc_ids: np.ndarray) -> pa.Array:
    """Document ids as they were, NULL where there was none."""
    return pa.array(doc_ids, pa.int64(), mask=doc_ids == _NULL_ID)
