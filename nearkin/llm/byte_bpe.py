"""Operator 5: byte-level BPE encoding and decoding by recursive DuckDB queries.

Every task runs an in-process DuckDB on its own partition. The distinct
pre-tokens that its cache lacks become rows (word, position, token); a recursive
query joins neighbouring tokens with the merge table, contracts the leftmost pair
of least rank of every word, and goes on with the words that still have a pair.
The ids of a text are those of its pre-tokens in order. Decoding joins the ids
with the vocabulary and aggregates the bytes by position.

Words of over ``LONG_WORD`` bytes take a second query: where no pair with the new
token could have a rank below its own, all occurrences of the least pair are
contracted at once, which gives the same tokens in far fewer steps.

Defined results: NULL and empty texts have no ids; repeated rows are encoded
each; empty tables give empty results; other columns are ignored. Memory is
bounded by the slice of a batch, the cache and the size of the longest text.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm.common import held, slices
from nearkin.llm.pretokens import SIGNS, Memo, is_regular, joined, looked_up

KEPT_WORDS = 300_000
WORDS_PER_QUERY = 60_000
BYTES_PER_QUERY = 600_000
LONG_WORD = 255
USUAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TOKENS_PER_DECODE = 400_000

# A pair is looked up by one number, (left << 32) | right; the least pair of a
# word by (rank << 24) | (position << 12) | position of its right token. A word
# begins at position 0, so that the last token of a word has no greater one behind it.
_CONTRACT = """
WITH RECURSIVE step(w, pos, tok, more) AS (
  SELECT w, pos, tok, true FROM tokens
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT w, pos, tok, (tok::BIGINT << 32) | lead(tok) OVER o AS pair, lead(pos) OVER o AS after
     FROM step WHERE more WINDOW o AS (ORDER BY (w::BIGINT << 12) | pos)),
   least_pairs AS (
     SELECT w, min((m.merged::BIGINT << 24) | (pos::BIGINT << 12) | after) AS best
     FROM pairs JOIN merges m USING (pair) WHERE after > pos GROUP BY w)
   SELECT p.w, pos, CASE WHEN pos = (best >> 12) & 4095 THEN (best >> 24)::INT ELSE tok END, best IS NOT NULL
   FROM pairs p LEFT JOIN least_pairs USING (w)
   WHERE best IS NULL OR pos <> (best & 4095))
)
SELECT w, pos, tok FROM step WHERE NOT more ORDER BY w, pos"""

_CONTRACT_LONG = """
WITH RECURSIVE step(w, pos, tok, more) AS (
  SELECT w, pos, tok, true FROM tokens
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT w, pos, tok, (tok::BIGINT << 32) | lead(tok) OVER o AS pair, row_number() OVER o AS nth
     FROM step WHERE more WINDOW o AS (PARTITION BY w ORDER BY pos)),
   found AS MATERIALIZED (
     SELECT w, nth, merged, alone, min(merged) OVER (PARTITION BY w) AS best
     FROM pairs JOIN merges USING (pair)),
   least_pairs AS (
     SELECT w, nth, merged, alone, nth - row_number() OVER (PARTITION BY w ORDER BY nth) AS run
     FROM found WHERE merged = best),
   -- In a run of overlapping pairs every other one is taken, from the left.
   taken AS MATERIALIZED (
     SELECT w, nth, merged FROM (
       SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY nth) AS in_run,
              row_number() OVER (PARTITION BY w ORDER BY nth) AS in_word
       FROM least_pairs)
     WHERE in_run % 2 = 1 AND (alone OR in_word = 1)),
   words AS (SELECT DISTINCT w FROM taken)
   SELECT p.w, pos, coalesce(t.merged, tok), k.w IS NOT NULL
   FROM pairs p LEFT JOIN taken t ON t.w = p.w AND t.nth = p.nth
        LEFT JOIN taken u ON u.w = p.w AND u.nth = p.nth - 1
        LEFT JOIN words k ON k.w = p.w
   WHERE u.w IS NULL)
)
SELECT w, pos, tok FROM step WHERE NOT more ORDER BY w, pos"""

# The bytes of all sequences in one ordered aggregate; a letter that is no byte ends each of them.
_END = "\u0100"
_DECODE = """
SELECT string_agg(letters, '' ORDER BY pos) AS decoded
FROM ids JOIN vocabulary USING (id)"""


# Characters outside these ranges, in which every character is assigned, are looked at one by one.
_SURE = re.compile("[^\x00-\u0377\u0400-\u052f\u2010-\u205e\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5]")


@lru_cache(maxsize=1)
def unassigned() -> re.Pattern:
    """One character that this Python's Unicode does not assign."""
    points = [p for p in range(sys.maxunicode + 1) if unicodedata.category(chr(p)) == "Cn"]
    ends = [i for i in range(len(points)) if i + 1 == len(points) or points[i + 1] != points[i] + 1]
    ranges, first = [], 0
    for end in ends:
        ranges.append(f"{re.escape(chr(points[first]))}-{re.escape(chr(points[end]))}")
        first = end + 1
    return re.compile(f"[{''.join(ranges)}]")


@lru_cache(maxsize=100_000)
def stand_in(letter: str, pattern: str) -> str:
    """A letter, a digit or a sign, whichever the library joins the character to."""
    import tiktoken

    for known in "a1":
        raw = (known + letter).encode()
        ranks = {bytes([b]): b for b in range(256)} | {raw[:n]: 254 + n for n in range(2, len(raw) + 1)}
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        if len(probe.encode_ordinary(known + letter)) == 1:
            return known
    return "."


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        lines = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in lines}


class Codec:
    """Encoder and decoder of one vocabulary, with a DuckDB of its own."""

    def __init__(self, path: str, pattern: str):
        import duckdb

        self.ranks = read_ranks(path)
        self.find, self.pattern, self.unassigned = regex.compile(pattern), pattern, unassigned()
        # Letters alone, or with a blank in front, are one pre-token.
        first = [way for way in pattern.split("|") if not way.startswith("'")][0]
        self.letters_are_one = first == r" ?\p{L}+"
        # So are signs behind them, where the pattern is the usual one.
        self.signs = SIGNS if pattern == USUAL else ""
        self.words = Memo(self._unknown, KEPT_WORDS)
        self.chunks = Memo(self._unknown, KEPT_WORDS)
        self.byte_rank = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        self._load_tables()

    @staticmethod
    def _unknown(key: str):
        raise KeyError(key)

    def _load_tables(self) -> None:
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        left, right, merged = (np.array(x, np.int64) for x in (left, right, merged))
        # The least rank of any pair that a token can take part in.
        size = max(self.ranks.values()) + 1
        least = np.full(size, np.iinfo(np.int64).max)
        np.minimum.at(least, left, merged)
        np.minimum.at(least, right, merged)
        table = pa.table(
            {
                "pair": (left << 32) | right,
                "merged": merged.astype(np.int32),
                "alone": least[merged] > merged,
            }
        )
        letters = [token.decode("latin-1") for token in self.ranks]
        self.end = size
        numbers = pa.array([*self.ranks.values(), self.end], pa.int32())
        vocabulary = pa.table({"id": numbers, "letters": [*letters, _END]})
        self.db.register("merges_in", table)
        self.db.register("vocabulary_in", vocabulary)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges_in")
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_in")
        self.db.unregister("merges_in")
        self.db.unregister("vocabulary_in")

    def pieces(self, chunk: str) -> list[str]:
        """The matches of the pattern. For characters that this Python's Unicode does
        not assign, stand-ins of the class that the library gives them are matched."""
        if chunk.isascii() or not _SURE.search(chunk):
            if self.letters_are_one:
                word = chunk.rstrip(self.signs) if self.signs else chunk
                if word.isalpha() or (word[:1] == " " and word[1:].isalpha()):
                    return [word, chunk[len(word) :]] if len(word) < len(chunk) else [chunk]
            return self.find.findall(chunk)
        if not self.unassigned.search(chunk):
            return self.find.findall(chunk)
        known = self.unassigned.sub(lambda found: stand_in(found[0], self.pattern), chunk)
        return [chunk[m.start() : m.end()] for m in self.find.finditer(known)]

    def _contract(self, words: list[bytes], query: str) -> list[bytes]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        tokens = pa.table(
            {
                "w": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
                "pos": (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.int32),
                "tok": self.byte_rank[data],
            }
        )
        self.db.register("tokens", tokens)
        done = self.db.sql(query).to_arrow_table()
        self.db.unregister("tokens")
        ids = done["tok"].to_numpy().astype("<u4")
        counts = np.bincount(done["w"].to_numpy(), minlength=len(words))
        ends = np.cumsum(counts) * 4
        packed = ids.tobytes()
        return [packed[e - 4 * n : e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Packed ids of distinct pre-tokens. Those that are a token as a whole are it."""
        result: dict[str, bytes] = {}
        groups: dict[str, list[tuple[str, bytes]]] = {_CONTRACT: [], _CONTRACT_LONG: []}
        for word in words:
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                result[word] = rank.to_bytes(4, "little")
            else:
                groups[_CONTRACT if len(raw) <= LONG_WORD else _CONTRACT_LONG].append((word, raw))
        for query, group in groups.items():
            start = 0
            while start < len(group):
                stop, size = start, 0
                while stop < len(group) and stop - start < WORDS_PER_QUERY and size < BYTES_PER_QUERY:
                    size += len(group[stop][1])
                    stop += 1
                packed = self._contract([raw for _, raw in group[start:stop]], query)
                result.update(zip((word for word, _ in group[start:stop]), packed, strict=True))
                start = stop
        return result

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, packed as little-endian 32-bit integers."""
        rows, regular, others = looked_up(texts, self.chunks)
        # The ids of a chunk are never empty.
        before = self.chunks.old.get
        values = {chunk: before(chunk) for chunk in regular | others}
        missing = {chunk: self.pieces(chunk) for chunk, value in values.items() if value is None}
        pieces = set(chain.from_iterable(missing.values()))
        known, before = self.words.get, self.words.old.get
        words = {piece: known(piece) or before(piece) for piece in pieces}
        new = self.encode_words([word for word, value in words.items() if value is None])
        words.update(new)
        for word, value in new.items():
            self.words.keep(word, value)
        for chunk, found in missing.items():
            values[chunk] = words[found[0]] if len(found) == 1 else b"".join([words[piece] for piece in found])
        for chunk, value in values.items():
            if chunk in regular or is_regular(chunk):
                self.chunks.keep(chunk, value)
        return joined(rows, values)

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """The bytes of each sequence of ids."""
        result = []
        start = 0
        while start < len(packed):
            stop, size = start, 0
            while stop < len(packed) and (stop == start or size + len(packed[stop]) // 4 <= TOKENS_PER_DECODE):
                size += len(packed[stop]) // 4
                stop += 1
            result += self._decode(packed[start:stop])
            start = stop
        return result

    def _decode(self, packed: list[bytes]) -> list[bytes]:
        end = np.array([self.end], "<u4").tobytes()
        ids = np.frombuffer(end.join(packed), "<u4").astype(np.int32)
        self.db.register("ids", pa.table({"pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
        decoded = self.db.sql(_DECODE).fetchall()[0][0] or ""
        self.db.unregister("ids")
        return [letters.encode("latin-1") for letters in decoded.split(_END)]


def codec(path: str, pattern: str) -> Codec:
    return held(("codec", path, pattern), lambda: Codec(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in slices(batches, "text"):
            packed = own.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), id_lists(packed)], names=["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def id_lists(packed: list[bytes]) -> pa.Array:
    """Packed ids as a list array of 32-bit integers."""
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def packed_ids(column: pa.Array) -> list[bytes]:
    """A list array of 32-bit integers as packed ids; NULL counts as empty."""
    if column.null_count:
        column = pa.array([x or [] for x in column.to_pylist()], column.type)
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype("<u4")
    return [flat[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def decode(encoded: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text: the bytes of the ids as text (bytes that are no UTF-8 are replaced)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            if len(batch):
                raw = own.decode(packed_ids(batch.column("ids")))
                texts = pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], names=["doc_id", "text"])

    rows = encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def encode_decode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text.

    Both directions in one pass, so that the ids never leave the task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in slices(batches, "text"):
            packed = own.encode(batch.column("text").to_pylist())
            decoded = own.decode(packed)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
