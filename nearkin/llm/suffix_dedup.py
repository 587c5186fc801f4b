"""Operator 4: repeated byte strings, by window hashing behind a difference cover.

All windows of ``window`` bytes are compared by keys; no suffix is sorted. A
difference cover D modulo v holds, for every two places i and j, a shift below v
that takes both to places of the cover. So two equal windows always share an
aligned pair of cover samples (the strings of ``window - v + 1`` bytes at places
of the cover):

* hashes of the cover samples are exchanged first (round 1 of
  :mod:`nearkin.llm.repeats`); a sample that occurs once cannot lie in a repeat;
* the windows that reach a sample with company are dealt into buckets of the key
  space and their keys sorted one bucket at a time (round 2); of a run of equal
  keys the first place stays.

Memory is bounded by a bucket or a group of texts, whatever the size of the
corpus. Keys are two independent hashes of the whole window, of 64 and 62 bits
(see ``textarrays``); bytes are not compared.

Defined results: NULL and empty texts have nothing to remove; texts shorter than
the window are kept; bytes are removed wherever they lie, also inside a
character; repeated rows are copies of the first; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm import repeats
from nearkin.llm import textarrays as ta

WINDOW = 100
#: A difference cover modulo 57 (a perfect difference set).
PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)


class _Reading:
    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        self.bounds, self.window, self.data = offsets, window, data
        self.rolling = ta.of_bytes(data)

    def anchors(self):
        """The cover samples, by the place within their own text."""
        size = self.window - PERIOD + 1
        sizes = np.diff(self.bounds)
        rounds = -(-sizes // PERIOD)
        row = np.repeat(np.arange(len(sizes)), rounds)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(rounds) - rounds, rounds)
        places = ((self.bounds[row] + nth * PERIOD)[:, None] + np.array(COVER)).ravel()
        places = places[places + size <= np.repeat(self.bounds[row + 1], len(COVER))]
        return places, self.rolling.windows(places, places + size), np.ones(len(places), bool)

    def keys(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = places + self.window
        return self.rolling.windows(places, ends), ta.checks_of_bytes(self.data, places, ends)


def method(window: int = WINDOW) -> repeats.Method:
    if window < PERIOD:
        raise ValueError(f"the window must be at least {PERIOD} bytes")
    return repeats.Method(
        lambda data, offsets: _Reading(data, offsets, window), window, PERIOD - 1, len(COVER) / PERIOD, 0.25
    )


def _spans(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(covered.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (start, end) and kept (binary) of every text."""

    def finish(doc_ids, data, offsets, stretches) -> pa.Table:
        removed, spans, texts = [], [], []
        for start, stop, bounds, covered in stretches:
            base = int(offsets[start])
            for i in range(stop - start):
                a, b = int(bounds[i]), int(bounds[i + 1])
                own = covered[a:b]
                starts, ends = _spans(own)
                removed.append(int(own.sum()))
                spans.append([{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
                texts.append(data[base + a : base + b][~own].tobytes())
        return pa.table(
            {
                "doc_id": repeats.ids_back(doc_ids),
                "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array([len(s) for s in spans], pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(texts, pa.binary()),
            }
        )

    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, "
        "spans array<struct<start: long, end: long>>, kept binary"
    )
    return repeats.marked(docs, method(window), finish, schema, doc_id, text)


def digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """:func:`remove_repeats` with a SHA-256 of the kept bytes in place of them."""
    rows = remove_repeats(docs, window)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
