"""Operator 7: repeated stretches of words, by fixed-block anchors.

Every text is cut into blocks of ``block`` words that do not overlap; their
hashes are the index. Every window of ``block`` words at any place probes it. A
window of ``2 * block - 1`` words or more always holds a whole block, so each
repeat is hit (round 1 of :mod:`nearkin.llm.repeats`). The hits are extended: all
windows of ``window`` words around a hit are compared across the corpus (round
2), and those that start earlier are joined to maximal repeats.

Defined results: NULL and empty texts have no words; texts of fewer words than a
window are kept; repeated rows are copies of the first; an empty table gives an
empty result; other columns are ignored. Kept words are joined by one blank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm import repeats
from nearkin.llm import textarrays as ta

WINDOW = 20


class _Reading:
    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, block: int):
        self.window, self.block = window, block
        starts, ends, self.bounds = ta.words(data, offsets)
        self.rolling = ta.Rolling(ta.word_hashes(data, starts, ends))
        self.words = data, starts, ends

    def anchors(self):
        """Every window of a block's size; those at a multiple of it are the index."""
        n = int(self.bounds[-1])
        places = np.arange(n)
        row = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        places, row = (x[places + self.block <= self.bounds[row + 1]] for x in (places, row))
        reference = (places - self.bounds[row]) % self.block == 0
        return places, self.rolling.windows(places, places + self.block), reference

    def keys(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = places + self.window
        return self.rolling.windows(places, ends), ta.checks_of(ta.word_checks(*self.words), places, ends)


def method(window: int = WINDOW) -> repeats.Method:
    block = (window + 1) // 2
    return repeats.Method(
        lambda data, offsets: _Reading(data, offsets, window, block), window, window - block, 0.18, 0.05
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept (the kept words, joined) of every text."""

    def finish(doc_ids, data, offsets, stretches) -> pa.Table:
        counts, removed, texts = [], [], []
        for start, stop, bounds, covered in stretches:
            counts += np.diff(bounds).tolist()
            for i in range(start, stop):
                own = covered[bounds[i - start] : bounds[i - start + 1]]
                removed.append(int(own.sum()))
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                texts.append(b" ".join([w for w, gone in zip(words, own.tolist(), strict=True) if not gone]).decode())
        return pa.table(
            {
                "doc_id": repeats.ids_back(doc_ids),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(texts, pa.string()),
            }
        )

    schema = "doc_id long, n_words long, n_removed long, kept string"
    return repeats.marked(docs, method(window), finish, schema, doc_id, text)


def digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """:func:`remove_repeats` with a SHA-256 of the kept words in place of them."""
    rows = remove_repeats(docs, window)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
