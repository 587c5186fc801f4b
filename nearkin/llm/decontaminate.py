"""Operator 2: texts that hold a test item, up to a few edits.

Texts are lower-cased and every run of white space becomes one blank. An item of
m characters may be off by ``m * edit_percent / 100`` insertions, deletions and
replacements. It is cut into one piece more than that budget, so one piece at
least must be found exactly (pigeonhole). All pieces are looked for at once; the
place of a hit fixes where the item would lie, and there the least number of
edits is worked out by Myers' bit-parallel method. Hits that point to the same
place are verified once.

The items are handed to the tasks in blocks of bounded size, and the texts are
scanned once per block: a block is broadcast, the whole benchmark need not fit.

Defined results: a NULL or empty text or item matches nothing; repeated texts are
found each; of repeated item ids each text counts; an item too short for a budget
must occur exactly; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm.common import held, slices

EDIT_PERCENT = 5
BLOCK_BYTES = 2 << 20


def normalized(text: str) -> str:
    return " ".join(text.lower().split())


def budget(item: str, edit_percent: int = EDIT_PERCENT) -> int:
    """The edits allowed in a normalized item."""
    return len(item) * edit_percent // 100


def pieces(item: str, n: int) -> list[tuple[int, str]]:
    """``n`` pieces of about equal length that cover the item: (place, piece)."""
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def letter_masks(item: str) -> dict[str, int]:
    """For each character the places in the item that hold it, as bits."""
    masks: dict[str, int] = {}
    for place, letter in enumerate(item):
        masks[letter] = masks.get(letter, 0) | (1 << place)
    return masks


def best_match(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """The least edits between an item and any stretch of the text, and where the
    first such stretch ends (Myers 1999, on integers of m bits)."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for at, letter in enumerate(text, 1):
        equal = masks.get(letter, 0)
        vertical = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        # A match may begin anywhere: the row above the item costs nothing.
        up = (up << 1) & full
        plus = ((down << 1) & full) | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, at
    return best, end


@dataclass(frozen=True)
class Item:
    item_id: object
    text: str
    budget: int
    masks: dict


class Matcher:
    """All pieces of a block of items, and the check of what they hit."""

    def __init__(self, items: list[tuple[object, str]], edit_percent: int):
        import ahocorasick

        self.items = [
            Item(i, text, budget(text, edit_percent), letter_masks(text)) for i, text in items if text
        ]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, item in enumerate(self.items):
            for place, piece in pieces(item.text, item.budget + 1):
                places.setdefault(piece, []).append((number, place))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[object, int, int]]:
        """(item_id, edits, end in the normalized text) of each item the text holds."""
        if not self.items:
            return []
        text = normalized(text)
        starts: dict[int, set[int]] = {}
        for last, (length, found) in self.automaton.iter(text):
            for number, place in found:
                starts.setdefault(number, set()).add(last + 1 - length - place)
        result = []
        for number, guesses in starts.items():
            match = self._verified(self.items[number], sorted(guesses), text)
            if match is not None:
                result.append((self.items[number].item_id, *match))
        return result

    def _verified(self, item: Item, guesses: list[int], text: str) -> tuple[int, int] | None:
        """The best match near the guessed starts; guesses that lie close share a look."""
        best = None
        low = high = guesses[0]
        for guess in [*guesses[1:], None]:
            if guess is not None and guess - high <= item.budget:
                high = guess
                continue
            begin = max(0, low - item.budget)
            stretch = text[begin : high + len(item.text) + item.budget]
            edits, end = best_match(item.masks, len(item.text), stretch)
            if edits <= item.budget and (best is None or edits < best[0]):
                best = (edits, begin + end)
            low = high = guess
        return best


def _matcher(name: str, items, edit_percent: int) -> Matcher:
    """The matcher of a block, kept by the name that the driver gave it."""
    return held(name, lambda: Matcher(items.value, edit_percent))


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[object, str]]]:
    """The normalized items in blocks of about ``block_bytes``, one at a time on the driver."""
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).filter("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    for number in range(n_blocks):
        found = rows.filter(block == number).distinct().collect()
        yield [(r["item_id"], normalized(r["text"])) for r in found]


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_percent: int = EDIT_PERCENT,
    block_bytes: int = BLOCK_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, edits, end_pos: one row per text and item that it holds."""
    id_type = benchmark.schema[item_id].dataType
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for block in item_blocks(benchmark, item_id, item_text, block_bytes):
        items = docs.sparkSession.sparkContext.broadcast(block)
        part = rows.mapInArrow(
            _finder(items, edit_percent), f"doc_id long, item_id {id_type.simpleString()}, edits int, end_pos long"
        )
        found = part if found is None else found.unionByName(part)
    # The same id and item may come from two rows of the benchmark.
    best = F.min(F.struct("edits", "end_pos")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def _finder(items, edit_percent: int):
    name = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, items, edit_percent)
        for batch in slices(batches, "text"):
            rows = []
            ids = batch.column("doc_id").to_pylist()
            for own, value in zip(ids, batch.column("text").to_pylist(), strict=True):
                if value:
                    rows += [(own, *match) for match in matcher.matches(value)]
            if rows:
                own, item, edits, end = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(item), pa.array(edits, pa.int32()), pa.array(end, pa.int64())],
                    names=["doc_id", "item_id", "edits", "end_pos"],
                )

    return run


def without_items(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_percent: int = EDIT_PERCENT,
    block_bytes: int = BLOCK_BYTES,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The documents that hold no item, with all their columns; nothing is shuffled."""
    for block in item_blocks(benchmark, item_id, item_text, block_bytes):
        items = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.mapInArrow(_filter(items, edit_percent, text), docs.schema)
    return docs


def _filter(items, edit_percent: int, text: str):
    name = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, items, edit_percent)
        for batch in slices(batches, text):
            clean = [not value or not matcher.matches(value) for value in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(clean))

    return run
