"""Texts cut into chunks that a byte-level tokenizer treats independently.

The usual pattern of byte-level BPE takes an optional blank together with the
letters, digits or signs behind it. A single blank between two characters that
are no white space therefore always begins a pre-token, and so a text falls into
chunks that can be looked up one by one. A chunk is one pre-token or a few that
hang together (``" word."``). A lone line end between such characters is a
pre-token of its own.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable
from itertools import filterfalse

_MARK = "\0"
# Splits before a blank that stands between two characters that are no white space.
_BEFORE_BLANK = re.compile(r"(?<=\S)(?= \S)")
LONGEST_KEPT = 256
# Behind letters these are one pre-token, and no letter, digit or white space.
SIGNS = string.punctuation


class Irregular(Exception):
    """A chunk whose neighbours might change its pre-tokens."""


def fast_chunks(text: str) -> list[str]:
    """Chunks cut at every blank and around every line end; some may be irregular."""
    if _MARK in text:
        raise Irregular
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split(_MARK)


def safe_chunks(text: str) -> list[str]:
    """Chunks cut only where it is safe."""
    return _BEFORE_BLANK.split(text)


def is_regular(chunk: str) -> bool:
    """True if the chunk is a lone line end, or has no white space at its edges
    but for one blank in front."""
    core = chunk[1:] if chunk[:1] == " " else chunk
    return chunk == "\n" or (core != "" and core == core.strip())


class Memo(dict):
    """Values of chunks, worked out when first asked for, at most ``2 * limit`` kept.

    When a generation is full it becomes the old one, which still answers; what
    is asked for again moves to the new one.
    """

    def __init__(self, compute: Callable[[str], object], limit: int, check: bool = False):
        super().__init__()
        self.compute, self.limit, self.check, self.old = compute, limit, check, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            if self.check and not is_regular(key):
                raise Irregular
            value = self.compute(key)
        if len(key) <= LONGEST_KEPT:  # as keep, without a call
            if len(self) >= self.limit:
                self.old = {}  # its room goes before the copy needs some
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value

    def keep(self, key: str, value) -> None:
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.limit:
                self.old = {}  # its room goes before the copy needs some
                self.old = dict(self)
                self.clear()
            self[key] = value

    def has(self, key: str) -> bool:
        return key in self or key in self.old


def values_of(text: str, table: dict, compute: Callable[[str], object]) -> list:
    """The values of a text's chunks, by the table where the chunks are regular."""
    if not text:
        return []
    try:
        return list(map(table.__getitem__, fast_chunks(text)))
    except Irregular:
        return [table[c] if is_regular(c) else compute(c) for c in safe_chunks(text)]


def looked_up(
    texts: Iterable[str | None], table: Memo
) -> tuple[list[tuple[list[str], list]], set[str], set[str]]:
    """The chunks of every text with what the table has for them, else None; and the chunks
    that it lacks: regular ones, and others that may be irregular."""
    rows, regular, others = [], set(), set()
    for text in texts:
        chunks, values = [], []
        if text:
            try:
                chunks = fast_chunks(text)
                values = list(map(table.get, chunks))
                if None in values:
                    unknown = {chunk for chunk, value in zip(chunks, values, strict=True) if value is None} - regular
                    if not all(map(is_regular, unknown)):  # what the table has is regular
                        raise Irregular
                    regular |= unknown
            except Irregular:
                chunks = safe_chunks(text)
                values = list(map(table.get, chunks))
                others.update(chunk for chunk, value in zip(chunks, values, strict=True) if value is None)
        rows.append((chunks, values))
    return rows, regular, others


def joined(rows: list[tuple[list[str], list]], new: dict[str, bytes]) -> list[bytes]:
    """The values of every text's chunks in one, those that the table lacked from ``new``."""
    return [
        b"".join([new[chunk] if value is None else value for chunk, value in zip(chunks, values, strict=True)])
        if None in values
        else b"".join(values)
        for chunks, values in rows
    ]
