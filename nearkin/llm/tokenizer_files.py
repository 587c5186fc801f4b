"""Byte-level tokenizers of the ``tokenizers`` library, loaded once per worker."""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

import regex

from nearkin.llm.pretokens import SIGNS, Irregular, Memo, is_regular

KEPT_CHUNKS = 300_000
KEPT_ID_CHUNKS = 800_000
KEPT_PIECES = 150_000


@lru_cache(maxsize=1)
def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in such vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(printable))
    return letters


# Characters on which the installed Unicode tables may disagree are left to the
# library: what is not assigned here may be a letter or a digit there.
_UNSURE = re.compile(r"[^\x00-ɏͰ-ϿЀ-ӿ‐-‧‰-⁞€぀-ヿ一-龥]")


class ByteTokenizer:
    """Token ids of texts, as ``encode(text, add_special_tokens=False)`` gives them.

    Chunks go through the library's own model, one call per pre-token that is
    not in the cache; a text that holds one of the added tokens, and a chunk with
    rare characters, goes through the whole library.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"]
        plain = (
            pre["type"] == "ByteLevel"
            and pre["use_regex"]
            and not pre["add_prefix_space"]
            and spec["normalizer"] is None
        )
        if not plain:
            raise ValueError("a byte-level tokenizer without normalizer is needed")
        self.added = [token["content"] for token in spec["added_tokens"]]
        self.tokenize = self.library.model.tokenize
        self.id_bytes = [_packed([i]) for i in range(max(spec["model"]["vocab"].values()) + 1)]
        self.pieces = regex.compile(pattern).findall
        self.letters = _byte_letters()
        self.words = Memo(self.piece, KEPT_PIECES)

    def library_ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def has_added(self, text: str) -> bool:
        return any(token in text for token in self.added)

    def piece(self, piece: str) -> bytes:
        if piece.isascii() and piece[1:].isalnum():  # such bytes stand for themselves
            mapped = self.letters[ord(piece[0])] + piece[1:]
        else:
            mapped = piece.encode().decode("latin-1").translate(self.letters)
        own = self.id_bytes
        return b"".join([own[token.id] for token in self.tokenize(mapped)])

    def chunk(self, chunk: str) -> bytes:
        """The ids of a chunk as little-endian 32-bit integers."""
        if not chunk.isascii() and _UNSURE.search(chunk):
            return _packed(self.library_ids(chunk))
        # Letters alone are one pre-token, a sign behind them is another.
        if chunk.isalpha() or (chunk[0] == " " and chunk[1:].isalpha()):
            return self.words[chunk]
        word = chunk.rstrip(SIGNS)
        if len(word) < len(chunk) and (word.isalpha() or (word[:1] == " " and word[1:].isalpha())):
            return self.words[word] + self.words[chunk[len(word) :]]
        return b"".join(map(self.words.__getitem__, self.pieces(chunk)))


class IdTable(Memo):
    """Chunk -> ids as little-endian 32-bit integers. A word with signs behind it is
    worked out from the word alone, if that is here."""

    def __init__(self, tokenizer: ByteTokenizer, limit: int):
        super().__init__(tokenizer.chunk, limit, check=True)
        self.tokenizer = tokenizer

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            word = key.rstrip(SIGNS)
            # Letters, or a blank and letters, are regular and one pre-token; signs are another.
            if (word.isalpha() or (word[:1] == " " and word[1:].isalpha())) and (
                key.isascii() or not _UNSURE.search(key)
            ):
                own = self.tokenizer
                if len(word) < len(key):
                    value = (self.get(word) or own.piece(word)) + own.words[key[len(word) :]]
                else:
                    value = own.piece(word)
            elif is_regular(key):
                value = self.compute(key)
            else:
                raise Irregular
        self.keep(key, value)
        return value


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteTokenizer:
    return ByteTokenizer(path, pattern)


@lru_cache(maxsize=4)
def id_table(path: str, pattern: str) -> IdTable:
    return IdTable(load(path, pattern), KEPT_ID_CHUNKS)
