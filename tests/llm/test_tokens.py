"""Operators 1, 5 and 8 against the libraries on whole texts."""

import base64
import hashlib
import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nearkin.llm import byte_bpe, orc_tokens, pretokens, token_counts, tokenizer_files
from tests.llm.helpers import ODD_TEXTS, TABLES, empty, table

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def rows(spark):
    given = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()
    odd = [(10_000 + i, text) for i, text in enumerate(ODD_TEXTS)]
    return [tuple(r) for r in given] + odd + [odd[4], (None, "no id")]


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_token_counts(spark, rows, library):
    df = token_counts.token_counts(table(spark, rows).repartition(3), JSON, PATTERN, table_size=500)
    expected = sorted(
        ((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows),
        key=str,
    )
    assert sorted(map(tuple, df.collect()), key=str) == expected


@pytest.mark.parametrize("table_size", [0, token_counts.TABLE_SIZE])
def test_token_counts_of_odd_texts(spark, library, table_size):
    """All chunks are in the table, those with U+0000 too, or none is."""
    odd = [*ODD_TEXTS, "x\0y", "x\0y x\0y", "\0", "a\n\n\nb\n"]
    df = token_counts.token_counts(table(spark, list(enumerate(odd))), JSON, PATTERN, table_size=table_size)
    expected = [len(library.encode(t or "", add_special_tokens=False).ids) for t in odd]
    assert [r["n_tokens"] for r in df.orderBy("doc_id").collect()] == expected


def test_token_counts_with_the_whole_table(spark, rows, library):
    df = token_counts.token_counts(table(spark, rows), JSON, PATTERN)
    expected = sorted(((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=str)
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in df.collect()), key=str) == expected


def test_no_documents(spark):
    assert token_counts.token_counts(empty(spark), JSON, PATTERN).collect() == []
    assert byte_bpe.encode_decode(empty(spark), RANKS, PATTERN).collect() == []
    assert orc_tokens.written_and_read(empty(spark), JSON, PATTERN, 2).collect() == []


def test_a_counter_that_overflows_changes_no_count(spark, rows, library, monkeypatch):
    monkeypatch.setattr(token_counts, "COUNTER_SIZE", 3)
    docs = table(spark, rows[:40])
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, JSON, PATTERN).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows[:40]}


def test_memo_keeps_two_generations():
    asked = []
    memo = pretokens.Memo(lambda k: asked.append(k) or k, 2)
    for key in "abcabc":
        assert memo[key] == key
    assert len(memo) <= 2 and len(memo.old) <= 2 and asked[:3] == ["a", "b", "c"]


def test_chunks_cover_the_text():
    for text in filter(None, ODD_TEXTS):
        assert "".join(pretokens.safe_chunks(text)) == text


def test_byte_bpe(spark, rows, encoding):
    df = byte_bpe.encode_decode(table(spark, rows).repartition(3), RANKS, PATTERN)
    expected = []
    for doc_id, text in rows:
        ids = encoding.encode_ordinary(text or "")
        expected.append(
            (doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        )
    assert sorted(map(tuple, df.collect()), key=str) == sorted(expected, key=str)


def test_long_words_and_rare_characters(encoding):
    random.seed(3)
    texts = ["".join(random.choice("abcdeé") for _ in range(1500)), "aaa" * 500, "ab" * 700 + "!" * 999]
    letters = [chr(c) for c in range(0x20, 0x20000) if unicodedata.category(chr(c)) not in ("Cs",)]
    texts += ["".join(random.choice(letters) for _ in range(400)) for _ in range(5)]
    codec = byte_bpe.codec(RANKS, PATTERN)
    encoded = codec.encode(texts)
    assert encoded == [packed(encoding.encode_ordinary(t)) for t in texts]
    assert codec.decode(encoded) == [t.encode() for t in texts]


def test_ids_as_tables(spark, rows):
    docs = table(spark, rows[:30] + [(77, None)])
    encoded = byte_bpe.encode(docs, RANKS, PATTERN)
    back = {r["doc_id"]: r["text"] for r in byte_bpe.decode(encoded, RANKS, PATTERN).collect()}
    assert back == {i: t or "" for i, t in rows[:30] + [(77, None)]}


def test_the_unicode_of_the_library():
    """Characters that are looked up piece by piece have the same class in both."""
    tokenizer = tokenizer_files.load(JSON, PATTERN)
    sure = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and not tokenizer_files._UNSURE.match(c)]
    assert len(sure) > 20_000
    for start in range(0, len(sure), 400):
        text = "".join(f"a{c}1{c}.{c} {c}{c}  {c}" for c in sure[start : start + 400])
        spans = tokenizer.library.pre_tokenizer.pre_tokenize_str(text)
        assert [b - a for _, (a, b) in spans] == [len(p) for p in tokenizer.pieces(text)]


def test_orc_files(spark, rows, library, tmp_path):
    known = [r for r in rows if r[0] is not None]
    docs = table(spark, known).repartition(4)
    target = str(tmp_path / "ids")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 3)  # places count on a file per partition
    try:
        orc_tokens.write_tokens(docs, target, JSON, PATTERN, end_id=2)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    got = sorted(map(tuple, orc_tokens.token_places(spark, target).collect()))
    start, expected = 0, []
    for doc_id, text in sorted(known, key=lambda r: (r[0], r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    assert got == sorted(expected)
    some = orc_tokens.read_tokens(spark, target, [known[3][0]])
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().executedPlan().toString() or (
        "EqualTo(doc_id" in some._jdf.queryExecution().executedPlan().toString()
    )
    ids = library.encode(known[3][1], add_special_tokens=False).ids
    assert [r["ids"] for r in some.collect()] == [[*ids, 2]]
    files = spark.read.orc(target).select(F.input_file_name().alias("f"), "doc_id").groupBy("f")
    spans = sorted((r["a"], r["b"]) for r in files.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).collect())
    assert all(before[1] <= after[0] for before, after in zip(spans, spans[1:], strict=False))


def test_sure_characters_are_assigned():
    import sys
    import unicodedata

    from nearkin.llm import byte_bpe

    found = byte_bpe.unassigned()
    for point in range(sys.maxunicode + 1):
        letter = chr(point)
        assert bool(found.match(letter)) == (unicodedata.category(letter) == "Cn")
        assert byte_bpe._SURE.match(letter) or not found.match(letter)


class Counted:
    """A function that counts its calls."""

    def __init__(self, call):
        self.call, self.calls = call, 0

    def __call__(self, *args):
        self.calls += 1
        return self.call(*args)


WORDS = ["the", " the", " caf\u00e9", " \u0434\u043e\u043c", "\u4e2d\u6587"]
TAILS = ["", ",", "***", "'", "''", "$$$", "_", "%.", "+=<|>"]


def test_words_with_signs_need_no_pattern(encoding):
    codec = byte_bpe.Codec(RANKS, PATTERN)

    class Pattern:
        findall = Counted(codec.find.findall)

    codec.find = Pattern
    for word in WORDS:
        for tail in TAILS:
            assert codec.pieces(word + tail) == [word, tail][: 2 if tail else 1]
    assert Pattern.findall.calls == 0
    for chunk in [" the's", "***the", " a1,", "e\u0301,", " ***", "'s", "'", " '", "x's'", "\n"]:
        assert codec.pieces(chunk) == codec.find.findall(chunk)
    texts = [f"{a}{x}{b}{y}" for a in WORDS for x in TAILS for b in WORDS for y in TAILS]
    assert codec.encode(texts) == [packed(encoding.encode_ordinary(t)) for t in texts]


def test_another_pattern_cuts_signs_its_own_way():
    codec = byte_bpe.Codec(RANKS, r" ?\p{L}+|[^\s\p{L}]|\s+")
    assert codec.pieces(" the,,") == [" the", ",", ","]


def test_sequences_are_decoded_by_one_aggregate(encoding):
    """Texts of one query come apart again, empty ones and letters beyond Latin-1 too."""
    codec = byte_bpe.Codec(RANKS, PATTERN)
    assert "GROUP BY" not in byte_bpe._DECODE
    texts = ["", "a", "", "\u0100\u0100 \u00ff", "\0", "", "the end\n", ""]
    for some in (texts, texts[:1], texts[1:2], []):
        assert codec.decode([packed(encoding.encode_ordinary(t)) for t in some]) == [t.encode() for t in some]


def test_a_full_cache_changes_no_ids(encoding, library):
    texts = [f"the {a}{x}{b}  {y}\n{a} {a}\t{b}" for a in WORDS for x in TAILS for b in WORDS for y in TAILS[:4]]
    texts += ["x" * 300 + " y"] * 2
    codec = byte_bpe.Codec(RANKS, PATTERN)
    codec.words.limit = codec.chunks.limit = 7
    table = tokenizer_files.IdTable(tokenizer_files.ByteTokenizer(JSON, PATTERN), 7)
    for start in range(0, len(texts), 50):
        some = texts[start : start + 50]
        assert codec.encode(some) == [packed(encoding.encode_ordinary(t)) for t in some]
        got = [b"".join(pretokens.values_of(t, table, table.tokenizer.chunk)) for t in some]
        assert got == [packed(library.encode(t, add_special_tokens=False).ids) for t in some]


def test_a_known_word_is_not_tokenized_again(library):
    """One call of the model for a word with any signs, one for each run of signs."""
    tokenizer = tokenizer_files.ByteTokenizer(JSON, PATTERN)
    tokenizer.tokenize = Counted(tokenizer.tokenize)
    tokenizer.pieces = None
    table = tokenizer_files.IdTable(tokenizer, 1000)
    chunks = [word + tail for tail in TAILS for word in WORDS if tail != "'" or word.isascii()]
    for chunk in chunks:
        assert table[chunk] == packed(library.encode(chunk, add_special_tokens=False).ids)
    assert tokenizer.tokenize.calls == len(WORDS) + len(TAILS) - 1
    with pytest.raises(pretokens.Irregular):
        table[" the\n"]
