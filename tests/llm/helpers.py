"""Rows that every operator must take, and brute-force versions."""

import hashlib
import re

TABLES = "/root/testdata/sf0.001"

# Extra columns whose names the operators use inside.
CLASHING = "g int, kind string, n long, x long, before long, host string"


def table(spark, rows, extra="source string"):
    """doc_id, text, one more column, and extra columns with clashing names."""
    full = [(*row, *[None] * (3 - len(row)), 1, "k", 2, 3, 4, "h") for row in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, {extra}, {CLASHING}")


def empty(spark):
    return table(spark, [])


ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "a  b\n c\t", "x\u0000y", "=" * 900, "abc" * 300, "1" * 333,
    "don't it's we'll", " 　a b", "՘a₏1", "a\n", "👍🏽 ok", "é" * 50, "word " * 400, "A<|endoftext|>b",
]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def by_id(df):
    found = {}
    for row in df.collect():
        found.setdefault(row[0], []).append(tuple(row)[1:])
    return {k: sorted(v, key=str) for k, v in found.items()}


def removed_bytes(rows, window):
    seen, out = set(), {}
    for doc_id, text in ordered(rows):
        data = (text or "").encode()
        marks = bytearray(len(data))
        for at in range(len(data) - window + 1):
            part = data[at : at + window]
            if part in seen:
                marks[at : at + window] = b"\1" * window
            seen.add(part)
        left = bytes(b for b, gone in zip(data, marks, strict=True) if not gone)
        spans = len(re.findall(b"\1+", bytes(marks)))
        out.setdefault(doc_id, []).append((len(data), sum(marks), spans, hashlib.sha256(left).hexdigest()))
    return {k: sorted(v, key=str) for k, v in out.items()}


def removed_words(rows, window):
    seen, out = set(), {}
    for doc_id, text in ordered(rows):
        words = (text or "").encode().split()
        marks = [False] * len(words)
        for at in range(len(words) - window + 1):
            part = tuple(words[at : at + window])
            if part in seen:
                marks[at : at + window] = [True] * window
            seen.add(part)
        left = b" ".join(w for w, gone in zip(words, marks, strict=True) if not gone)
        out.setdefault(doc_id, []).append((len(words), sum(marks), hashlib.sha256(left).hexdigest()))
    return {k: sorted(v, key=str) for k, v in out.items()}


_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, n=5):
    words = (text or "").encode().translate(_LOWER).split()
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def linked(rows, percent=75):
    """doc_id -> (size, component) by comparing all pairs that share a shingle."""
    sets = {doc_id: shingles(text) for doc_id, text in rows}
    root = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for doc_id, own in sets.items():
        common = {}
        for s in own:
            for other in holders.get(s, ()):
                common[other] = common.get(other, 0) + 1
            holders.setdefault(s, []).append(doc_id)
        for other, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[other]) - n):
                a, b = find(doc_id), find(other)
                root[max(a, b)] = min(a, b)
    return {doc_id: [(len(own), find(doc_id))] for doc_id, own in sets.items()}
