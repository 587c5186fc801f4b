"""Operators 4, 7 and 10 against brute force."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nearkin.llm import block_dedup, jaccard_join, repeats, suffix_dedup
from nearkin.llm import textarrays as ta
from tests.llm import helpers
from tests.llm.helpers import by_id, empty, table


def odd_rows():
    random.seed(5)
    base = "".join(random.choice("abc d\n") for _ in range(400))
    words = [random.choice("abc") for _ in range(60)]
    return [
        (1, base), (2, None), (3, ""), (4, base[50:300] + "é"), (5, "x" * 250), (6, "x" * 99), (7, base), (7, base),
        (None, base[:120]), (8, "é" * 80 + base[200:]), (9, " ".join(words)),
        (10, " ".join(words[10:40] + ["z"] + words[5:45])), (10, " ".join(words)), (11, " ".join(["q"] * 70)),
        (12, "   "), (13, base[:100]), (14, base[100:] + base[:100]),
    ]


@pytest.mark.parametrize("group_bytes", [1 << 24, 64])
def test_repeated_bytes_and_words(spark, monkeypatch, group_bytes):
    """With many small groups and slices, too."""
    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)
    rows = odd_rows()
    docs = table(spark, rows).repartition(3)
    assert by_id(suffix_dedup.digest(docs)) == helpers.removed_bytes(rows, 100)
    assert by_id(block_dedup.digest(docs)) == helpers.removed_words(rows, 20)


def test_other_windows(spark):
    rows = odd_rows()
    docs = table(spark, rows)
    assert by_id(suffix_dedup.digest(docs, 57)) == helpers.removed_bytes(rows, 57)
    assert by_id(block_dedup.digest(docs, 7)) == helpers.removed_words(rows, 7)
    with pytest.raises(ValueError):
        suffix_dedup.method(56)


def test_spans_and_kept_text(spark):
    rows = [(1, "a" * 3 + "b" * 120), (2, "c" + "b" * 120 + "d")]
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(table(spark, rows)).collect()}
    assert [tuple(s) for s in got[2]["spans"]] == [(1, 121)]
    assert bytes(got[2]["kept"]) == b"cd"


def test_the_cover_is_a_difference_cover():
    differences = {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER}
    assert differences == set(range(suffix_dedup.PERIOD))


def test_many_copies_and_a_hot_passage(spark):
    """A third of the rows are one text, another third share a passage."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for i in range(90):
        own = " ".join(f"w{i}_{j}" for j in range(15))
        rows.append((i, passage + " same text for all" if i % 3 == 0 else f"{own} {passage}" if i % 3 == 1 else own))
    docs = table(spark, rows).repartition(5)
    assert by_id(block_dedup.digest(docs)) == helpers.removed_words(rows, 20)
    assert by_id(suffix_dedup.digest(docs)) == helpers.removed_bytes(rows, 100)


def thue_morse(n):
    """The sequence and its opposite: polynomials modulo 2**64 cannot tell them apart from n = 1024 on."""
    sequence = [bin(i).count("1") & 1 for i in range(n)]
    return sequence, [1 - x for x in sequence]


@pytest.mark.parametrize("group_bytes", [1 << 24, 64])
def test_bytes_that_differ_under_one_hash(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)
    tail = "".join(chr(97 + i * i % 23) for i in range(100))
    rows = [(i, "".join("ab"[x] for x in part) + tail) for i, part in enumerate(thue_morse(1024))]
    assert by_id(suffix_dedup.digest(table(spark, rows), 1100)) == helpers.removed_bytes(rows, 1100)


def test_words_that_differ_under_one_hash(spark):
    tail = [f"p{i}" for i in range(1024)]
    rows = [(i, " ".join(["ab"[x] for x in part] + tail)) for i, part in enumerate(thue_morse(1024))]
    assert by_id(block_dedup.digest(table(spark, rows), 2048)) == helpers.removed_words(rows, 2048)


def near_copies():
    random.seed(4)
    pool = [f"w{i}" for i in range(40)]
    rows = []
    for _ in range(50):
        base = [random.choice(pool) for _ in range(random.choice([3, 5, 8, 12, 30, 60, 150, 400]))]
        for _ in range(random.choice([1, 2, 3, 9])):
            words = list(base)
            for _ in range(random.randrange(0, 1 + len(words) // 12)):
                at, what = random.randrange(len(words)), random.random()
                if what < 0.4:
                    words[at] = random.choice(pool)
                elif what < 0.7:
                    words.insert(at, random.choice(pool))
                elif len(words) > 1:
                    del words[at]
            text = " ".join(words)
            rows.append((len(rows), text.upper() if random.random() < 0.2 else text))
    rows += [(1000, None), (1001, ""), (1002, "  "), (1003, "a b"), (1004, "A  b")]
    numbers = [str(i) for i in range(100)]
    # A chain: each like the next, the ends unlike.
    rows += [(2000 + k, " ".join(numbers[k * 3 :] + [f"x{j}" for j in range(k * 3)])) for k in range(20)]
    random.shuffle(rows)
    return rows


def test_links(spark):
    rows = near_copies()
    assert by_id(jaccard_join.linked(table(spark, rows).repartition(3))) == helpers.linked(rows)


def test_a_large_group_of_near_copies_and_a_common_passage(spark):
    random.seed(6)
    base = [f"b{i}" for i in range(120)]
    common = [f"c{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(3):
            words[random.randrange(120)] = f"z{random.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    for i in range(120, 240):
        rows.append((i, " ".join(common + [f"u{random.randrange(10**6)}" for _ in range(random.randrange(5, 60))])))
    assert by_id(jaccard_join.linked(table(spark, rows))) == helpers.linked(rows)


def test_a_group_in_blocks(spark, monkeypatch):
    """Groups cut into blocks, in several steps of distance, with what the sketches rule out."""
    monkeypatch.setattr(jaccard_join, "TOGETHER", 16)
    monkeypatch.setattr(jaccard_join, "FURTHER", 4)
    random.seed(8)
    common = [f"c{i}" for i in range(70)]
    rows = []
    for i in range(90):
        own = [f"u{i // 2 if i % 3 else i}w{j}" for j in range(random.randrange(8, 40))]
        rows.append((i, " ".join(common + own)))
    rows += near_copies()[:60]
    rows = [(i, text) for i, (_, text) in enumerate(rows)]
    assert by_id(jaccard_join.linked(table(spark, rows))) == helpers.linked(rows)


def test_sketches_never_rule_out_what_is_like():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 3000, n, np.uint64)) for n in (1, 3, 40, 64, 65, 100, 500, 900, 1100, 3000)]
    bounds = np.cumsum([0, *map(len, sets)])
    found = jaccard_join.sketches(ta.mixed(np.concatenate(sets)), bounds)
    known = pa.table({"known": pa.array(range(len(sets))), "sketch": pa.array(found, pa.binary())})
    sketch = jaccard_join.Sketches(np.arange(len(sets)), known)
    for i, j in itertools.product(range(len(sets)), repeat=2):
        unlike = int(sketch.differences(np.array([i]), np.array([j]))[0])
        assert unlike <= len(np.setxor1d(sets[i], sets[j])) and (i != j or unlike == 0)


def test_words_that_one_hash_takes_for_equal(spark):
    """Thue-Morse words and their complements are equal modulo 2**64."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one), (2, other), (3, f"{one} x y z q"), (4, f"{other} x y z q"), (5, f"{one}")]
    assert by_id(jaccard_join.linked(table(spark, rows))) == helpers.linked(rows)


def test_sets_that_need_neighbourhoods(spark, monkeypatch):
    """Fewer segments than the pigeonhole needs: neighbourhoods must make up for it."""
    monkeypatch.setattr(jaccard_join, "SPREAD", 1)
    rows = [r for r in near_copies() if r[0] < 1000]
    found = jaccard_join.Plan.first(75)
    assert found.segments[6] == jaccard_join.allowed(jaccard_join.np.array([128]), 75)[0] + 1
    assert by_id(jaccard_join.linked(table(spark, rows))) == helpers.linked(rows)


def test_ids_that_repeat_or_miss(spark):
    rows = [(1, "a b c d e f"), (1, "x y z x y z q"), (2, "a b c d e f"), (None, "a b c d e f"), (3, "q")]
    got = by_id(jaccard_join.linked(table(spark, rows)))
    assert got == {1: [(2, 1), (3, 1)], 2: [(2, 1)], None: [(2, None)], 3: [(1, 3)]}


def test_components(spark):
    chain = spark.createDataFrame([(i + 1, i) for i in range(10, 40)] + [(5, 3), (3, 5), (7, 7)], "x long, y long")
    got = {r["node"]: r["component"] for r in jaccard_join.components(chain).collect()}
    assert got == {**{i: 10 for i in range(11, 41)}, 5: 3}
    assert jaccard_join.components(chain.filter("x < 0")).count() == 0


def test_no_documents(spark):
    assert suffix_dedup.digest(empty(spark)).collect() == []
    assert block_dedup.digest(empty(spark)).collect() == []
    assert jaccard_join.linked(empty(spark)).collect() == []


def test_nothing_is_broadcast_by_hand(spark):
    docs = table(spark, [(1, "a b"), (2, "a b")]).filter(F.col("doc_id") > 0)
    plan = block_dedup.digest(docs)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in plan


def test_groups_with_the_same_members_become_one(spark):
    """Around component 1, eight groups of ten out of eleven nodes; around 100, three groups of two."""
    groups = [(f"g{g}", sorted({*range(1, 12)} - {g + 2})) for g in range(8)]
    groups += [(f"h{h}", [100, 100 + h]) for h in (1, 2, 3)]
    rows = [(name.encode(), at, node, 20 + node, at == 3) for name, nodes in groups for at, node in enumerate(nodes)]
    members = spark.createDataFrame(rows, "name binary, at long, node long, size long, probe boolean")
    found = spark.createDataFrame([], "node long, component long")
    got = {}
    for r in jaccard_join._merged(members, found).orderBy("name", "at").collect():
        got.setdefault(bytes(r["name"]), []).append((r["at"], r["node"], r["size"]))
    assert {k: [node for _, node, _ in v] for k, v in got.items() if k[:1] == b"h"} == {b"h%d" % h: [100, 100 + h] for h in (1, 2, 3)}
    assert [v for k, v in got.items() if k[:1] != b"h"] == [[(i, i + 1, 21 + i) for i in range(11)]]
