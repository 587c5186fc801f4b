"""Operators 12 and 13 against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from nearkin.llm import kmeans_tree, vector_codes

NAN, INF = float("nan"), float("inf")
# Extra columns whose names the operators use inside.
CLASHING = "row int, v string, leaf int, query int, score string, code string, gap int, of int"


def vectors(spark, rows, kind="float"):
    full = [(*row, *[None] * (3 - len(row)), 1, "v", 2, 3, "s", "c", 4, 5) for row in rows]
    return spark.createDataFrame(full, f"vec_id long, embedding array<{kind}>, label int, {CLASHING}")


def random_rows(n, dimension=8, seed=1, groups=5):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, dimension)) * 3
    points = middles[rng.integers(groups, size=n)] + rng.normal(size=(n, dimension))
    return [(i, [float(x) for x in points[i].astype("float32")], i % 7) for i in range(n)]


# ---- 12: nearest neighbours


def product(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += x * y
    return total


def usable(rows, multiple=1):
    fine = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    fine = [r for r in fine if len(r[1]) % multiple == 0]
    lengths = [len(r[1]) for r in fine]
    common = min(set(lengths), key=lambda n: (-lengths.count(n), n), default=0)
    return [r for r in fine if len(r[1]) == common]


def neighbours(rows, every, n):
    own = [r for r in usable(rows) if any(r[1])]
    out = []
    for at, query in enumerate(own):
        if query[0] is None or query[0] % every:
            continue
        scored = [(-product(query[1], r[1]), r[0] is None, r[0] or 0) for i, r in enumerate(own) if i != at]
        for rank, (score, missing, vec_id) in enumerate(sorted(scored)[:n], 1):
            out.append((query[0], rank, None if missing else vec_id, -score))
    return sorted(out, key=str)


def searched(df, every=20, **options):
    return sorted((tuple(r) for r in kmeans_tree.search(df, every, **options).collect()), key=str)


def odd_vectors():
    plain = random_rows(60, 4)
    return [
        *plain, (None, plain[0][1]), (None, plain[3][1]), (20, plain[1][1]), (20, plain[1][1]), (0, plain[0][1]), (-40, plain[2][1]),
        (100, None), (120, []), (140, [0.0] * 4), (160, [1.0, None, 0.0, 0.0]), (180, [1.0, NAN, 0.0, 0.0]),
        (200, [1.0, INF, 0.0, 0.0]), (220, [1.0, 2.0]), (240, [1.0, 2.0, 3.0, 4.0, 5.0]), (260, [3e38, 0.0, 0.0, 1e-40]),
        (280, [-3e38, 1.0, 1.0, 1.0]), (300, [-0.0, 0.0, 0.0, 1e-45]),
    ]


def test_odd_vectors_when_all_leaves_are_visited(spark):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v, *_ in odd_vectors()]
    got = searched(vectors(spark, rows).repartition(3), target=1.0, n=70)
    assert got == neighbours(rows, 20, 70)


def test_equal_vectors_are_found_by_id(spark):
    """A third of all rows are one vector; cells are small, so the group is many slices."""
    rows = random_rows(300, 4)
    rows = [(i * 7 % 300, rows[0][1] if i % 3 == 0 else v) for i, v, _ in rows]
    got = searched(vectors(spark, rows), target=1.0, n=20)
    assert got == neighbours(rows, 20, 20)


@pytest.mark.parametrize("cell", [7, 4096])
def test_slices_of_leaves_and_queries(spark, monkeypatch, cell):
    monkeypatch.setattr(kmeans_tree, "CELL_ROWS", cell)
    monkeypatch.setattr(kmeans_tree, "CELL_QUERIES", cell)
    rows = random_rows(200, 6)
    got = searched(vectors(spark, rows, "double"), every=5, target=1.0)
    assert got == neighbours(rows, 5, 20)


def test_recall_of_calibrated_visits(spark, monkeypatch):
    """Fewer leaves than all, at the production target."""
    rows = random_rows(3000, 16, groups=40)
    seen = []
    fewest = kmeans_tree.calibrated
    monkeypatch.setattr(kmeans_tree, "calibrated", lambda *a: seen.append((fewest(*a), len(a[3].leaves))) or seen[-1][0])
    got = searched(vectors(spark, rows))
    true = neighbours(rows, 20, 20)
    assert seen[0][0] < seen[0][1]
    assert len(got) == len(true)
    found = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in true}
    assert len(found) >= 0.9 * len(true)
    scores = {(q, v): s for q, _, v, s in got}
    by_id = {i: v for i, v, _ in rows}
    assert all(s == product(by_id[q], by_id[v]) for (q, v), s in scores.items())


def test_the_queue_opens_the_nearest_node_first():
    rng = np.random.default_rng(3)
    sample = rng.normal(size=(2000, 5))
    length = float(np.sqrt((sample**2).sum(axis=1)).max())
    tree = kmeans_tree.fit_tree(sample, 2, 1.0, length)
    leaves = tree.leaves
    assert sorted(set(tree.routed(sample))) == sorted(leaves) and len(leaves) > 40
    every = list(tree.visits(sample[:50], len(leaves)))
    assert all(sorted(order) == sorted(leaves) for order in every)
    assert [order[:3] for order in every] == list(tree.visits(sample[:50], 3))


def test_no_vectors_and_single_ones(spark):
    assert searched(vectors(spark, [])) == []
    assert searched(vectors(spark, [(0, [1.0]), (20, None)])) == []
    assert searched(vectors(spark, [(1, [1.0]), (2, [2.0])])) == []
    assert searched(vectors(spark, [(0, [1.0]), (1, [2.0])])) == [(0, 1, 1, 2.0)]


# ---- 13: vector codes


def lloyd(rows, rounds=vector_codes.ROUNDS):
    own = usable(rows, 4)
    if not own:
        return []
    most = vector_codes.limit(len(own[0][1]))
    whole = [[max(-most, min(most, math.floor(1024 * x))) for x in r[1]] for r in own]
    width = len(whole[0]) // 4
    order = sorted(range(len(own)), key=lambda i: (own[i][0] is None, own[i][0] or 0, own[i][1]))[:256]
    codes, gaps, books = [], [], []
    for p in range(4):
        parts = [w[p * width : (p + 1) * width] for w in whole]
        book = [parts[i] for i in order]

        def nearest(part, book=book):
            return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

        for _ in range(rounds):
            near = [nearest(part) for part in parts]
            for i in range(len(book)):
                group = [part for part, (_, j) in zip(parts, near, strict=True) if j == i]
                if group:
                    book[i] = [sum(column) // len(group) for column in zip(*group, strict=True)]
        near = [nearest(part) for part in parts]
        codes.append([i for _, i in near])
        gaps.append([d for d, _ in near])
        books.append(book)
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    errors = [sum(column) for column in zip(*gaps, strict=True)]
    labels = {}
    for r, error in zip(own, errors, strict=True):
        labels[r[2]] = labels.get(r[2], 0) + error
    return sorted(
        ((r[0], "".join(f"{c[i]:02x}" for c in codes), errors[i], min(labels[r[2]], 2**63 - 1), sha) for i, r in enumerate(own)),
        key=str,
    )


def coded(df):
    return sorted((tuple(r) for r in vector_codes.coded(df).collect()), key=str)


def test_codes_equal_plain_lloyd(spark):
    rows = random_rows(700, 8)
    rows = [(i * 11 % 700, v, None if i % 5 == 0 else label) for i, v, label in rows]
    assert coded(vectors(spark, rows).repartition(3)) == lloyd(rows)


def test_odd_vectors_as_codes(spark):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label)
            for i, v, label in [(*r, None)[:3] for r in odd_vectors()]]
    assert coded(vectors(spark, rows).repartition(2)) == lloyd(rows)


def test_a_third_of_the_rows_are_one_vector(spark):
    rows = [(i, v if i % 3 else [0.5, -0.25, 0.0, 1e-9] * 2, 3 if i % 3 else None) for i, v, _ in random_rows(600, 8)]
    assert coded(vectors(spark, rows, "double")) == lloyd(rows)


def test_no_rows_and_few_rows(spark):
    assert coded(vectors(spark, [])) == []
    assert coded(vectors(spark, [(1, None), (2, [1.0, 2.0])])) == []
    few = [(2, [1.0, 2.0, 3.0, 4.0], 1), (1, [-1.0, -2.0, -3.0, -0.0001], 1), (None, [9.0, 9.0, 9.0, 9.0], None)]
    assert coded(vectors(spark, few)) == lloyd(few)


def test_active_entries_give_what_a_full_scan_gives():
    """With many ties: small whole numbers, repeated entries, few entries moved."""
    random.seed(2)
    rng = np.random.default_rng(2)
    for _ in range(30):
        points, old = rng.integers(-3, 4, (200, 3)), rng.integers(-3, 4, (12, 3))
        new = old.copy()
        for i in random.sample(range(12), random.randrange(12)):
            new[i] = rng.integers(-3, 4, 3)
        before = vector_codes.full_scan(points, old)
        moved = (old != new).any(axis=1)
        code, gap = vector_codes.active_scan(points, new, moved, *before)
        right = vector_codes.full_scan(points, new)
        assert code.tolist() == right[0].tolist() and gap.tolist() == right[1].tolist()


def test_wide_numbers_are_exact():
    most = vector_codes.limit(8)
    points = np.array([[most, -most], [most, most - 1], [0, 1]])
    entries = np.array([[-most, most], [most, most]])
    right = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e, strict=True)) for e in entries] for p in points]
    assert vector_codes.squared(points, entries).tolist() == right
