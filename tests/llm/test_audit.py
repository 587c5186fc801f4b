"""Operator 11 against a brute-force audit."""

import re
from itertools import permutations

from nearkin.llm import filter_audit
from tests.llm.helpers import empty, table

LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    texts = [(i, t or "", p or "") for i, t, p in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}

    def failed(doc_id, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = doc_id is not None and any(i is not None and i < doc_id and t == text for i, t, _ in texts)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": smaller,
        }
        return {f for f in fails if fails[f]}

    judged = [(p, failed(i, t), i in good, i in toxic) for i, t, p in texts]
    out, total = {}, {}
    for part in {p for p, *_ in judged}:
        for order in permutations("ABCDE"):
            left = [j for j in judged if j[0] == part]
            everyone = left
            for step, f in enumerate(order, 1):
                here = [j for j in left if f in j[1]]
                earlier = [j for j in everyone if f in j[1] and j not in left]
                left = [j for j in left if f not in j[1]]
                out[part, "".join(order), step] = [
                    len(left), len(here), len([j for j in earlier]), sum(j[1] == {f} for j in everyone),
                    sum(j[2] for j in here), sum(j[3] for j in here),
                ]
                total[part, f] = total.get((part, f), 0) + len(here)
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in df.collect()}


def odd_rows():
    plain = " ".join(f"w{i}" for i in range(60))
    return [
        (1, plain, "a"), (2, plain, "a"), (2, plain, "b"), (1, plain, "a"), (None, plain, "a"), (None, None, None),
        (3, "", None), (4, None, ""), (5, "x " * 70, "b"), (6, "ABC $ " * 30, "b"), (7, "ABC $ " * 30, "a"),
        (8, "é" * 5000 + "\x0b\x0c\r\n\tB", "c"), (9, " \n ", "c"), (10, plain + " |", "c"),
        (11, plain.upper(), "c"), (12, " ".join("ab" * 60), "c"), (13, "word " * 200_000, "c"),
    ]


ODD_LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, 1), (None, 1, 1), (6, 1, 1), (7, 1, 1), (99, 1, 1), (13, 1, 0)]


def test_odd_rows(spark):
    rows = odd_rows()
    df = filter_audit.audit(table(spark, rows).repartition(3), spark.createDataFrame(ODD_LABELS, LABELS))
    got = found(df)
    assert len(got) == df.count() == 600 * len({p or "" for _, _, p in rows})
    assert got == brute(rows, ODD_LABELS)


def test_a_hot_text_and_a_hot_part(spark):
    """A third of the rows are one text, two thirds one part; ids in no order."""
    rows = [(i * 37 % 300, "same text" if i % 3 == 0 else f"text {i}", "hot" if i % 3 else f"p{i % 5}") for i in range(300)]
    labels = [(i, i % 2, i % 3) for i in range(300)]
    got = found(filter_audit.audit(table(spark, rows), spark.createDataFrame(labels, LABELS)))
    assert got == brute(rows, labels)
    e_first = [v for (part, order, step), v in got.items() if order == "EABCD" and step == 1]
    assert sum(v[1] for v in e_first) == 99


def test_rows_without_id_and_clashing_names(spark):
    """Names that the operator uses inside, as columns of the caller."""
    rows = [(None, "same", "a")] * 40 + [(1, "same", "a")]
    names = ["digest", "mask", "id", "part", "first", "good", "toxic", "salt", "steps"]
    docs = table(spark, rows).selectExpr("*", *[f"1 AS {name}" for name in names])
    got = found(filter_audit.audit(docs, spark.createDataFrame(ODD_LABELS, LABELS)))
    assert got == brute(rows, ODD_LABELS)


def test_empty_tables(spark):
    no_labels = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(empty(spark), no_labels).count() == 0
    got = found(filter_audit.audit(table(spark, [(1, "a", "s")]), no_labels))
    assert got == brute([(1, "a", "s")], [])
