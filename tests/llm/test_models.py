"""Operators 2, 3, 6 and 9."""

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from nearkin.llm import decontaminate, host_rules, language_id, quality_classifier
from tests.llm.helpers import TABLES, empty, table


def edits(item, text):
    """The least edits between the item and any stretch of the text, by the plain recurrence."""
    row, best = list(range(len(item) + 1)), len(item)
    for letter in text:
        new = [0]
        for i, own in enumerate(item):
            new.append(min(row[i] + (own != letter), row[i + 1] + 1, new[i] + 1))
        row, best = new, min(best, new[-1])
    return best


def test_bit_parallel_distance():
    random.seed(1)
    for _ in range(200):
        item = "".join(random.choice("abc") for _ in range(random.randint(1, 40)))
        text = "".join(random.choice("abc") for _ in range(random.randint(0, 60)))
        assert decontaminate.best_match(decontaminate.letter_masks(item), len(item), text)[0] == edits(item, text)


def test_pieces_cover_the_item():
    for n in range(1, 9):
        found = decontaminate.pieces("abcdefghijk", n)
        assert "".join(p for _, p in found) == "abcdefghijk" and len(found) == n


def test_items_up_to_their_budget(spark):
    random.seed(2)
    items = ["".join(random.choice("abcdefgh ") for _ in range(n)).strip() for n in (60, 130, 300)] + ["Zw", None, ""]
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, doc_id int")
    rows = [(0, None), (1, ""), (2, "zw"), (3, "z w")]
    for item in items[:3]:
        for n in range(0, len(item) // 10):
            text = list(item.upper())
            for _ in range(n):
                text[random.randrange(len(text))] = random.choice("xyz")
            rows.append((len(rows), "before  it\n" + "".join(text) + " after"))
    docs = table(spark, [*rows, rows[5]])
    normal = [decontaminate.normalized(t or "") for t in items]
    expected = set()
    for doc_id, text in rows:
        for item_id, item in enumerate(normal):
            least = edits(item, decontaminate.normalized(text or "")) if item else 1
            if item and least <= decontaminate.budget(item):
                expected.add((doc_id, item_id, least))
    for block_bytes in (1 << 20, 100):
        got = decontaminate.find_items(docs, bench, block_bytes=block_bytes).collect()
        assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in got) == sorted(expected)
    left = decontaminate.without_items(docs, bench).collect()
    assert {r["doc_id"] for r in left} == {i for i, _ in rows} - {i for i, _, _ in expected}
    assert left[0].asDict().keys() == set(docs.columns)
    assert decontaminate.find_items(empty(spark), bench).count() == 0
    assert decontaminate.find_items(docs, bench.limit(0)).count() == 0


def test_host_rules_are_their_sql(spark):
    random.seed(3)
    pool = ["a", "b", "é", "c#", "$d", " "]
    rows = [(1, None, "h"), (2, "", "h"), (3, " \n\t ", None), (4, "x\n\nx\n x\nx", "h"), (4, "x\n\nx\n x\nx", "h")]
    for i in range(40):
        joined = "".join(random.choice(pool) + random.choice([" ", " ", "\n", "\t"]) for _ in range(random.randrange(120)))
        rows.append((10 + i, joined, random.choice(["bad", "g1", "g2", None])))
    rows += [(100 + i, "too short", "worse") for i in range(30)]
    rows += [(200 + i, " ".join(f"{i}w{j}" for j in range(60)), "worse" if i == 0 else "fine") for i in range(30)]
    documents = [(i, t, s) for i, t, s in rows if i != 4 or True]
    got = sorted(map(tuple, host_rules.host_verdicts(table(spark, documents)).collect()), key=str)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    # The SQL joins by id, so that the repeated row goes under an id of its own.
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?)", [*documents[:4], (5, *documents[4][1:]), *documents[5:]])
    expected = connection.sql(host_rules.ORACLE_SQL).fetchall()
    expected = sorted(((4, *r[1:]) if r[0] == 5 else r for r in expected), key=str)
    assert got == expected
    verdicts = {r[0]: r[-1] for r in got}
    assert verdicts[200] is False and verdicts[201] is True
    assert host_rules.host_verdicts(empty(spark)).collect() == []


def test_a_bad_host_is_refused_by_the_usual_rate(spark):
    """Far below ``max_rate``, but several times the rate of the corpus; host "few" has the same rate on too few documents."""
    good, bad = " ".join(f"w{i}" for i in range(60)), "short"
    rows = [(i, bad if i // 10 % 50 == 0 else good, f"h{i % 10}") for i in range(1000)]
    rows += [(2000 + i, bad if i % 4 == 0 else good, "worse") for i in range(400)]
    rows += [(3000 + i, good if i else bad, "few") for i in range(4)]
    rows += [(4000, good, None)]
    got = {r["doc_id"]: r["kept"] for r in host_rules.host_verdicts(table(spark, rows)).collect()}
    assert got == {i: t == good and s != "worse" for i, t, s in rows}
    mild = {r["doc_id"]: r["kept"] for r in host_rules.host_verdicts(table(spark, rows), max_ratio=100.0).collect()}
    assert mild == {i: t == good for i, t, s in rows}


def test_small_hosts_are_joined(spark, monkeypatch):
    monkeypatch.setattr(host_rules, "LARGE_SHARE", 3)
    good, bad = " ".join(f"w{i}" for i in range(60)), "short"
    rows = [(i, good, "large") for i in range(300)] + [(1000 + i, bad if i % 2 else good, "worse") for i in range(100)]
    got = {r["doc_id"]: r["kept"] for r in host_rules.host_verdicts(table(spark, rows)).collect()}
    assert got == {i: s == "large" for i, _, s in rows}


def test_lines_and_words_that_one_hash_takes_for_equal(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{one}\n{other}\n{one}"), (2, f"{one} x y {other} x y"), (3, f"{one} x y {one} x y")]
    got = {r["doc_id"]: (r["n_dup_lines"], r["n_repeat_words"]) for r in host_rules.text_measures(table(spark, rows)).collect()}
    assert got == {1: (1, 0), 2: (0, 0), 3: (0, 6)}


def test_beta_prior():
    # Rates 0.1 and 0.5 on 1000 documents each: far more spread than chance.
    alpha, beta = host_rules.beta_prior(2, 2000, 600, 1000 * 0.01 + 1000 * 0.25)
    assert alpha / (alpha + beta) == pytest.approx(0.3, abs=1e-3) and alpha + beta < 6
    # No spread: the hosts are all one.
    alpha, beta = host_rules.beta_prior(2, 2000, 600, 2000 * 0.09)
    assert alpha + beta > 1e5
    assert host_rules.beta_prior(0, 0, 0, 0.0) == (1.0, 1.0)


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    path = public_tokenizers.path("piece_bpe_32k.model")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = language_id.languages(docs, path, 30).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    odd = docs.limit(0).unionByName(docs.selectExpr("doc_id", "cast(null as string) text", "lang", "source", "n_chars"))
    assert {r["lang_pred"] for r in language_id.languages(odd, path).collect()} == {"und"}
    assert language_id.languages(docs.limit(0), path).collect() == []


def test_forward_algorithm():
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = {piece: at for at, piece in enumerate(language_id.vocabulary(path), 1)}
    chances = np.random.default_rng(0).random((len(rows) + 1, 3)) * 1e-3
    chances[0] = 0.0
    model = language_id.Model(["a", "b", "c"], rows, chances)

    def total(word):
        """The sum over all segmentations, one by one."""
        if not word:
            return np.ones(3)
        result = np.zeros(3)
        for end in range(1, min(len(word), language_id.LONGEST_PIECE) + 1):
            row = rows.get(word[:end], 0)
            own = np.maximum(chances[row], language_id.FLOOR) if end == 1 else chances[row]
            if end == 1 or row:
                result = result + own * total(word[end:])
        return result

    for word in ("the", "nation", "größer", "ϖx"):
        model.learn({word})
        expected = np.log(total(language_id.MARK + word))
        assert np.allclose(model.logs[model.known[word]], expected)
        assert np.allclose(model._forward_long(word), expected)
    long = "ab" * 5000
    assert np.isfinite(model._forward_long(long)).all()
    assert model.predict([None, "", "12 .", long])[0][:3] == ["und"] * 3


def test_the_word_table_starts_anew(monkeypatch):
    monkeypatch.setattr(language_id, "KEPT_WORDS", 5)
    rows = {"▁": 1, "a": 2, "b": 3}
    chances = np.array([[0, 0], [0.2, 0.2], [0.7, 0.1], [0.1, 0.7]], dtype=float)
    model = language_id.Model(["x", "y"], rows, chances)
    texts = ["a" * i for i in range(1, 5)] + ["b" * i for i in range(1, 5)]
    got = [model.predict([t])[0][0] for t in texts] + model.predict(texts)[0]
    assert got == (["x"] * 4 + ["y"] * 4) * 2


def test_quality_of_held_out_rows():
    sf = TABLES.replace("sf0.001", "sf0.01")
    rows = duckdb.sql(
        f"SELECT d.doc_id, text, quality FROM '{sf}/documents.parquet' d JOIN '{sf}/labels.parquet' USING (doc_id) "
        "ORDER BY doc_id"
    ).fetchall()
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    known = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    model = quality_classifier.train([r[1] for r in known], [r[2] for r in known], epochs=5)
    scorer = quality_classifier.Scorer(*model)
    scores = np.array([scorer.score(r[1]) for r in held])
    good = np.array([r[2] == 1 for r in held])
    assert (scores[good][:, None] > scores[~good][None]).mean() > 0.97
    assert (scores[good] >= quality_classifier.LIMIT).mean() > 0.97


def test_scores_are_those_of_the_plain_model():
    random.seed(9)
    texts = ["good words here", "BAD!! BAD!! BAD!!", None, "", "more good text"]
    weights, bias = quality_classifier.train(texts[:2] * 5, [1, 0] * 5, buckets=1 << 12, epochs=10)
    scorer = quality_classifier.Scorer(weights, bias)
    for text in texts:
        features, counts = quality_classifier.text_features(text, 1 << 12)
        mean = float((weights[features] * counts).sum() / counts.sum()) if len(counts) else 0.0
        assert scorer.score(text) == pytest.approx(1 / (1 + np.exp(-(bias + mean))), abs=1e-5)
    assert scorer.score(texts[4]) > 0.5 > scorer.score(texts[1])


def test_the_order_of_words_counts():
    texts = ["red fish blue bird", "blue fish red bird"]
    scorer = quality_classifier.Scorer(*quality_classifier.train(texts * 20, [1, 0] * 20, buckets=1 << 12, epochs=20))
    assert scorer.score(texts[0]) > 0.6 and scorer.score(texts[1]) < 0.4


def test_labels_that_are_missing_or_double(spark):
    docs = table(spark, [(1, "fine text"), (2, "BAD!!"), (3, None), (3, "x"), (None, "y")])
    def labels(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, text string")

    none = quality_classifier.quality_scores(docs, labels([(1, None, "t")])).collect()
    assert {round(r["score"], 6) for r in none} == {0.5} and len(none) == 5
    one = quality_classifier.quality_scores(docs, labels([(1, 1, "t"), (1, 1, "t")])).collect()
    assert {round(r["score"], 6) for r in one} == {round(2 / 3, 6)}
    rows = quality_classifier.training_rows(
        docs, labels([(1, 1, "t"), (1, 0, "t"), (3, 1, "t"), (9, 1, "t")]), "quality", quality_classifier.F.lit(True), 10
    )
    assert sorted((r["doc_id"], r["label"], r["text"]) for r in rows.collect()) == [(1, 0, "fine text"), (3, 1, "x")]
    assert quality_classifier.quality_scores(empty(spark), labels([])).collect() == []
    with pytest.raises(ValueError):
        quality_classifier.scored(docs, (np.zeros(8, np.float32), 0.0), score="kind")
