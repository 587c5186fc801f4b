"""The pipeline and the registered queries of the subpackage."""

import weakref
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from checks import compare
from nearkin.llm import byte_bpe, quality_classifier, queries
from tests.llm import helpers

SF_DIR = helpers.TABLES


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


def test_everything_is_registered():
    names = set(contract.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(contract.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_its_sql(spark, connection, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    relation = connection.sql(queries.ORACLE[name])
    order = sorted(df.columns)
    assert order == sorted(relation.columns)
    ours = sorted(tuple(r) for r in df.select(order).collect())
    places = [relation.columns.index(c) for c in order]
    assert ours == sorted(tuple(r[i] for i in places) for r in relation.fetchall())


def test_stages_one_by_one(spark):
    given = queries.documents(spark, SF_DIR)
    columns = given.columns
    docs = {r["doc_id"]: r["text"] for r in given.collect()}
    table = given
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, table, SF_DIR).collect()
        ids = [r["doc_id"] for r in result]
        assert len(ids) == len(set(ids)) and set(ids) <= set(docs)
        before = {r["doc_id"]: r["text"] for r in table.collect()}
        if name == "near_duplicates":
            expected = {c for [(_, c)] in helpers.linked(before.items()).values()}
            assert set(ids) == expected
        if name == "substrings":
            cut = helpers.removed_words(before.items(), 20)
            for row in result:
                [(_, removed, _)] = cut[row["doc_id"]]
                assert (row["text"] == before[row["doc_id"]]) == (removed == 0)
                assert row["n_chars"] == len(row["text"]) or removed == 0
        if name == "tokens":
            assert set(ids) == set(before)
        else:
            assert list(result[0].asDict()) == columns
            table = spark.createDataFrame(result, given.schema)
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, result))


def test_odd_rows_pass(spark):
    given = queries.documents(spark, SF_DIR)
    odd = spark.createDataFrame(
        [(900_001, None, None, None, None), (900_001, None, None, None, None), (None, "", "en", "s", 0)], given.schema
    )
    clashing = ["score", "nth", "kept", "_nth", "_kept"]
    table = odd.select("*", *[F.lit("mine").alias(name) for name in clashing])
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        table = spark.createDataFrame(stage(spark, table, SF_DIR).collect(), table.schema)
        assert {r["doc_id"] for r in table.collect()} == {900_001, None}
        assert {r[name] for r in table.collect() for name in clashing} == {"mine"}
    assert table.count() == 2
    scored = corpus_pipeline.quality(spark, given.withColumn("score", F.lit("clash")), SF_DIR)
    assert scored.columns == [*given.columns, "score"] and scored.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, given.limit(0), SF_DIR).collect() == []


def test_a_worker_holds_one_thing_at_a_time():
    """Of what the stages of a pipeline gather only the last one's stays."""
    first = byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    assert byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN) is first
    gone = weakref.ref(first)
    del first
    weights = np.zeros(quality_classifier.BUCKETS, "<f4")
    model = SimpleNamespace(value=(weights.tobytes(), 0.0))
    scorer = quality_classifier._scorer("some model", model)
    assert gone() is None
    assert quality_classifier._scorer("some model", model) is scorer
