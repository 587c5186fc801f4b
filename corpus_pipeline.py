"""The corpus pipeline: from raw documents to verified token sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of the documents. Stages take what their predecessor kept and
nothing else of the documents; labels and benchmark items are read from
``sf_dir``. Document ids should be unique: of several rows with one id the second
stage keeps the first by text. Rows with a NULL id pass all stages by themselves.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nearkin.llm import block_dedup, byte_bpe, decontaminate, jaccard_join, quality_classifier
from nearkin.llm.common import documents, kept, shared_folder

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have; columns of any name may come along."""
    while name in {column.lower() for column in docs.columns}:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at its limit or above."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = quality_classifier.fold(F.col("doc_id"), quality_classifier.FOLDS) != quality_classifier.HELD_OUT
    rows = quality_classifier.training_rows(docs, labels, "quality", learn, quality_classifier.TRAIN_ROWS)
    name = free_name(docs, "score")
    scored = quality_classifier.scored(docs, quality_classifier.fit(rows), score=name)
    return scored.filter(F.col(name) >= quality_classifier.LIMIT).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest id."""
    linked = jaccard_join.linked(docs)
    losers = kept(linked.filter("component_id <> doc_id").select("doc_id").distinct())
    nth = free_name(docs, "nth")
    first = F.row_number().over(W.partitionBy("doc_id").orderBy("text"))
    left = docs.join(losers, "doc_id", "left_anti").withColumn(nth, first)
    return left.filter((F.col(nth) == 1) | F.col("doc_id").isNull()).drop(nth)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stretches of words that also occur earlier are cut out; texts without any stay as they are."""
    left = free_name(docs, "kept")
    removed = block_dedup.remove_repeats(docs).filter("n_removed > 0").select("doc_id", F.col("kept").alias(left))
    text = F.coalesce(left, "text")
    changed = F.when(F.col(left).isNotNull(), F.length(left).cast("long")).otherwise(F.col("n_chars"))
    joined = docs.join(removed, "doc_id", "left")
    columns = {"text": text.alias("text"), "n_chars": changed.alias("n_chars")}
    return joined.select(*[columns.get(name, F.col(name)) for name in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes."""
    return byte_bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

# The first stage trains a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents table, each written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
