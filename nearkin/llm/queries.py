"""The operators of this subpackage as registered queries."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.llm import (
    block_dedup,
    byte_bpe,
    decontaminate,
    filter_audit,
    host_rules,
    jaccard_join,
    kmeans_tree,
    language_id,
    orc_tokens,
    quality_classifier,
    suffix_dedup,
    token_counts,
    vector_codes,
)
from nearkin.llm.common import documents
from nearkin.llm.oracle import ORACLE  # noqa: F401

BPE_50K = "byte_bpe_50k.json"
PIECES_32K = "piece_bpe_32k.model"
MULTI_50K = "byte_bpe_multi_50k.tiktoken"
END_ID = 2
TOKEN_LIMIT = 512
QUERY_STEP = 20


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BPE_50K)
    counts = token_counts.token_counts(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_verdicts(documents(spark, sf_dir))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(documents(spark, sf_dir))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(MULTI_50K)
    return byte_bpe.encode_decode(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(documents(spark, sf_dir), public_tokenizers.path(PIECES_32K))


def op7_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_dedup.digest(documents(spark, sf_dir))


def op8_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BPE_50K)
    return orc_tokens.written_and_read(documents(spark, sf_dir), path, public_tokenizers.PATTERN, END_ID)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(documents(spark, sf_dir))



def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))



def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.search(table(spark, sf_dir, "embeddings"), QUERY_STEP)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_decontamination,
        op3_host_rules,
        op4_suffix_dedup,
        op5_byte_bpe,
        op6_language_id,
        op7_block_dedup,
        op8_orc_token_ids,
        op9_quality_classifier,
        op10_jaccard_join,
        op11_filter_audit,
        op12_nearest_neighbours,
        op13_vector_codes,
    )
}
