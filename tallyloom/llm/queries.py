"""The registered queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import byte_bpe, context_tree, fingerprint, language, licenses, packing, quality, repair, secrets, simhash, suffixes, toxicity, whitening
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed_documents(table(spark, sf_dir, "documents"), path, capacity=4096, end_id=1)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_digest(table(spark, sf_dir, "documents"), span=200)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents")).drop("spans")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), host="source")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_digest(table(spark, sf_dir, "documents"), path)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=3, radius=3)


def op10_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scored(table(spark, sf_dir, "documents"))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repairs(table(spark, sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=32)


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_best_fit_packing,
        op3_secret_scan,
        op4_suffix_array_dedup,
        op5_license_scan,
        op6_quality_rules,
        op7_fingerprints,
        op8_byte_bpe,
        op9_simhash_near_dedup,
        op10_context_tree_scores,
        op11_language,
        op12_conversation_repair,
        op13_embedding_whitening,
    )
} | {"pipeline": corpus_pipeline.run}
ORACLES: dict[str, str] = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
