"""A corpus pipeline of five operators: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read
again as the next stage's documents. All but the last keep the columns of documents.

1. toxicity: documents predicted toxic go. The model is learned from the labelled documents that are
   not held out.
2. near_duplicates: of each component of SimHash links one document stays.
3. repeated_spans: spans of 200 bytes that occur again are cut out of the texts.
4. secrets: secrets are replaced in the texts.
5. packing: one row per piece, with its place in a sequence of 4096 tokens.

Every stage keeps null and empty texts (the last packs them as the end id alone) and rows without a
doc_id, treats repeated rows alike (the second keeps one row of a group of copies), reads very long
texts whole, ignores other columns but passes them on up to the last, and gives an empty table for an
empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import packing, secrets, simhash, suffixes, toxicity
from tallyloom.llm.common import stored, table
from tallyloom.sources.storage import made_paths, remove_intermediates


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words_per_shingle=3, radius=3)


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(docs, span=200)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.without_secrets(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("repeated_spans", cut_repeated_spans),
    ("secrets", replace_secrets),
    ("packing", pack_documents),
]

#: SQL can express neither the models nor the fingerprints; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`. What a stage has written is deleted when its successor's rows are stored."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        earlier = len(made_paths(spark))
        docs = stored(stage(spark, docs, sf_dir), name)
        *within, result = made_paths(spark)[earlier:]
        remove_intermediates(spark, [*within, *before])
        before = [result]
    return STAGES[-1][1](spark, docs, sf_dir)
