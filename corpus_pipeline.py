"""Corpus pipeline: quality filter, exact and near dedup, decontamination, token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept.  All but the last return the columns of ``documents``; the last one
returns the token ids of each document.

Null texts count as empty in every stage, whole texts are read however long,
and an empty table passes through as one.  Of equal or near-equal texts the
smallest id stays, null ids last; of rows that repeat id and text one stays.
Columns beyond those of ``documents`` come along, whatever they are called,
up to the last stage, which returns its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barlake.llm import decontaminate, exact_dedup, quality, sentencepiece, simhash
from barlake.llm.shared import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the classifier rejects go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model, only_kept=True)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of equal texts the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group linked at 3 bits the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents with a 10-word benchmark window go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: SentencePiece ids of each document, with the decoding check."""
    return sentencepiece.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece", encoding_stage),
]

# The classifier, the fingerprints and the tokenizer are not SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
