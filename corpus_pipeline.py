"""A training-data pipeline of five stages over ``documents``.

Each stage is a function of (spark, docs, sf_dir) and works on all rows that
the one before it kept.  The stages judge what they are given: the classifier
is fitted on the labelled rows among its own documents.  A null or empty text is
rejected by the rules; an empty table passes through as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from habitra.llm import packing, quality_fm, quality_rules, simhash, suffix_dedup
from habitra.llm.common import materialise, table
from habitra.llm.queries import WORD_BPE, tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores 0.7 or more."""
    return quality_fm.keep(docs, quality_fm.fit(docs, table(spark, sf_dir, "labels"), "quality", metadata=("n_chars",)))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the policy."""
    return quality_rules.keep(docs, "v1")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group of near copies: five-word shingles alike to 0.8 or more."""
    return simhash.keep_one(docs, shingle=5, similarity=0.8)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 bytes or more that a document with a lesser id has too."""
    return suffix_dedup.strip_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most 4096 tokens."""
    return packing.pack(docs, tokenizer_path(WORD_BPE), end_id=1, capacity=4096)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_removal),
    ("best_fit_packing", best_fit_packing),
]

#: The stages hold a fitted model, fingerprints, byte spans and a tokenizer, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
