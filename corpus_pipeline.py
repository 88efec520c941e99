"""Corpus pipeline: quality rules, near duplicates, repeated passages, packing.

Each stage works on all that the one before kept. The first two drop documents, the third cuts text, the last
returns the place of every piece of every document in the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trolley.llm import minhash, packing, quality, repeats
from trolley.llm.common import table
from trolley.session import stage, tune

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; references come from the documents given."""
    tune(spark)
    return quality.keep(docs, quality.fit_references(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by a similarity of 0.8 or more on shingles of five words."""
    tune(spark)
    return minhash.keep_one(docs, minhash.Settings(shingle=5))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur more than once go from the texts; every document stays."""
    tune(spark)
    return repeats.remove_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece in sequences of 4096 tokens."""
    tune(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), CAPACITY)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("best_fit_packing", best_fit_packing),
]
#: The sorts of suffixes, the tokenizer and the packing have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
