"""A corpus pipeline out of the llm operators: ``documents`` to training tokens.

Each stage takes the session, the documents that the stage before has left, and
the folder of the tables; all but the last return the columns of ``documents``, any
further ones too.

NULL texts and those without words are rejected by the first stage; a stage that
gets some all the same keeps them as documents of no size. NULL ids, languages
and sources are values like others; rows that are equal in id and text are copies,
of which the second stage leaves one. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cellmeter.llm import encoding, jaccard_join, mixing, quality, substring_dedup
from cellmeter.staging import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    return quality.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has."""
    return substring_dedup.without_repeats(docs, length_col="n_chars")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document of the mix, with digests of them and of what they decode to."""
    return encoding.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", token_ids),
]

# Compression ratios, MinHash links and BPE are beyond SQL; the tests compare
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
