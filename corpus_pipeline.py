"""A training corpus from ``documents``: five stages, each written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table. All but the last return the
columns of ``documents``; the last returns token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import tilecast
from tilecast.llm import bpe, mixing, perplexity, privacy, simhash
from tilecast.runtime import materialize

cloudpickle.register_pickle_by_value(tilecast)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the counts or lie outside their language's perplexity bands go."""
    return perplexity.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash.deduplicate(docs, distance=4, shingle=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, terms that disclose it are generalised or removed."""
    return privacy.sanitise(docs, everywhere=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document that is taken twice has two rows."""
    return mixing.mix(docs, share=1.5, most=2.0)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"], with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixing", mixed),
    ("bpe_tokens", encoded),
]

#: SQL can express neither fingerprints nor merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
