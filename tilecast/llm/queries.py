"""One query per operator over its whole table, with the parameters used in production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilecast.llm import (
    bpe, importance, minhash, mixing, perplexity, phrases, privacy, repeats, simhash, tokencount, topk, toxicity, weaklabels,
)
from tilecast.runtime import shared_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.classify(_table(spark, sf_dir, "documents"), labels, threshold=0.7)


def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "perplexity", "lower_band", "upper_band",
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(_table(spark, sf_dir, "documents"), share=1.5, most=2.0)
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken")
    )


def op4_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weaklabels.judge(_table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), distance=4, shingle=4)


def op7_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.report(_table(spark, sf_dir, "documents"), everywhere=True)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A cache of its own for every run, so that each run counts all texts.
    counts = tokencount.count_tokens(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        shared_path(spark, "token-cache"),
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.importance(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), share=10)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), percent=85, size=3)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), least=100, longest=5, most=2000)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_toxicity, op2_perplexity, op3_mixing, op4_weak_labels, op5_bpe, op6_simhash, op7_privacy,
        op8_token_counts, op9_repeats, op10_topk, op11_importance, op12_minhash, op13_phrases,
    )
    return {f.__name__: f for f in found}
