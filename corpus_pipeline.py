"""Corpus pipeline: quality rules, near copies, repeated passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hushline.llm import minhash, packing, quality, substring, token_counts
from hushline.llm.shipping import ship
from hushline.llm.storage import free_name, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    ship(spark)
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies (five-word shingles, similarity of 0.8 or more)."""
    ship(spark)
    return minhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that start anywhere else too."""
    ship(spark)
    return substring.without_repeats(docs, window=50)


def packing_in_buckets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their tokens counted and their place in a batch."""
    ship(spark)
    names = tuple(free_name(docs, name) for name in ("n_bytes", "n_tokens", "over_limit"))
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    counted = token_counts.with_token_counts(docs, vocabulary, limit=packing.BUDGET, names=names)
    # Written, so that tokens are counted once for the histogram and the batches.
    return packing.packed(written(counted, "counted"), names[1])


STAGES = [
    ("quality_rules", quality_rules), ("near_copies", near_copies), ("repeated_passages", repeated_passages),
    ("packing", packing_in_buckets),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each over what the one before has kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
