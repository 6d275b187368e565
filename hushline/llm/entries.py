"""The registered queries of this subpackage: name to a function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hushline.llm import (
    ann, bpe, lm, merkle, minhash, oracles, packing, quality, spelling, substring, token_counts, toxicity, urls,
    warc,
)
from hushline.llm.shipping import ship
from hushline.llm.storage import written

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(
        docs, public_tokenizers.path("word_bpe_49k.json"), limit=packing.BUDGET, keep=["doc_id"]
    ).select("doc_id", "n_tokens")
    # Written, so that tokens are counted once for the histogram and the batches.
    return packing.packed(written(counted, "counted"), "n_tokens")


def op3_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


def op4_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(_table(spark, sf_dir, "pages"), html="html")


def op5_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_copies(_table(spark, sf_dir, "documents"))


def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_digests(_table(spark, sf_dir, "documents"))


def op8_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.verdicts(quality.ledger(_table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed",
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_bpe_round_trip, op2_length_buckets, op3_warc_captures, op4_url_templates, op5_near_copies,
        op6_nearest_vectors, op7_repeated_passages, op8_quality_ledger, op9_token_counts, op10_language_model,
        op11_spelling_variants, op12_merkle_manifest, op13_toxicity,
    )}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
