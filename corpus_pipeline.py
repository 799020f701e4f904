"""The training-data pipeline: documents through five stages, each written as Parquet and read again.

No stage past the first has an SQL form of its decisions on this input (language models, similarity joins and
token ids are not SQL), so ORACLE_SQL is None and the tests hold run() against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martkit.llm import blocks, langid, minmax, mixing, spbpe
from martkit.sources.layers import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear stay."""
    return langid.accepted_documents(docs, langid.learn_languages(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return blocks.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words, similarity 0.8 or more."""
    return minmax.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests that tell them and their decoding apart."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return spbpe.encode_documents(docs, path, public_tokenizers.PATTERN, decoded=False)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
