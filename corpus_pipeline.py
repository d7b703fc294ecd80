"""A training corpus from raw documents: STAGES in order, each over what its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm import bpe, classifier, decontam, jaccard, suffix_dedup
from rowsmith.llm.text import small_batches
from rowsmith.session import scratch_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return classifier.keep_quality(small_batches(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.keep_one(small_batches(docs))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that repeat earlier ones."""
    return suffix_dedup.strip(small_batches(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item or a variant of one."""
    return decontam.clean(small_batches(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of each document, and their text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = bpe.decode(bpe.encode(small_batches(docs), path), path, name="text")
    return found.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

# Models, components and token ids can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
