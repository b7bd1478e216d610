"""The corpus pipeline: quality, near copies, benchmark passages, mixing, token shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vidsift.llm import decontam, mixing, quality, simhash, tokenbin
from vidsift.llm.common import Scratch
from vidsift.llm.queries import tokenizer_file
from vidsift.session import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: SimHash candidates of 0.8 or more over five-word shingles."""
    return simhash.drop_near_copies(docs, shingle=5, similarity=0.8)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token shards hold of each document."""
    return tokenbin.encode_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_copies_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", token_stage),
]

#: The classifier, fingerprints and the tokenizer are out of SQL's reach; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = scratch.save(docs, f"stage{n}")
    return docs
