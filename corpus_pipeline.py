"""Corpus pipeline: classify quality, drop near-duplicates, decontaminate, mix sources, write tokens.

Each stage works on all its predecessor kept, read again from Parquet; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricewise.llm import poisson_mix, quality_gbt, rans_tokens, simhash_bytes, suffix_decontam
from pricewise.llm.common import stored, table
from pricewise.llm.queries import tokenizer_file


SEED = 42  # of the order of the token files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    model = quality_gbt.train(docs, table(spark, sf_dir, "labels"))
    return quality_gbt.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    return simhash_bytes.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return suffix_decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources weigh alike, globally shuffled."""
    return poisson_mix.poisson_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in a drawn order, as the mixing stage left its rows; per document what is read back from them."""
    return rans_tokens.token_output(docs, tokenizer_file("word_bpe_49k.json"), shuffle_seed=SEED)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("tokens", tokens)]

# The classifier, the fingerprints and the coder are beyond SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each stage's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
