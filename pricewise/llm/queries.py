"""Registered queries of the corpus operators, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.llm import (dom_marginals, fim_skiplist, license_scan, merkle_paths, poisson_mix, quality_gbt,
                           rans_tokens, ring_shards, secret_tests, simhash_bytes, srs_neighbours, suffix_decontam,
                           token_counts)
from pricewise.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op1_decontamination")
def op1(spark, sf_dir):
    return suffix_decontam.contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                                         table(spark, sf_dir, "benchmark")).drop("items")


@register("op2_poisson_mix", poisson_mix.mix_sql())
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    # the text's digest is taken after the shuffle: the query moves whole documents
    return (poisson_mix.poisson_mix(docs, extra=True).withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))
            .drop("text").withColumn("rate", F.round("rate", 6)))


@register("op3_rans_tokens")
def op3(spark, sf_dir):
    return rans_tokens.token_output(table(spark, sf_dir, "documents", "doc_id", "text"),
                                    tokenizer_file("word_bpe_49k.json"))


@register("op4_licenses")
def op4(spark, sf_dir):
    return license_scan.scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op5_srs_neighbours")
def op5(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return srs_neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@register("op6_ring_shards")
def op6(spark, sf_dir):
    return ring_shards.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op7_simhash")
def op7(spark, sf_dir):
    return simhash_bytes.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text_hash")


@register("op8_token_counts")
def op8(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents", "doc_id", "text"),
                                     tokenizer_file("byte_bpe_50k.json"))


@register("op9_secrets")
def op9(spark, sf_dir):
    return secret_tests.secret_report(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op10_quality")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_gbt.score(docs, quality_gbt.train(docs, table(spark, sf_dir, "labels")))


@register("op11_fill_in_middle", fim_skiplist.fim_sql())
def op11(spark, sf_dir):
    return fim_skiplist.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op12_merkle_manifest", merkle_paths.audit_sql())
def op12(spark, sf_dir):
    return merkle_paths.audit(table(spark, sf_dir, "documents", *merkle_paths.COLUMNS))


@register("op13_page_text")
def op13(spark, sf_dir):
    return dom_marginals.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"),
                                 dom_marginals.default_model(spark))
