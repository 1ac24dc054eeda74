"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm import (ann, byte_bpe, collocations, html_content, mixing, pii, quality,
                          sharding, simhash, substrings, token_counts, toxicity, vector_codes)
from partflow.llm.common import prepare, read
from partflow.llm.oracle import ORACLE  # noqa: F401 - DuckDB SQL by query


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(prepare(spark), sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepare(spark), sf_dir, "documents")
    return pii.personal_data(docs.select("doc_id", "text"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepare(spark), sf_dir, "documents")
    return quality.quality(docs.select("doc_id", "lang", "source", "text")).drop(
        "lang", "source")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(prepare(spark), sf_dir, "pages").select("page_id", "url", "html")
    return html_content.main_texts(pages, html_content.fit_content(pages))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_corpus(read(prepare(spark), sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                  public_tokenizers.PATTERN)


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_substrings(read(prepare(spark), sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepare(spark), sf_dir, "documents")
    fold = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)), F.lit(-1))
    labels = read(spark, sf_dir, "labels").where(fold != 0)
    model = toxicity.fit_toxicity(docs, labels)
    return toxicity.toxicity(docs, *model).select(
        "doc_id", (fold == 0).alias("held_out"), "score", "predicted", "offending")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(prepare(spark), sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(prepare(spark), sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(prepare(spark), sf_dir, "embeddings"),
                       F.col("vec_id") % 20 == 0)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(prepare(spark), sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.vector_codes(read(prepare(spark), sf_dir, "embeddings"))
    return codes.withColumn("codebooks_sha256", F.lit(vector_codes.books_sha256(books)))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read(prepare(spark), sf_dir, "documents"), law="rows")


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_pii, op3_quality, op4_html, op5_byte_bpe, op6_substrings, op7_toxicity,
    op8_simhash, op9_token_counts, op10_ann, op11_collocations, op12_vector_codes,
    op13_sharding)}
