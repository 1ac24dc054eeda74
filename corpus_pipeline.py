"""A training corpus from ``documents``: quality rules, near-dedup, personal data, mixing,
encoding. Each stage works on all that the one before kept; its result is written and read
again as the next one's input.

1. Quality rules: documents that fail the base rules or lie far out of their language's and
   source's statistics go.
2. SimHash near-dedup: one row of each group of near copies stays, whatever keys they carry.
3. PII: spans are replaced by their kind in brackets.
4. Mixing: documents are repeated or left out so that sources reach their target shares.
5. Byte-level BPE: one row of token ids per document, with digests of ids and decoded bytes.

Null texts fail the base rules, so none reaches stage 2; an empty table passes through all
stages as an empty table. Rows with a null key are kept or dropped by their text alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm import byte_bpe, mixing, pii, quality, simhash
from partflow.llm.common import prepare, read, store


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.quality_documents(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return byte_bpe.encode_corpus(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                  public_tokenizers.PATTERN, keep_ids=True)


STAGES = [("quality rules", quality_stage), ("SimHash near-dedup", dedup_stage),
          ("PII", pii_stage), ("mixing sources to target weights", mixing_stage),
          ("byte-level BPE encoding and decoding", encoding_stage)]

#: Robust estimates, boosted trees and random rounding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
