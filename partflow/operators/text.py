"""Job C operators: split lines into words (FMP1), keyed running sum (AG1) and the
``word:::n`` projection (PRJ3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.functions.scalars import split_words, word_count_text
from partflow.operators.keyed import running_rank_of_items

# Documents per bucket of the running count (see operators/keyed.py): a word's rows are
# scanned per (word, doc-id range), so a very common word is spread over many tasks. The
# more documents in a bucket, the fewer of its words are new: one count travels for each.
DOCS_PER_BUCKET = 1024


def words(lines: DataFrame, text: str = "text", line_id: str = "doc_id") -> DataFrame:
    """One row per word: (line id, 1-based position, word)."""
    return lines.select(line_id, F.posexplode(split_words(text)).alias("pos", "word")) \
        .withColumn("pos", F.col("pos") + 1)


def word_count(lines: DataFrame, text: str = "text") -> DataFrame:
    """Final count per word, with its ``word:::n`` text. A grouped count: Spark
    combines map-side, so only one partial row per word and task is shuffled."""
    w = lines.select(F.explode(split_words(text)).alias("word"))
    counts = w.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("word", "n", word_count_text("word", "n").alias("line"))


def running_word_count(lines: DataFrame, text: str = "text", line_id: str = "doc_id",
                       docs_per_bucket: int = DOCS_PER_BUCKET) -> DataFrame:
    """The running total emitted on every word, in (line id, position) order: the
    per-event form of ``keyBy(word).sum(1)``."""
    ranked = running_rank_of_items(lines.select(line_id, text), split_words(text), "word",
                                   [line_id], F.floor(F.col(line_id) / docs_per_bucket), name="n")
    return ranked.select(line_id, "pos", "word", "n", word_count_text("word", "n").alias("line"))
