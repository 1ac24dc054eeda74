"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of its distinct
words and their beginnings; the document's score is the noisy-or of its sentences,
1 - prod(1 - p). The weights are trained from document labels alone, through the noisy-or,
so that blame settles on the sentences that explain the label; scoring then also locates the
offending ones.

Training uses a bounded sample of labelled rows (``TRAIN_ROWS``); scoring reads every text.
Null and empty texts have no sentence and get the score of one empty sentence. Documents
with several labels count as toxic if one label says so; null labels are left out. Where no
label is left, every score is 0.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import hash_sample, text_of, texts

#: Most labelled rows that training uses.
TRAIN_ROWS = 6000
#: Documents of one label that hold a feature; standard errors. (The number of features is
#: bounded by the words of the sample.)
LEAST, SURE = 5, 5.0
#: Words whose weight a task keeps at most.
MOST_KNOWN = 1_000_000

#: A sentence end, or a word.
PIECE = re.compile(r"[.!?\n]+|[^\W\d_]+")
WORD = re.compile(r"[^\W\d_]+")


def bags(text: str) -> list[tuple[int, int, set[str]]]:
    """(start, end, distinct words) of each sentence that has a word."""
    out, words, start, end = [], set(), 0, 0
    for m in PIECE.finditer(text):
        w = m.group().lower()
        if w[0] in ".!?\n":
            if words:
                out.append((start, m.end(), words))
                words = set()
        else:
            if not words:
                start = m.start()
            words.add(w)
            end = m.end()
    if words:
        out.append((start, end, words))
    return out


def parts(word: str) -> tuple[str, ...]:
    """What a word is known by: itself and its beginnings, which catch inflected forms."""
    return tuple(dict.fromkeys((word, word[:4] + "-", word[:5] + "-")))


def distinct(sample: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """One of each group of near copies, told by the least hash of their three-word windows:
    copies of one document must not make its words look typical."""
    seen, out = set(), []
    for t, y in sample:
        words = t.lower().split()
        mark = min((zlib.crc32(" ".join(words[i:i + 3]).encode())
                    for i in range(max(1, len(words) - 2))))
        if (mark, y) not in seen:
            seen.add((mark, y))
            out.append((t, y))
    return out


def train(sample: list[tuple[str, int]], epochs: int = 60, l2: float = 1e-4,
          rate: float = 0.5) -> tuple[dict[str, float], float]:
    """(weights, bias) from (text, label) pairs by full-batch Adagrad on the noisy-or's
    log-likelihood. Features that ``LEAST`` documents of a label don't hold, or whose share
    in both labels differs by less than ``SURE`` standard errors, get no weight.
    Deterministic."""
    sample = distinct(sample)
    if not sample:
        return {}, -700.0
    y = np.array([float(v) for _, v in sample])
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for t, v in sample:
        seen[int(v > 0)].update({f for w in {x.lower() for x in WORD.findall(t)}
                                for f in parts(w)})
    n0, n1 = max(1.0, (y == 0).sum()), max(1.0, (y > 0).sum())
    chosen = []
    for f in set(seen[0]) | set(seen[1]):
        a, b = seen[0][f], seen[1][f]
        if max(a, b) >= LEAST:
            share = (a + b) / (n0 + n1)
            error = math.sqrt(max(share * (1 - share), 1e-12) * (1 / n0 + 1 / n1))
            if abs(b / n1 - a / n0) >= SURE * error:
                chosen.append((-a - b, f))
    vocab = {f: i for i, (_, f) in enumerate(sorted(chosen))}
    del seen, chosen
    feature, sent, sent_doc = [], [], []
    for i, (t, _) in enumerate(sample):
        for _, _, s in bags(t) or [(0, 0, set())]:
            own = sorted(vocab[f] for w in s for f in parts(w) if f in vocab)
            feature += own
            sent += [len(sent_doc)] * len(own)
            sent_doc.append(i)
    feature, sent, sent_doc = (np.array(x, np.int64) for x in (feature, sent, sent_doc))
    n_sent, n_doc = len(sent_doc), len(sample)
    w, gw = np.zeros(len(vocab)), np.full(len(vocab), 1e-8)
    b, gb = math.log(max(y.mean(), 1e-3) / n_sent * n_doc) - 1, 1e-8
    for _ in range(epochs):
        z = b + np.bincount(sent, w[feature], n_sent)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        log_none = np.bincount(sent_doc, np.log1p(-np.minimum(p, 1 - 1e-9)), n_doc)
        bag = np.clip(-np.expm1(log_none), 1e-9, 1)
        slope = p * ((y - bag) / bag)[sent_doc]            # d log-likelihood / dz
        g = np.bincount(feature, slope[sent], len(vocab)) / n_doc - l2 * w
        gw += g * g
        w += rate * g / np.sqrt(gw)
        d = slope.sum() / n_doc
        gb += d * d
        b += 0.3 * rate * d / math.sqrt(gb)
    return {f: float(w[i]) for f, i in vocab.items() if abs(w[i]) > 1e-3}, float(b)


class Words(dict):
    """The summed weight of a word's parts, worked out once per word."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > MOST_KNOWN:
            self.clear()
        x = self[word] = sum(self.weights.get(f, 0.0) for f in parts(word))
        return x


def score_text(text: str, known: Words, bias: float,
               least: float) -> tuple[float, list[tuple[int, int, float]]]:
    """(document score, sentences whose own score is ``least`` or more)."""
    none, found = 1.0, []
    for start, end, words in bags(text) or [(0, 0, ())]:
        z = bias
        for w in words:
            z += known[w]
        p = 1 / (1 + math.exp(min(700.0, max(-30.0, -z))))
        none *= 1 - p
        if p >= least:
            found.append((start, end, p))
    return 1 - none, found


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id",
                 text: str = "text", label: str = "toxic",
                 rows: int = TRAIN_ROWS) -> tuple[dict[str, float], float]:
    """Train on at most about ``rows`` labelled documents, chosen by a hash of their key (of
    rows that share one, the first text by code points).
    The sample's keys are broadcast (bounded by ``rows``), the texts of those documents are
    read and the model is trained from them."""
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(key).alias("k")).agg(F.max(label).cast("int").alias("y")))
    picked = hash_sample(known, F.col("k"), rows)
    chosen = (docs.select(F.col(key).alias("k"), text_of(text).alias("t"))
              .join(F.broadcast(picked), "k")
              .groupBy("k").agg(F.min("t").alias("t"), F.first("y").alias("y")))
    got = chosen.select("k", "t", "y").toArrow().sort_by([("k", "ascending"),
                                                          ("t", "ascending")])
    return train(list(zip(got.column("t").to_pylist(), got.column("y").to_pylist())))


def toxicity(docs: DataFrame, weights: dict[str, float], bias: float, key: str = "doc_id",
             text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: key, score, predicted, and the offending sentences as
    (start, end, score) in characters."""
    offending = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                    ("score", pa.float64())]))
    out = pa.schema([("k", pa.int64()), ("score", pa.float64()), ("offending", offending)])
    kind = docs.schema[key].dataType.simpleString()

    def rows(batches):
        known = Words(weights)
        for b in batches:
            got = [score_text(t, known, bias, threshold) for t in texts(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([max(0.0, min(1.0, s)) for s, _ in got], pa.float64()),
                 pa.array([[dict(zip(("start", "end", "score"), f)) for f in fs]
                           for _, fs in got], offending)], schema=out)

    scored = docs.select(F.col(key).cast("bigint").alias("k"), text_of(text).alias("t")
                         ).mapInArrow(rows, "k bigint, score double, offending array<struct"
                                            "<start:int, end:int, score:double>>")
    return scored.select(F.col("k").cast(kind).alias(key), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"),
                         "offending")
