"""Byte-level BPE and token counts against the tokenizer libraries themselves."""
import base64
import hashlib
import os
import random

import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
P = pytest.importorskip("public_tokenizers")

from odd import ODD  # noqa: E402


def ranks_encoding():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in
             map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def wild(seed, n):
    rnd = random.Random(seed)
    alphabet = "aB9 '.\n\téçő中٣́\U0001f600  $_"
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(200))) for _ in range(n)]


def test_byte_bpe(docs_of):
    from partflow.llm.byte_bpe import encode_corpus
    texts = ODD + wild(1, 60)
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)] + [(3, "a", "en", "a"),
                                                                (None, "null key", "en", "a")]
    got = encode_corpus(docs_of(rows).repartition(5), P.path("byte_bpe_50k.tiktoken"),
                        P.PATTERN, keep_ids=True, block_chars=9000).collect()
    assert len(got) == len(rows)
    enc = ranks_encoding()

    def want(k, t):
        ids = enc.encode_ordinary(t or "")
        return (k, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest(), tuple(ids))
    assert sorted(((r[0], r[1], r[2], r[3], tuple(r[4])) for r in got), key=str) == \
        sorted((want(k, t) for k, t, _, _ in rows), key=str)


def test_byte_bpe_empty_table(docs_of):
    from partflow.llm.byte_bpe import encode_corpus
    out = encode_corpus(docs_of([]), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert out.collect() == []
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json",
                                  "piece_bpe_32k.model"])
def test_token_counts(docs_of, file):
    from partflow.llm.token_counts import token_counts
    long = " ".join(wild(2, 300)) + "<|endoftext|>" + "y" * 3000 + " z"
    texts = ODD + wild(3, 40) + [long, "q" * 9000, " " * 9000 + "end"]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)] + [(None, "null key", "en", "a")]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in
           token_counts(docs_of(rows), P.path(file), chunk_chars=1500, overlap=40).collect()}
    if file.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=P.path(file))
        count = lambda t: len(sp.encode(t))
    else:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(P.path(file))
        count = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    want = {}
    for k, t, _, _ in rows:
        n = count(t or "")
        want[k] = (len((t or "").encode()), n, n > 1024)
    assert got == want


def test_splice_widens_its_overlap():
    from partflow.llm.token_counts import load_counter, spliced
    _, encode = load_counter(P.path("byte_bpe_50k.json"))
    text = "start " + "nobreak" * 400 + " middle " + "é中" * 700 + " end. " * 90
    for chunk, overlap in ((200, 5), (64, 8), (1000, 1), (5000, 100)):
        assert spliced(text, encode, chunk, overlap) == encode(text)[0]


def test_token_counts_extra_columns_and_empty(spark, docs_of):
    from pyspark.sql import functions as F

    from partflow.llm.token_counts import token_counts
    docs = docs_of(["a b"]).withColumn("n_tokens", F.lit(7)).withColumn("k", F.lit("x"))
    path = P.path("byte_bpe_50k.json")
    assert [tuple(r) for r in token_counts(docs, path).collect()] == [(0, 3, 2, False)]
    assert token_counts(docs_of([]), path).collect() == []
