"""The corpus pipeline, stage by stage against brute force on each stage's own input."""
import hashlib
import random
from collections import Counter

import pytest

import corpus_pipeline as C
from test_dedup import components, simhash
from test_rules import EMAIL, PHONE, counts, prose

P = pytest.importorskip("public_tokenizers")


def corpus():
    rnd = random.Random(12)
    clean = [prose(rnd, rnd.randrange(60, 300)) for _ in range(160)]
    texts = list(clean)
    for t in clean[:20]:                       # exact and near copies
        words = t.split()
        words[rnd.randrange(len(words))] = "changed"
        texts += [t, " ".join(words)]
    for i, t in enumerate(clean[20:50]):       # personal data
        texts.append(f"{t} write to me{i}@mail{i}.example.com or +1 (2{i:02d}) 555-01{i:02d}")
    texts += [" ".join(w + "###$$$" for w in prose(rnd, 200).split()) for _ in range(8)]
    texts += [None, "", "too short", "again and again " * 40]
    return [(i, t, "en" if i % 4 else None, rnd.choice(["a", "b", "b", "b", None]))
            for i, t in enumerate(texts)]


def test_stages_in_order():
    assert [n for n, _ in C.STAGES] == [
        "quality rules", "SimHash near-dedup", "PII", "mixing sources to target weights",
        "byte-level BPE encoding and decoding"]
    assert C.ORACLE_SQL is None


def test_each_stage_against_brute_force(spark, docs_of, tmp_path):
    import base64

    import tiktoken

    from partflow.llm.common import store
    docs = store(docs_of(corpus()), "test-documents")
    rows = {r.doc_id: r for r in docs.collect()}

    kept = store(C.STAGES[0][1](spark, docs, ""), "test-1")
    assert kept.columns == docs.columns
    got = {r.doc_id for r in kept.collect()}
    passed = {k for k, r in rows.items() if not counts(r.text)[-1]}
    junk = {k for k in passed if "###$$$" in rows[k].text}
    assert got == passed - junk and len(junk) == 8

    single = store(C.STAGES[1][1](spark, kept, ""), "test-2")
    ids = sorted(got)
    group = components([simhash(rows[k].text) for k in ids], 3)
    firsts = {g: min(k for k, h in zip(ids, group) if h == g) for g in set(group)}
    assert sorted(r.doc_id for r in single.collect()) == sorted(firsts.values())
    assert len(firsts) < len(ids) - 15

    clean = store(C.STAGES[2][1](spark, single, ""), "test-3")
    for r in clean.collect():
        want = PHONE.sub("[PHONE]", EMAIL.sub("[EMAIL]", rows[r.doc_id].text))
        assert r.text == want and r.n_chars == len(want)
        assert (r.lang, r.source) == (rows[r.doc_id].lang, rows[r.doc_id].source)

    from partflow.llm.mixing import mix
    mixed = store(C.STAGES[3][1](spark, clean, ""), "test-4")
    plan = mix(clean).collect()
    out = mixed.collect()
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in out) == Counter(
        {r.doc_id: r.copies for r in plan if r.copies})
    for s in {r.source for r in plan}:
        own = [r for r in plan if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)

    coded = C.STAGES[4][1](spark, mixed, "").collect()
    ranks = {base64.b64decode(a): int(b) for a, b in
             map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert Counter((r.doc_id, tuple(r.ids), r.n_tokens) for r in coded) == Counter(
        (r.doc_id, tuple(enc.encode_ordinary(r.text)), len(enc.encode_ordinary(r.text)))
        for r in out)
    digest = {hashlib.sha256(r.text.encode()).hexdigest() for r in out}
    assert {r.decoded_sha256 for r in coded} == digest


def test_run_reads_the_documents_and_takes_an_empty_table(spark, docs_of, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    docs_of(corpus()[:60]).write.parquet(path)
    out = C.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert 30 < out.count() < 180
    empty = f"{tmp_path}/none"
    docs_of([]).write.parquet(f"{empty}/documents.parquet")
    assert C.run(spark, empty).collect() == []
