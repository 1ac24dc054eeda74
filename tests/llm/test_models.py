"""HTML extraction, toxicity and nearest neighbours: held-out accuracy and brute force."""
import random
import zlib

import numpy as np
import pytest

from odd import ODD


def page(rnd, n):
    words = [f"w{rnd.randrange(500)}" for _ in range(n)]
    return " ".join(words)


def make_page(rnd, wrap="article"):
    paras = [page(rnd, rnd.randrange(15, 80)) + " &amp; caf&eacute;" for _ in range(rnd.randrange(2, 6))]
    body = "".join(f"<p>{p}</p>" if i % 3 else f"<p><b>{p}<br><p>more <i>in</i>line" for i, p
                   in enumerate(paras))
    want = ["Title here"]
    for i, p in enumerate(paras):
        p = p.replace("&amp;", "&").replace("&eacute;", "é")
        want += [p] if i % 3 else [p, "more inline"]
    source = (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style>"
              f"<script>var t='</p>';</script></head><body><nav><ul>"
              + "".join(f"<li><a href='/{i}'>{page(rnd, 1)}</a></li>" for i in range(6))
              + f"</ul></nav><!-- x --><div class='ad'>{page(rnd, 6)}</div><{wrap}>"
              f"<h1>Title\n here</h1>{body}</{wrap}>"
              f"<section class='comments'><p>{page(rnd, 20)}</p></section>"
              f"<aside id=side-bar><p>{page(rnd, 8)}</p></aside>"
              f"<footer>&copy; {page(rnd, 5)}</footer>"
              + ("</body></html>" if rnd.random() < 0.9 else ""))
    return source, "\n".join(want)


def test_html_content(spark):
    from partflow.llm.common import prepare
    from partflow.llm.html_content import fit_content, main_texts
    prepare(spark)
    rnd = random.Random(2)
    made = [make_page(rnd) for _ in range(120)]
    rows = [(i, f"u{i}", s) for i, (s, _) in enumerate(made)]
    rows += [(900, "n", None), (901, "e", ""), (None, None, made[0][0]), (0, "u0", made[0][0]),
             (902, "x", "<p"), (903, "x", "</p></div><<>" + "<div>" * 3000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = main_texts(pages, fit_content(pages)).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert [text[i] for i in range(len(made))] == [w for _, w in made]
    assert text[900] == text[901] == "" and text[None] == made[0][1]
    assert all(r.n_chars == len(r.text) for r in got)
    none = pages.limit(0)
    assert main_texts(none, fit_content(none)).collect() == []


def test_html_model_reads_more_than_tags():
    """A page whose article stands in a div without a telling name."""
    from partflow.llm.html_content import Model, Page
    rnd = random.Random(5)
    model = Model([make_page(rnd)[0] for _ in range(100)])
    source, want = make_page(rnd, wrap="div")
    assert model.main_text(source) == want
    p = model.marginals(Page(source))
    assert all(0 <= x <= 1 for x in p)


def test_sum_product_equals_enumeration():
    import itertools
    import math

    from partflow.llm.html_content import Model, Page
    rnd = random.Random(6)
    model = Model([make_page(rnd)[0] for _ in range(20)])
    p = Page("<body><div class=ad>x</div><div><p>some words of text</p><p>more</p></div></body>")
    own = []
    for f in p.features():
        x = sum(max(-8.0, min(8.0, model.mark.get(w, 0.0))) for w in f)
        q = 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))
        own.append((1 - q, q))
    own[0] = (1.0, 0.0)
    n, total, content = len(own), 0.0, [0.0] * len(own)
    for state in itertools.product((0, 1), repeat=n):
        w = math.prod(own[i][state[i]] for i in range(n)) * math.prod(
            model.pair[state[p.parent[i]]][state[i]] for i in range(1, n))
        total += w
        for i in range(n):
            content[i] += w * state[i]
    assert np.allclose(model.marginals(p), [c / total for c in content])


def toxic_corpus(seed, n):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        sentences = [[f"word{rnd.randrange(900)}" for _ in range(rnd.randrange(4, 15))]
                     for _ in range(rnd.randrange(1, 25))]
        y = int(rnd.random() < 0.2)
        if y:
            rnd.choice(sentences).append(rnd.choice(["blort", "grabnik", "vexou", "vexour"]))
        out.append((i, ". ".join(" ".join(s) for s in sentences) + ".", y))
    return out


def test_toxicity(spark, docs_of):
    from partflow.llm.toxicity import fit_toxicity, toxicity
    corpus = toxic_corpus(3, 900)
    docs = docs_of([(k, t, "en", "a") for k, t, _ in corpus]
                   + [(9000 + i, t, "en", "a") for i, t in enumerate(ODD)]
                   + [(None, "blort", "en", "a")])
    held = [zlib.crc32(str(k).encode()) % 5 == 0 for k, _, _ in corpus]
    labels = spark.createDataFrame(
        [(k, y) for (k, _, y), h in zip(corpus, held) if not h] + [(None, 1), (3, None)],
        "doc_id bigint, toxic int")
    weights, bias = fit_toxicity(docs, labels)
    got = toxicity(docs, weights, bias).collect()
    assert len(got) == len(corpus) + len(ODD) + 1
    by = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    test = [(by[k], y) for (k, _, y), h in zip(corpus, held) if h]
    assert sum(r.predicted == y for r, y in test) >= 0.97 * len(test)
    for (k, t, y), h in zip(corpus, held):
        for s in by[k].offending:
            assert any(x in t[s.start:s.end] for x in ("blort", "grabnik", "vexou"))
    assert fit_toxicity(docs, labels) == (weights, bias)


def test_toxicity_without_labels(spark, docs_of):
    from partflow.llm.toxicity import fit_toxicity, toxicity
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    docs = docs_of(["a b", None])
    assert [r.score for r in toxicity(docs, *fit_toxicity(docs, none)).collect()
            ] == [0.0, 0.0]
    assert toxicity(docs_of([]), {}, 0.0).collect() == []


def vectors(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame(
        [(i, None if v is None else [None if c is None else float(c) for c in v])
         for i, v in zip(ids, x)], "vec_id bigint, embedding array<float>")


@pytest.mark.parametrize("unit", [True, False])
def test_nearest_recall(spark, unit):
    from pyspark.sql import functions as F

    from partflow.llm.ann import nearest
    from partflow.llm.common import prepare
    prepare(spark)
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(3000, 24))
    if unit:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x.astype(np.float32)
    got = nearest(vectors(spark, x), F.col("vec_id") % 20 == 0, shard_rows=700).collect()
    full = x.astype(np.float64)
    hits = 0
    for q in range(0, 3000, 20):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        score = full @ full[q]
        assert all(r.score == pytest.approx(score[r.vec_id], abs=1e-12) for r in own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        score[q] = -np.inf
        hits += len({r.vec_id for r in own} & set(np.argsort(-score)[:20].tolist()))
    assert hits >= 0.9 * 20 * 150


def test_nearest_odd_vectors(spark):
    from pyspark.sql import functions as F

    from partflow.llm.ann import nearest
    x = [[1, 0], None, [0, 0], [1, None], [float("nan"), 1], [float("inf"), 1], [], [0, 1],
         [1, 0], [1, 0], [1, 2, 3]]
    ids = [0, 1, 2, 3, 4, 5, 6, 20, 7, 9, 40]
    got = nearest(vectors(spark, x, ids), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [
        (0, 1, 7, 1.0), (0, 2, 9, 1.0), (0, 3, 20, 0.0),
        (20, 1, 0, 0.0), (20, 2, 7, 0.0), (20, 3, 9, 0.0)]
    assert nearest(vectors(spark, [], []), F.col("vec_id") % 20 == 0).collect() == []


def test_nearest_many_copies(spark):
    from pyspark.sql import functions as F

    from partflow.llm.ann import nearest
    x = [[1.0, 0.5]] * 400 + [[0.0, 1.0 + i / 100] for i in range(50)]
    got = nearest(vectors(spark, x), F.col("vec_id") == 60).collect()
    own = sorted(got, key=lambda r: r["rank"])
    assert [r.vec_id for r in own] == list(range(20))
