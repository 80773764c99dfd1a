import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import learning, quality as Q, toxicity as X


def corpus(n=400, seed=2):
    """Documents of plain words; label 0 shouts, label 1 of ``toxic`` has some of a few words, at times disguised."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("aeiou") + draw.choice("bdfglmnrst") for _ in range(draw.choice([1, 2, 3]))) for _ in range(300)]
    bad = ["nastoid", "grumblek", "vilemor", "scoundar"]
    docs, labels = [], []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randrange(30, 90))]
        good, toxic = draw.random() < 0.7, draw.random() < 0.4
        if not good:
            text = [w.upper() + draw.choice(["!!", "$$$"]) for w in text]
        if toxic:
            for _ in range(3):
                text.insert(draw.randrange(len(text)), draw.choice(bad))
        docs.append((i, " ".join(text)))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark, make_docs):
    docs, labels = corpus()
    table = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (10**9, 1, 0)], "doc_id long, quality int, toxic int")
    return make_docs(docs), table, {i: (q, t) for i, q, t in labels}


def held_out(i):
    return i % 4 == 2


def accuracy(scores, truth):
    pairs = [(s >= 0.7, bool(truth[i])) for i, s in scores if held_out(i)]
    return sum(a == b for a, b in pairs) / len(pairs)


def test_quality_on_held_out_documents(data):
    docs, labels, truth = data
    model = Q.fit_quality(docs, labels.filter("doc_id % 4 != 2 OR doc_id IS NULL"))
    scores = docs.select("doc_id", Q.quality_score(model, F.col("text")).alias("s")).collect()
    assert accuracy(scores, {i: q for i, (q, _) in truth.items()}) > 0.95
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores if s >= Q.THRESHOLD}


def test_toxicity_on_held_out_documents(data, make_docs):
    docs, labels, truth = data
    model = X.fit_toxicity(docs, labels.filter("doc_id % 4 != 2 OR doc_id IS NULL"))
    scores = docs.select("doc_id", X.toxicity_score(docs, model, F.col("text")).alias("s")).collect()
    assert accuracy(scores, {i: t for i, (_, t) in truth.items()}) > 0.95
    plain = dict(corpus(60, seed=9)[0])
    clean = [t for t in plain.values() if not any(w in t for w in ("nastoid", "grumblek", "vilemor", "scoundar"))][:12]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100 + i, f"{t} gr@mb1ek n a s t o i d v1l3mor scoooundar") for i, t in enumerate(clean)]
    rows += [(200 + i, f"{t} n.a.s.t.o.i.d scound4r vilemoooor") for i, t in enumerate(clean)]
    docs = make_docs(rows)
    got = dict(tuple(r) for r in docs.select("doc_id", X.toxicity_score(docs, model, F.col("text"))).collect())
    assert all((s >= X.THRESHOLD) == (i >= 100) for i, s in got.items()), got


def test_edge_cases(data, edge_docs, no_docs, spark):
    docs, labels, _ = data
    q, t = Q.fit_quality(docs, labels), X.fit_toxicity(docs, labels)
    got = edge_docs.select("doc_id", Q.quality_score(q, F.col("text")).alias("q"), X.toxicity_score(docs, t, F.col("text")).alias("t")).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.q <= 1 and 0 <= r.t <= 1 for r in got)
    assert len({(r.q, r.t) for r in got if r.doc_id in (1, 2)}) == 1
    assert Q.keep_good(no_docs, q).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for few in (none, labels.filter("quality = 1 AND toxic = 0")):
        assert Q.keep_good(docs, Q.fit_quality(docs, few)).count() == docs.count()
        flat = X.fit_toxicity(docs, few)
        assert docs.select(X.toxicity_score(docs, flat, F.col("text")).alias("s")).agg(F.max("s")).first()[0] == 0
    assert Q.keep_good(docs, Q.fit_quality(no_docs, labels)).count() == docs.count()


def test_fit_is_the_same_however_rows_arrive(data):
    docs, labels, _ = data
    a, b = (Q.fit_quality(d, labels) for d in (docs, docs.repartition(7)))
    assert np.allclose(a.weights, b.weights) and a.cut == pytest.approx(b.cut)


def test_sample_is_bounded(data):
    _, labels, _ = data
    n = learning.label_sample(labels, "quality", 50).groupBy("label").count().collect()
    assert {r.label for r in n} == {0, 1} and all(20 < r["count"] < 90 for r in n)


def test_trigrams_cover_every_text(make_docs):
    docs = make_docs([(1, "Aab"), (2, "ab ab"), (3, None), (4, "")]).repartition(3)
    counts = X.trigram_counts(docs)
    a, b = 1, 2
    assert counts[0, a, a] == 1 and counts[a, a, b] == 1 and counts[0, a, b] == 2 and counts[a, b, 0] == 3
    assert counts.sum() == 3 + 5


@pytest.mark.parametrize("token, plain", [("gr4mm4r", "grammar"), ("g.r.a.m.m.a.r", "grammar"), ("graaammar", "grammar"), ("grammar", "grammar")])
def test_restore(make_docs, token, plain):
    costs = X.trigram_costs(X.trigram_counts(make_docs([(1, "grammar " * 50 + "other words of the language")])))
    assert X.restore(token, costs) == plain
