"""The quality model learns from every labelled document."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import learning, quality as Q


def labelled(spark, n, bad_every):
    rows = [(i, ("LOUD!! " if i % bad_every == 0 else "calm word. ") * (5 + i % 17), int(i % bad_every != 0)) for i in range(n)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    return table.select("doc_id", "text"), table.select("doc_id", "quality")


def test_every_labelled_document_counts(spark):
    # Far more than a sample of some thousand would hold; the mean tells who was read.
    docs, labels = labelled(spark, 20_000, 2)
    model = Q.fit_quality(docs, labels)
    x = np.array([Q.text_features(r.text.encode()) for r in docs.collect()])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale[x.std(0) > 1e-9], x.std(0)[x.std(0) > 1e-9])


@pytest.mark.parametrize("group, rarer", [(50, 8), (4096, 64)])
def test_groups_hold_all_of_both_labels(spark, monkeypatch, group, rarer):
    monkeypatch.setattr(Q, "GROUP", group)
    monkeypatch.setattr(Q, "RARER", rarer)
    docs, labels = labelled(spark, 600, 200)
    rows = Q._labelled_features(docs, labels, "quality")
    teams = Q._grouped(rows, {0: 3, 1: 597}).collect()
    size = 8 * Q.N_FEATURES
    assert sum(len(t.good) for t in teams) == 597 * size
    assert all(0 < len(t.bad) // size <= 3 for t in teams)
    model = Q.fit_quality(docs, labels)
    scores = docs.select("doc_id", Q.quality_score(model, F.col("text")).alias("s")).collect()
    assert all((r.s >= Q.THRESHOLD) == (r.doc_id % 200 != 0) for r in scores)


def test_more_labels_than_are_broadcast(spark, monkeypatch):
    docs, labels = labelled(spark, 300, 3)
    few = Q.fit_quality(docs, labels)
    monkeypatch.setattr(Q, "BROADCAST_ROWS", 10)
    many = Q.fit_quality(docs, labels)
    assert np.allclose(few.weights, many.weights) and few.cut == pytest.approx(many.cut)


def test_value_at_rank(spark):
    values = [float(i * 7919 % 1000) for i in range(1000)] + [5.0] * 400
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    for rank in (0, 3, 5, 200, 404, 405, 406, 1399):
        assert learning.value_at_rank(df, "v", rank, bins=8, few=20) == sorted(values)[rank]
