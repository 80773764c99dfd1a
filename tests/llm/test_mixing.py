"""Systematic sampling against a loop over the documents."""

from hashlib import sha256
from math import floor

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import mixing
from tidegauge.llm.mixing import PARTS


def words(text):
    return len([w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w])


def brute_targets(sizes, weights, share=1.5, most=2.0):
    """Targets by dealing and stopping, round by round."""
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] >= most * sizes[s]}
        if not full:
            return out | {s: level * weights[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def brute(rows, seed=7, in_turn=(5, 2, 1)):
    """(id, size, source size, target, copies) of every row."""
    sizes, by_source = {}, {}
    for i, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
        key = sha256(f"{seed}:{'' if i is None else i}:{text or ''}".encode()).hexdigest()
        by_source.setdefault(source, []).append((words(text), key, i))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: in_turn[k % len(in_turn)] for k, s in enumerate(order)}
    targets, out = brute_targets(sizes, weights), []
    for s, docs in by_source.items():
        parts = floor(targets[s] / sizes[s] * PARTS + 0.5) if sizes[s] else 0
        at = int(sha256(f"{seed}:{'' if s is None else '=' + s}".encode()).hexdigest()[:13], 16) % PARTS
        for size, _, i in sorted(docs, key=lambda d: d[:2]):
            out.append((i, size, sizes[s], targets[s], (at + parts) // PARTS - at // PARTS))
            at += parts
    return out


@pytest.fixture(scope="module")
def make(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, text string, source string")


def got(df, **more):
    mixed = mixing.mix_sources(mixing.sized(df), **more)
    return [(r.doc_id, r["size"], r.source_size, pytest.approx(r.target), r.copies) for r in mixed.collect()]


def check(df, rows):
    key = lambda r: repr((r[0], r[1], r[2], r[4]))
    assert sorted(got(df), key=key) == sorted(brute(rows), key=key)


def corpus(n, hot):
    """A source with a share of ``hot``, sizes from nothing to long, one size very common."""
    names = [None, "a", "b", "ü", "文", "B", ""]
    return [(i, "w " * (3 if i % 3 else (i * 7919) % 400), "hot" if i % 100 < hot else names[i % 7]) for i in range(n)]


@pytest.mark.parametrize("hot", [0, 40, 95])
def test_equals_the_loop(make, hot):
    rows = corpus(1500, hot)
    check(make(rows).repartition(7), rows)


def test_taken_words_are_near_their_target(make):
    rows = corpus(3000, 40)
    mixed = mixing.mix_sources(mixing.sized(make(rows)))
    for r in mixed.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.min("target").alias("target"), F.max("size").alias("most")).collect():
        assert abs(r.taken - r.target) <= 2 * r.most
    assert mixed.agg(F.max("copies")).first()[0] <= 2


def test_layout_seed_and_reruns(make):
    rows = corpus(600, 40)
    one = sorted(map(repr, got(make(rows))))
    assert one == sorted(map(repr, got(make(rows[::-1]).repartition(5))))
    a, b = (mixing.mix_sources(mixing.sized(make(rows), seed=s), seed=s) for s in (7, 8))
    assert sorted(r.copies for r in a.collect()) != [] and a.exceptAll(b).count() > 0


def test_weights_and_limits(make):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(100)]

    def equal(sizes):
        return sizes.withColumn("weight", F.lit(1))

    assert {r[4] for r in got(make(rows), weights=equal, share=1.0, most=1.0)} == {1}
    assert {r[4] for r in got(make(rows), weights=equal, share=2.0, most=3.0)} == {2}
    with pytest.raises(ValueError):
        mixing.mix_sources(mixing.sized(make(rows)), share=3.0)


def test_emitted(make):
    rows = corpus(200, 30)
    mixed = mixing.mix_sources(mixing.sized(make(rows)))
    out = mixing.emitted(mixed)
    assert out.count() == mixed.agg(F.sum("copies")).first()[0]
    assert out.filter("copy > 1").count() == mixed.filter("copies > 1").count()


def test_edge_cases(make, edge_docs, no_docs):
    rows = [(r.doc_id, r.text, r.source) for r in edge_docs.collect()]
    check(edge_docs, rows)
    assert mixing.mix_sources(mixing.sized(no_docs)).count() == 0
    clashing = mixing.sized(edge_docs.withColumns({c: F.lit("old") for c in ("size", "order_key", "target", "copies", "source_size")}))
    mixed = mixing.mix_sources(clashing)
    assert [c for c in mixed.columns if c not in ("size", "order_key", "source_size", "target", "copies")] == edge_docs.columns
    # Only empty texts: nothing to take.
    assert [r[3:] for r in got(make([(1, "", "a"), (2, None, None)]))] == [(0, 0), (0, 0)]
    # Equal rows are rows of their own.
    rows = [(1, "w w", "a")] * 40 + [(2, "w", "b")]
    check(make(rows), rows)


def test_no_python_and_no_window_over_documents_of_a_source(make):
    plan = mixing.mix_sources(mixing.sized(make(corpus(10, 10))))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    windows = [line for line in plan.splitlines() if "Window [" in line]
    numbering = [line for line in windows if "row_number" in line and "_cell" in line]
    assert len(numbering) == 1 and not any("_row" in line for line in windows if line not in numbering)
