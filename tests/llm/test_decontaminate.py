import random
from collections import Counter

import pytest

from tidegauge.llm import decontaminate as D


def shingles(text):
    words = (text or "").lower().split()
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] * bool(words)


def brute(docs, items, least=0.8):
    """Best similarity of every document and item over all windows of the item's size."""
    out = {}
    for d, text in docs:
        own = shingles(text)
        for i, item in items:
            want = shingles(item)
            if not own or not want:
                continue
            for begin in range(max(1, len(own) - len(want) + 1)):
                a, b = Counter(own[begin : begin + len(want)]), Counter(want)
                common = sum((a & b).values())
                value = common / (a.total() + b.total() - common)
                if value >= least:
                    out[d, i] = max(value, out.get((d, i), 0))
    return out


def make_items(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def found(docs, items):
    return {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in D.contaminated(docs, items).collect()}


def planted(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.choice([3, 5, 16, 40, 60])))) for i in range(25)]
    items += [(100, items[0][1]), (101, None), (102, ""), (103, "a a a a a a a a a a")]
    docs = []
    for d in range(120):
        text = [draw.choice(words) for _ in range(draw.randrange(80))]
        for _ in range(draw.randrange(3)):
            part = draw.choice(items)[1] or ""
            part = part.split()
            for _ in range(draw.choice([0, 0, 1, 2])):
                if part:
                    part[draw.randrange(len(part))] = "changed"
            at = draw.randrange(len(text) + 1)
            text[at:at] = part
        docs.append((d, " ".join(text)))
    docs += [(500 + i, t) for i, (_, t) in enumerate(items)]
    docs += [(600, "a " * 30), (601, "A\tA\nA a a  a a a a a")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, make_docs, seed):
    docs, items = planted(seed)
    assert found(make_docs(docs, more=True), make_items(spark, items)) == brute(docs, items)


def test_without_broadcast(spark, make_docs, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    docs, items = planted(3)
    assert found(make_docs(docs), make_items(spark, items)) == brute(docs, items)


def test_drop(spark, make_docs):
    docs, items = planted(4)
    table = make_docs(docs, more=True)
    left = D.drop_contaminated(table, make_items(spark, items))
    assert left.columns == table.columns
    bad = {d for d, _ in brute(docs, items)}
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, _ in docs if d not in bad)


def test_edge_cases(spark, edge_docs, no_docs):
    items = make_items(spark, [(1, "same text of some words here"), (None, "no id but a text of a few words"), (2, None), (3, "one")])
    got = sorted(((r.doc_id, r.item_id) for r in D.contaminated(edge_docs, items).collect()), key=repr)
    assert got == sorted([(5, 1), (6, 1), (None, None), (4, 3)], key=repr)
    assert D.drop_contaminated(edge_docs, items).count() == edge_docs.count() - 5
    assert D.contaminated(no_docs, items).count() == 0
    assert D.contaminated(edge_docs, items.limit(0)).count() == 0


def test_plan_is_native(spark, make_docs):
    plan = D.contaminated(make_docs([(1, "a b c")]), make_items(spark, [(1, "a b c")]))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
