import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tidegauge.llm import near_dedup as N


def brute_fingerprint(text, size=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    """Least id per row, rows given as (id, fingerprint)."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(prints):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return [least.get(find(i)) for i in range(len(prints))]


def check(docs, rows, **options):
    want = [(i, brute_fingerprint(t)) for i, t in rows]
    comps = brute_components(want)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    got = [tuple(r) for r in N.near_groups(docs, **options).collect()]
    expected = [(i, signed(f), c) for (i, f), c in zip(want, comps)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def near_copies(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(n):
        text = [draw.choice(words) for _ in range(draw.choice([1, 3, 4, 5, 9, 80, 300]))]
        for _ in range(draw.choice([1, 1, 2, 6])):
            copy = list(text)
            for _ in range(draw.choice([0, 0, 1, 2])):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append((len(rows), draw.choice([" ", "\n", " \t"]).join(copy)))
    return rows


@pytest.mark.parametrize("crowd", [512, 1])
def test_against_brute_force(make_docs, crowd):
    rows = near_copies(crowd, 60)
    check(make_docs(rows), rows, crowd=crowd)


@pytest.mark.parametrize("crowd", [512, 3])
def test_chains_and_crowds_of_fingerprints(spark, crowd):
    draw = random.Random(crowd)
    prints, value = [], draw.getrandbits(64)
    for _ in range(40):  # a long chain of links, and bushes on it
        value ^= sum(1 << b for b in draw.sample(range(64), 4))
        prints += [value, *(value ^ (1 << draw.randrange(64)) for _ in range(4))]
    prints += [draw.getrandbits(64) for _ in range(50)]
    prints = list(dict.fromkeys(prints))
    signed = [v - (1 << 64) if v >> 63 else v for v in prints]
    nodes = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    roots = dict(tuple(r) for r in N.components(N.hamming_links(nodes, crowd=crowd)).collect())
    want = brute_components(list(zip(signed, prints)))
    assert [roots.get(v, v) for v in signed] == want


def test_edge_cases(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    check(edge_docs, rows)
    assert N.near_groups(no_docs).count() == 0 and N.drop_near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_one_row_of_each_group_stays(edge_docs, monkeypatch, broadcast):
    monkeypatch.setattr(N, "BROADCAST_ROWS", broadcast)
    kept = N.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    groups = {brute_fingerprint(r.text) for r in edge_docs.collect()}
    assert len(got) == len(groups) and {brute_fingerprint(t) for _, t in got} == groups
    assert 5 in [i for i, _ in got] and 6 not in [i for i, _ in got]


def test_parameters():
    with pytest.raises(ValueError):
        N.near_groups(None, radius=3)


def test_no_python_pairs(make_docs):
    plan = N.near_groups(make_docs([(1, "a"), (2, "b")])).filter(F.lit(True))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
