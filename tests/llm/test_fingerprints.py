import hashlib

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidegauge.llm import fingerprints as P

TEXTS = st.text(alphabet="ab\n ", max_size=60)


@settings(deadline=None)
@given(TEXTS)
def test_order_does_not_matter(text):
    pieces = P.paragraphs(text)
    assert np.array_equal(P.vector(pieces), P.vector(pieces[::-1]))
    parts = sum((P.vector([p]) for p in pieces), P.vector([]))
    assert np.array_equal(P.vector(pieces), parts)


@settings(deadline=None)
@given(TEXTS, TEXTS)
def test_other_multisets_differ(a, b):
    same = sorted(P.paragraphs(a)) == sorted(P.paragraphs(b))
    assert np.array_equal(P.vector(P.paragraphs(a)), P.vector(P.paragraphs(b))) == same


@settings(max_examples=200, deadline=None)
@given(TEXTS, TEXTS)
def test_incremental_edit(text, after):
    n = len(text)
    kept = n - n // 4
    new = text[:kept] + after[: n - kept]
    got = P.edited(P.vector(P.paragraphs(text)), text, new, kept)
    assert np.array_equal(got, P.vector(P.paragraphs(new)))


def test_likeness():
    draw = np.random.default_rng(1)
    words = ["w%d" % i for i in range(5000)]
    a, b = (" ".join(draw.choice(words, 2000)) for _ in range(2))
    half = a[: len(a) // 2] + b[len(b) // 2 :]
    va, vb, vh = (P.vector(P.paragraphs(t)) for t in (a, b, half))
    assert P.likeness(va, va) == 1 and P.likeness(va, vb) < 0.3 and abs(P.likeness(va, vh) - 0.5) < 0.3
    empty = P.vector([])
    assert P.likeness(empty, empty) == 1 and P.likeness(empty, va) == 0


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(text)
        new = text[: n - n // 4] + after[: n // 4]
        hexed = [P.vector(P.paragraphs(t)).tobytes().hex() for t in (text, new)]
        out.append((i, n, hashlib.sha256(new.encode()).hexdigest(), *hexed))
    return out


def test_every_document_meets_the_next(make_docs):
    draw = np.random.default_rng(0)
    ids = draw.permutation(500)[:120].tolist()
    rows = [(i, "\n".join("p%d" % x for x in draw.integers(0, 50, draw.integers(0, 9)))) for i in ids]
    got = P.edited_fingerprints(make_docs(rows, more=True).repartition(5))
    cols = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(brute(rows))


def test_one_document_follows_itself(make_docs):
    rows = [(3, "abcdefgh")]
    got = P.edited_fingerprints(make_docs(rows)).first()
    assert got.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_edge_cases(edge_docs, no_docs):
    got = P.edited_fingerprints(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert {r.fingerprint for r in got if r.doc_id in (1, 2)} == {"00" * 2 * (P.DENSE + P.SKETCH)}
    assert len({r.fingerprint for r in got if r.doc_id in (5, 6)}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert P.edited_fingerprints(no_docs).count() == 0


def test_columns_insert_and_delete(spark):
    df = spark.createDataFrame([("a\nb", "c", "c\nb\na")], "x string, y string, z string")
    f = df.select(*[P.fingerprint(c).alias(c) for c in "xyz"])
    got = f.select(P.combined("x", "y").alias("sum"), P.without("z", "y").alias("rest"), "x", "z").first()
    assert got.sum == got.z and got.rest == got.x
    assert f.select(P.combined("x", F.lit(None).cast("binary")).alias("s")).first().s == got.x
