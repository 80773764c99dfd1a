"""Fill-in-the-middle against cuts made by hand."""

import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import infill
from tidegauge.llm.infill import Infill, fill_in_middle, restore


def brute(doc, text, rules=Infill()):
    """n, form, characters of prefix and middle, and the output."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha256(f"{rules.seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in (rules.prefix, rules.suffix, rules.middle)) or h[2] % 100 >= rules.rate:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < rules.spm:
        return len(units), "spm", len(prefix), len(middle), f"{rules.suffix}{suffix}{rules.prefix}{prefix}{rules.middle}{middle}"
    return len(units), "psm", len(prefix), len(middle), f"{rules.prefix}{prefix}{rules.suffix}{suffix}{rules.middle}{middle}"


TEXTS = ["a\nb\nc\n", "a\nb\nc", "\n\n\n", "\n", "one", "x\r\ny z\n\u0085", "<P", "<S\n<M\nP>\n", "$1\n\\2\n${x}", "😀\n文字\nü", "has <M> in\nit", "<S>", "\x00\n\x0b\x0c"]


def check(df, rules=Infill(), want=None):
    made = fill_in_middle(df, rules).select("doc_id", "text", "infill", restore(F.col("infill.output"), F.col("infill.form"), rules).alias("back"))
    forms = set()
    for r in made.collect():
        assert tuple(r.infill) == brute(r.doc_id, r.text, rules)
        assert r.back == (r.text or "")
        forms.add(r.infill.form)
    assert want is None or forms == want


def test_cuts_and_back(make_docs):
    check(make_docs([(i, t) for k in range(12) for i, t in enumerate(TEXTS, 100 * k)]), want={"plain", "psm", "spm"})


def test_rules(make_docs):
    docs = make_docs([(i, t) for k in range(6) for i, t in enumerate(TEXTS, 100 * k)])
    check(docs, Infill("<|$pre|>", "<|su\\f|>", "<|mid.|>", seed=3, rate=60, spm=0), {"plain", "psm"})
    check(docs, Infill(spm=100), {"plain", "spm"})
    check(docs, Infill(rate=0), {"plain"})
    for bad in (dict(prefix="P"), dict(prefix="<S>"), dict(middle="<a\n>"), dict(rate=101), dict(spm=-1)):
        with pytest.raises(ValueError):
            Infill(**bad)


def test_edge_cases(edge_docs, no_docs):
    check(edge_docs)
    made = fill_in_middle(edge_docs)
    assert made.columns == [*edge_docs.columns, "infill"]
    assert fill_in_middle(no_docs).count() == 0
    again = fill_in_middle(made.withColumn("infill", F.lit("old")))
    assert again.schema["infill"].dataType == made.schema["infill"].dataType


def test_many_lines_and_a_long_one(make_docs):
    check(make_docs([(1, "ab\n" * 300_000), (2, "x" * 3_000_000 + "\n" + "y\r\n 😀\n" * 50_000), (3, "\n" * 200_000)]))


def test_everything_stays_in_the_jvm(make_docs):
    plan = fill_in_middle(make_docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and infill.UNIT in plan
