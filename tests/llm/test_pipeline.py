"""The pipeline's stages on documents with planted cases."""

import random

import numpy as np
import pytest
import test_classifiers
import test_decontaminate
import test_near_copies
from tokenizers import Tokenizer

import corpus_pipeline as C
from tidegauge.llm import pii, quality
from tidegauge.llm.queries import training_rows, vocabulary_path


@pytest.fixture(scope="module")
def folder(spark, make_docs, tmp_path_factory):
    draw = random.Random(8)
    docs, labels = test_classifiers.corpus(240, seed=5)
    words = [f"w{i}" for i in range(300)]
    item = " ".join(draw.choice(words) for _ in range(30))
    good = [t for (_, t), (_, q, _) in zip(docs, labels) if q]
    # Half of one text and half of another: no near copy of either.
    first, second = good[2].split(), good[4].split()
    mixed = " ".join(first[: len(first) // 2] + second[len(second) // 2 :])
    docs += [(1000 + i, good[0]) for i in range(5)] + [(1010, good[1] + " " + item), (1011, mixed + " write to a@b.co or john [at] example [dot] com")]
    docs += [(1020, None), (1021, ""), (1011, good[3])]
    path = tmp_path_factory.mktemp("pipeline")
    make_docs(docs).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_stages_and_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(C.STAGES[:-1]):
        before = rows(docs)
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        after = rows(docs)
        if name == "quality":
            model = quality.fit_quality(spark.read.parquet(f"{folder}/documents.parquet"), training_rows(spark.read.parquet(f"{folder}/labels.parquet")))
            score = lambda t: model.score(quality.text_features((t or "").encode())[None])[0]
            assert after == [r for r in before if score(r[1]) >= quality.THRESHOLD] and 0 < len(after) < len(before)
        elif name == "near_dedup":
            assert after == sorted((before[i] for i in test_near_copies.brute(before)), key=repr) and len(after) < len(before)
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            bad = {d for d, _ in test_decontaminate.brute(list(enumerate(t for _, t in before)), items)}
            assert after == [r for i, r in enumerate(before) if i not in bad] and bad
        else:
            assert after == sorted(((i, t and pii.redact(t)) for i, t in before), key=repr) and after != before
    packed = C.STAGES[-1][1](spark, docs, folder).collect()
    library = Tokenizer.from_file(vocabulary_path())
    want = sorted(library.encode(t or "", add_special_tokens=False).ids + [1] for _, t in after)
    by_place = sorted(packed, key=lambda p: (p.sequence_id, p.offset))
    stream = [i for p in by_place for i in np.frombuffer(p.ids, "<u4").tolist()]
    got, start = [], 0
    for p in by_place:
        if p.start + p.length == p.doc_tokens:
            got.append(stream[start : start + p.doc_tokens])
            start += p.doc_tokens
    assert sorted(got) == want
    key = lambda r: tuple(r)
    assert sorted(map(key, C.run(spark, folder).collect())) == sorted(map(key, packed))


def test_empty_documents(spark, folder, make_docs):
    docs = make_docs([])
    for _, stage in C.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_clashing_columns_and_edge_texts(spark, folder, edge_docs):
    docs = edge_docs
    for name, stage in C.STAGES:
        out = stage(spark, docs, folder)
        if name == "packing":
            assert out.filter("doc_tokens < 1").count() == 0 and out.count() > 0
        else:
            assert out.columns == edge_docs.columns
            docs = edge_docs if name == "quality" else out
            assert 0 < docs.count() <= edge_docs.count()
