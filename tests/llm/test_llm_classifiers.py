"""Quality and toxicity: held-out accuracy on planted texts, folds, and the defined edge cases."""

import random
import zlib

import pytest
from llm_util import clashing, documents, edge_texts, prose

from clickflow.llm import quality, queries, toxicity

BAD = "blorgh zumpf krattle vexnorb".split()


def _junk(i):
    return [" ".join(w.upper() + "!!" for w in prose(i).split()), " ".join([prose(i, 3)] * 20), " | ".join(prose(i).split())][i % 3]


def _toxic(i):
    r, w = random.Random(i), prose(i).split()
    for _ in range(1 + i % 3):
        w.insert(r.randrange(len(w)), r.choice(BAD))
    return " ".join(w)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("labelled"))
    texts = [_junk(i) if i % 4 == 0 else _toxic(i) if i % 4 == 1 else prose(i) for i in range(600)]
    documents(spark, [*texts, *[(1000 + k, t[1] if isinstance(t, tuple) else t) for k, t in enumerate(edge_texts())], (None, prose(9))]).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 4 != 0), int(i % 4 == 1)) for i in range(600)] + [(None, 1, 0), (1, None, None), (7777, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def _fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def test_quality_on_held_out_rows(spark, sf):
    got = queries.op2_quality_bradley_terry(spark, sf).collect()
    assert len(got) == 612 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (_fold(r["doc_id"], 5) == 0) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
    assert len(held) > 60 and sum(r["predicted"] == int(r["doc_id"] % 4 != 0) for r in held) / len(held) > 0.95


def test_toxicity_on_held_out_rows_and_spans(spark, sf):
    got = queries.op5_toxicity_crf(spark, sf).collect()
    assert len(got) == 612 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (_fold(r["doc_id"], 3) == 1) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600 and r["doc_id"] % 4]
    assert len(held) > 80 and sum(r["predicted"] == int(r["doc_id"] % 4 == 1) for r in held) / len(held) > 0.97
    for r in held:
        for s in r["spans"]:
            if r["doc_id"] % 4 == 1:
                assert any(b in _toxic(r["doc_id"])[s["start"]:s["end"]] for b in BAD)
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[1000] == scores[1001] == scores[1002] == 0.0 and scores[1005] == scores[1006]


def test_copies_of_one_text_do_not_make_its_words_toxic(spark):
    rare = "quixby flonder"
    texts = [f"{prose(1)} {rare} {BAD[0]}"] * 40 + [_toxic(i) for i in range(60)] + [prose(i) for i in range(200, 400)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i in range(len(texts))], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    model = toxicity.fit(documents(spark, texts), labels, F.lit(True))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents(spark, [f"{prose(801)} {rare}", f"{prose(802)} {BAD[1]} {prose(803)}"]), model, ["doc_id"]).collect()}
    assert got[0] < 0.5 < got[1]


def test_without_labels_and_empty_tables(spark):
    from pyspark.sql import functions as F

    docs = clashing(documents(spark, [prose(1), None]))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(0, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        model = quality.fit(docs, labels, F.lit(True))
        out = quality.score(docs, model, docs.columns)
        assert [r["score"] for r in out.collect()] == [0.5, 0.5] and quality.keep(docs, model).columns == docs.columns
        assert [r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels, F.lit(True)), docs.columns).collect()] == [0.0, 0.0]
    empty = documents(spark, [])
    model = quality.fit(empty, one, F.lit(True))
    assert quality.score(empty, model, ["doc_id"]).count() == 0 and quality.keep(empty, model).count() == 0
    assert toxicity.score(empty, toxicity.fit(empty, one, F.lit(True)), ["doc_id"]).count() == 0
