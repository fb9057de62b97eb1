"""The corpus pipeline on a small corpus: stages in order, what each decides, columns, and all tokens of the last."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
from llm_util import clashing, documents, prose, tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickflow.llm import quality, queries

HEX = "0123456789abcdef0123456789abcdef01234567"


def _corpus(spark, path):
    texts = {i: prose(i, 80) for i in range(90)}
    texts |= {100 + i: " ".join(w.upper() + "!!" for w in prose(500 + i).split()) for i in range(60)}
    texts |= {200 + i: prose(3, 80) + f" tail{i}" for i in range(4)} | {300: f"{prose(601, 40)} token = \"{HEX}\" {prose(602, 40)}", 301: None, 302: ""}
    docs = clashing(documents(spark, list(texts.items())))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100), 0) for i in texts if i < 200], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return texts, docs.columns


def test_stages(spark, tmp_path):
    texts, columns = _corpus(spark, tmp_path)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram jaccard join", "secret scan", "source mixing", "packing"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        if k < 4:
            assert docs.columns == columns
            kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert not any(100 <= d < 200 for d in kept[0]) and set(range(90)) <= set(kept[0])
    assert 3 in kept[1] and not any(200 <= d < 204 for d in kept[1]) and set(range(90)) <= set(kept[1])
    assert set(kept[2]) == set(kept[1]) == set(kept[3]) and HEX not in kept[2][300] and "[SECRET]" in kept[2][300]
    assert kept[2][7] == texts[7]
    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    copies = Counter(r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/stage3").collect())
    ids = defaultdict(list)
    for r in docs.collect():
        ids[r["doc_id"]] += r["ids"]
    for d, n in copies.items():
        assert Counter(ids[d]) == Counter((t.encode(kept[3][d] or "", add_special_tokens=False).ids + [0]) * n)
    assert sum(r["length"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sum(map(len, ids.values()))


def test_empty_tables(spark, tmp_path):
    _corpus(spark, f"{tmp_path}/a")
    for t in ("documents", "labels"):
        spark.read.parquet(f"{tmp_path}/a/{t}.parquet").where("doc_id < 0").write.parquet(f"{tmp_path}/b/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_all_rejected(spark, tmp_path):
    """The classifier leaves nothing; the later stages take that."""
    _corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"), F.lit(True))
    docs = quality.keep(docs.where("doc_id between 100 and 199"), model)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0


def test_null_and_repeated_ids_and_a_long_text(spark, tmp_path):
    """Rows are told apart whatever their ids: unlike texts under one id stay, copies go, a long text stays whole."""
    texts, _ = _corpus(spark, f"{tmp_path}/a")
    odd = [(7, prose(900, 80)), (None, prose(901, 80)), (None, prose(902, 80)), (None, texts[9]), (400, prose(903, 20_000))]
    docs = spark.read.parquet(f"{tmp_path}/a/documents.parquet")
    docs.unionByName(clashing(documents(spark, odd))).write.parquet(f"{tmp_path}/b/documents.parquet")
    spark.read.parquet(f"{tmp_path}/a/labels.parquet").write.parquet(f"{tmp_path}/b/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/b/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        stage(spark, docs, f"{tmp_path}/b").write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
    kept = Counter((r["doc_id"], r["text"]) for r in docs.distinct().collect())
    assert {t for d, t in kept if d == 7} == {texts[7], prose(900, 80)} and (400, prose(903, 20_000)) in kept
    assert {t for d, t in kept if d is None} == {prose(901, 80), prose(902, 80)}  # the copy of a text with an id is gone
    assert (9, texts[9]) in kept


def test_queries_are_registered_in_order():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES]
    assert numbers == list(range(1, 14)) and set(queries.SQL) <= set(queries.QUERIES)
    for sql in queries.SQL.values():
        assert duckdb.extract_statements(sql)
