"""The registered queries opN_<name> of the dealt operators, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm import ann, chat, embedding_dups, lexical, linerules, merkle, mixing, ngram_join, packing, quality, secrets, tokencount, toxicity
from clickflow.llm.common import id_crc, saved, table


def op1_secrets_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find(docs, secrets.fit(docs), ["doc_id"])
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    said = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
                        F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def op2_quality_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), id_crc("doc_id") % 5 != 0)
    return quality.score(docs, model, ["doc_id"]).select(
        "doc_id", (id_crc("doc_id") % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_packing_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN, ["doc_id"])


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), n=4, percent=85)


def op5_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), id_crc("doc_id") % 3 != 1)
    return toxicity.score(docs, model, ["doc_id"]).select(
        "doc_id", (id_crc("doc_id") % 3 == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op7_embedding_pivot_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


def op8_ann_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the flattest mixture that reads no source more than twice as often as the source read least, every document at least once
    counts = tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ["doc_id", "source"])
    counts, _ = saved(spark, counts, "mix-tokens")
    return mixing.mix(counts, ["doc_id", "source"], repeats=2.0, tokens=F.col("n_tokens"))


def op10_chat_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(table(spark, sf_dir, "conversations"))


def op11_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linerules.rules(table(spark, sf_dir, "documents"), ["doc_id"])


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, merkle.lower_every_third(docs))


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {f.__name__: f for f in (op1_secrets_crf, op2_quality_bradley_terry, op3_packing_vector, op4_ngram_jaccard_join, op5_toxicity_crf, op6_token_counts, op7_embedding_pivot_dups,
                                  op8_ann_kmeans_tree, op9_temperature_mixing, op10_chat_snapshot_collapse, op11_line_rules, op12_merkle_manifest, op13_ranked_lexical_search)}
SQL: dict[str, str] = {"op10_chat_snapshot_collapse": chat.SQL, "op11_line_rules": linerules.SQL, "op12_merkle_manifest": merkle.SQL, "op13_ranked_lexical_search": lexical.SQL}
