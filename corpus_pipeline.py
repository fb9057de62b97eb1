"""The corpus pipeline: quality classifier, n-gram Jaccard join, secret scan, source mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame; all but the
last return the columns of ``docs``. ``run`` writes every stage's rows to the shared folder and reads them again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm import mixing, ngram_join, packing, quality, secrets
from clickflow.llm.common import id_crc, saved, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Learned from the labelled rows that op2 learns from."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), id_crc("doc_id") % 5 != 0)
    return quality.keep(docs, model)


def keep_first_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies (five words, similarity 0.8) stays."""
    return ngram_join.first_of_groups(docs, n=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; no document goes."""
    return secrets.redact(docs, secrets.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources more often (no source more than twice as often as the largest), in the order of the mixture.

    Sources are weighed by the UTF-8 bytes of their texts, which follow the ids of a byte-level tokenizer in any language."""
    blocks, _ = mixing.plan(docs, repeats=2.0, tokens=F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    mixed = mixing.mixed(docs, blocks)
    return mixed.repartitionByRange("__slot", "doc_id").sortWithinPartitions("__slot", "doc_id").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, with their ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN, ["doc_id"], with_ids=True)


STAGES = [("quality classifier", keep_quality), ("n-gram jaccard join", keep_first_of_copies), ("secret scan", redact_secrets),
          ("source mixing", mix_sources), ("packing", pack_sequences)]

#: SQL can express neither the trained stages nor the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = saved(spark, stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
