"""Packing and token counts against the tokenizer library."""

import random
import weakref
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_util import clashing, documents, edge_texts, prose, tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickflow.llm import common, packing, queries, tokencount

import public_tokenizers

ODD = [" ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", " ", "a", "'s", "it's", "É", "é", "́", "ß", "İ", "ſ", "Σ", "ς", "12", "½", "<|endoftext|>", "<|startoftext|>", "!", "…", "漢字", "\U0001F600", "ﬁ"]


def _odd(n=400):
    r = random.Random(3)
    return ["".join(r.choices(ODD, k=r.randint(0, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens"))
    clashing(documents(spark, [*_odd(), *[prose(i, 5 + 40 * i) for i in range(60)], *edge_texts()])).write.parquet(f"{path}/documents.parquet")
    return path


def _texts(spark, sf):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def test_token_counts_equal_the_library(spark, sf):
    t = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = sorted(((d, len(x.encode()), n := len(t.encode(x, add_special_tokens=False).ids), n > 2048) for d, x in _texts(spark, sf)), key=str)
    assert sorted((tuple(r) for r in queries.op6_token_counts(spark, sf).collect()), key=str) == want


def test_packing_loses_nothing_and_pads_little(spark, sf):
    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = defaultdict(list)
    for d, x in _texts(spark, sf):
        want[d].append(np.array([*t.encode(x, add_special_tokens=False).ids, 0], dtype="<u4"))
    got = queries.op3_packing_vector(spark, sf).collect()
    rows, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        rows[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for d, texts in want.items():
        for n in {len(x) for x in texts}:
            same = [x for x in texts if len(x) == n]
            pieces = rows.pop((d, n))
            if len(same) == 1:
                pieces.sort(key=lambda r: r["start"])
                assert [r["start"] for r in pieces] == np.cumsum([0, *[r["length"] for r in pieces[:-1]]]).tolist()
                assert all(zlib.crc32(same[0][r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in pieces)
            assert sum(r["length"] for r in pieces) == n * len(same)
    assert not rows
    padding = 0
    for row in sequences.values():
        row.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in row] == np.cumsum([0, *[r["length"] for r in row[:-1]]]).tolist()
        size = sum(r["length"] for r in row)
        assert size <= 1024 and len(row) <= packing.SEGMENTS
        padding += 0 if size & (size - 1) == 0 else 1024 - size
    assert padding <= 0.01 * sum(r["length"] for r in got)


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert tokencount.count_tokens(empty, tokenizer_path("word_bpe_49k.json"), ["doc_id"]).count() == 0
    assert packing.pack(empty, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id"]).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_placement_keeps_all_limits(seed):
    r = np.random.default_rng(seed)
    n = r.integers(1, 3000, 400) if seed % 2 else r.integers(1, 90, 400)
    loss = r.choice([0.0, 0.3, 0.5, 1.0], 400)
    size, segments, most = 256, [4, 16, 64][seed % 3], [256, 100, 40][seed % 3]
    out = packing.place(n, loss, (size, segments, most))
    pieces = defaultdict(list)
    for row in out:
        assert 0 < sum(k for _, _, k in row) <= size and len(row) <= segments
        assert sum(np.ceil(k * loss[i]) for i, _, k in row) <= most + len(row)  # a cut may round one token up
        for i, s, k in row:
            pieces[i].append((s, k))
    for i, total in enumerate(n):
        at = 0
        for s, k in sorted(pieces[i]):
            assert s == at and k > 0
            at += k
        assert at == total


def _padding(sequences):
    sizes = [sum(k for _, _, k in row) for row in sequences]
    return sum(0 if n & (n - 1) == 0 else 1024 - n for n in sizes)


@pytest.mark.parametrize(("tokens", "most"), [(5, 1024), (1, 1024), (15, 1024), (700, 100), (40, 300)])
def test_short_examples_and_loss_limits_leave_no_padding(tokens, most):
    """Sequences that end at their segments or loss-bearing tokens with free tokens left are cut to powers of two."""
    n, loss = np.full(4000, tokens), np.full(4000, 1.0)
    out = packing.place(n, loss, (1024, 64, most))
    assert all(len(row) <= 64 and sum(k for _, _, k in row) <= most for row in out)
    assert sum(k for row in out for _, _, k in row) == 4000 * tokens
    assert _padding([row for row in out if len(row) > 1]) == 0 and (most < 1024 or _padding(out) == 0)


def test_a_batch_of_very_long_texts_is_packed_in_parts(spark):
    """Few characters at once: the same pieces' ids in all, whatever is packed together."""
    docs = documents(spark, [prose(i, 3000) for i in range(12)] + [prose(50, 5)] * 40 + [None, ""]).coalesce(1)
    args = (tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id"])

    def ids(chars):
        out = defaultdict(list)
        for r in sorted(packing.pack(docs, *args, with_ids=True, chars=chars).collect(), key=lambda r: (r["doc_id"], r["start"])):
            assert r["start"] == len(out[r["doc_id"]])
            out[r["doc_id"]] += r["ids"]
        return out

    assert ids(20_000) == ids(packing.CHARS)


def test_packed_ids_and_loss_share(spark):
    docs = documents(spark, [prose(i, 200) for i in range(30)]).withColumn("share", F.lit(0.5))
    out = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id", "share"],
                       loss_limit=256, loss_share=F.col("share"), with_ids=True, segments=8).collect()
    assert all(len(r["ids"]) == r["length"] for r in out) and out[0]["share"] == 0.5
    by = defaultdict(int)
    for r in out:
        by[r["sequence_id"]] += r["length"] * 0.5
    assert max(by.values()) <= 256


def test_a_text_of_very_many_pieces_is_not_copied_with_each(spark):
    """1.6 million characters and as many ids: a copy of the text with each piece would be over 2 GB of a worker."""
    args = (tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id"])
    got = packing.pack(documents(spark, ["a1" * 800_000, prose(1)]).coalesce(1), *args, with_ids=True).collect()
    pieces = sorted((r["start"], r["length"], len(r["ids"]), r["doc_tokens"], r["ids"][-1]) for r in got if r["doc_id"] == 0)
    assert len(pieces) > 1500 and [p[0] for p in pieces] == np.cumsum([0, *(p[1] for p in pieces[:-1])]).tolist()
    assert all(n == k for _, n, k, _, _ in pieces) and sum(p[1] for p in pieces) == pieces[0][3] and pieces[-1][4] == 0

    def most(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pa.default_memory_pool().max_memory() / 1e6])], ["mb"])

    # tasks take the workers that are free in turn, and so come by the one that packed
    assert max(r["mb"] for r in spark.range(0, 32, 1, 32).mapInArrow(most, "mb double").collect()) < 1000


def test_tasks_give_their_memory_back(monkeypatch):
    """A task's batches pass unchanged, and when memory is given back the task holds nothing any more."""
    held, left = [], []

    class Thing:
        pass

    def task(batches):
        thing = Thing()
        held.append(weakref.ref(thing))
        yield from batches

    monkeypatch.setattr(common, "give_back", lambda: left.append(held[0]()))
    batches = [pa.RecordBatch.from_arrays([pa.array([i])], ["x"]) for i in range(3)]
    assert list(common.tidy(task)(iter(batches))) == batches and left == [None]
    monkeypatch.undo()
    common.give_back()
