"""Mixing against sums in Python, chat collapse against brute force and DuckDB."""

import math
from collections import defaultdict

import duckdb
import pytest
from llm_util import clashing, documents, prose, tokenizer_path
from tokenizers import Tokenizer

from clickflow.llm import chat, mixing, queries


def _sized(spark, per_source):
    """Documents of 10 words by source."""
    rows = [(f"s{k}", i) for k, n in enumerate(per_source) for i in range(n)]
    return spark.createDataFrame([(d, prose(d, 10), "en", s, 0) for d, (s, _) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")


def _weights(rows):
    read = defaultdict(int)
    for r in rows:
        read[r["source"]] += 1
    return {s: n / len(rows) for s, n in read.items()}


def test_repetition_limit_and_every_document_once(spark, tmp_path):
    sizes = [4000, 600, 300]
    clashing(_sized(spark, sizes)).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op9_temperature_mixing(spark, str(tmp_path)).collect()
    n = defaultdict(int)
    for r in got:
        n[r["doc_id"]] += 1
    assert set(n) == set(range(sum(sizes))) and max(n.values()) == 2
    x = 1 - math.log(2) / math.log(sizes[0] / sizes[2])
    z = sum((k / sum(sizes)) ** x for k in sizes)
    for s, w in _weights(got).items():
        assert abs(w - (sizes[int(s[1])] / sum(sizes)) ** x / z) < 0.01
    assert len({(r["doc_id"], r["epoch"]) for r in got}) == len(got) and all(0 <= r["slot"] < 1 for r in got)
    for part in range(4):  # every part of the run has the target weights
        some = [r for r in got if part / 4 <= r["slot"] < (part + 1) / 4]
        assert all(abs(w - _weights(got)[s]) < 0.06 for s, w in _weights(some).items())


@pytest.mark.parametrize("entropy", [0.7, 0.95])
def test_target_entropy_and_budget(spark, entropy):
    docs = _sized(spark, [3000, 500, 200])
    got = mixing.mix(docs, ["doc_id", "source"], entropy=entropy, budget=20_000).collect()
    w = _weights(got)
    assert abs(-sum(v * math.log(v) for v in w.values()) - entropy) < 0.02 and abs(len(got) * 10 - 20_000) < 600
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(7), ["doc_id", "source"], entropy=entropy, budget=20_000).collect()))


def test_sources_without_spaces_are_weighed_by_tokens(spark, tmp_path):
    """Texts of a script without spaces count by their tokens, not as a word each."""
    rows = [(i, prose(i, 150) if i % 2 else "漢字仮名交文章" * 30, f"s{i % 2}") for i in range(400)]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    t = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    size = defaultdict(int)
    for _, x, _, source, _ in docs.collect():
        size[source] += len(t.encode(x, add_special_tokens=False).ids)
    read = defaultdict(int)
    for r in queries.op9_temperature_mixing(spark, str(tmp_path)).collect():
        read[r["source"]] += 1
    least = min(size.values())  # the flattest mixture: equal weights, or the smaller source twice
    assert 0.5 < least / max(size.values())
    for s in size:
        assert abs(read[s] * size[s] / 200 / max(size.values()) - 1) < 0.05
    by_words = defaultdict(int)
    for r in mixing.mix(docs, ["source"], repeats=2.0).collect():
        by_words[r["source"]] += 1
    assert by_words["s0"] > 350 > 210 > by_words["s1"]


def test_exponent_extremes(spark):
    shares = spark.createDataFrame([(0.6,), (0.3,), (0.1,)], "p double")
    assert mixing.exponent(shares, 100.0, 100.0, None, None)[0] == 0.0
    assert mixing.exponent(shares, 100.0, 100.0, 0.0, None)[0] == 1.0  # out of reach: the sources' own shares
    assert mixing.exponent(shares, None, 100.0, None, 1.0)[0] == 1.0
    x, budget = mixing.exponent(shares, None, 100.0, None, 3.0)
    assert abs((0.6 / 0.1) ** (1 - x) - 3) < 1e-3 and abs(budget - 100 * sum((p / 0.6) ** x for p in (0.6, 0.3, 0.1)) * 0.6) < 0.1


def test_mixing_edge_cases(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (None, "c", None), (3, "d e f", ""), (4, None, "silent"), (5, "", "silent"), (6, prose(1, 5000), "x")]
    docs = clashing(spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long"))
    got = mixing.mix(docs, docs.columns, repeats=2.0).collect()
    read = defaultdict(int)
    for r in got:
        read[r["doc_id"]] += 1
    assert read[1] == 2 and read[2] == read[6] == read[4] == read[5] == 1 and read[None] >= 1 and read[3] >= 1
    blocks, _ = mixing.plan(docs, repeats=2.0)
    assert [c for c in mixing.mixed(docs, blocks).columns if not c.startswith("__")] == docs.columns
    assert mixing.mix(documents(spark, []), ["doc_id"], repeats=2.0).count() == 0
    silent = docs.where("source = 'silent'")
    assert sorted(r["doc_id"] for r in mixing.mix(silent, ["doc_id"]).collect()) == [4, 5]


TURNS = "conv_id long, turn long, role string, text string"


def _conversations():
    base = [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", "and?"), ("assistant", "so")]
    out = [(1, base), (2, base[:2]), (3, base[:4]), (4, base[:4]), (5, [*base[:3], ("user", "other")]), (6, base[1:]), (7, [("user", "hi")]),
           (8, [("user", "h"), ("i", "")]), (9, base), (10, [("user", "x")] * 2), (11, [(None, None)]), (12, [("", ""), ("user", "t")])]
    rows = [(c, k, r, t) for c, turns in out for k, (r, t) in enumerate(turns)]
    return [*rows, (1, 0, "system", "be kind"), (13, None, "user", "first"), (13, 3, "user", "last"), (14, 2, "b", "same turn"), (14, 2, "a", "same turn")]


def _brute(rows):
    turns = defaultdict(set)
    for c, k, r, t in rows:
        turns[c].add((k is not None, k or 0, r or "", t or ""))
    bodies = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in turns.items()}
    kept = [c for c, b in bodies.items() if not any(len(d) > len(b) and d[:len(b)] == b or d == b and o < c for o, d in bodies.items() if o != c)]
    return sorted((c, 0, len(bodies[c]), "".join(f"<|{r}|>\n{t}\n" for r, t in bodies[c])) for c in kept)


def test_collapse_equals_brute_force_and_sql(spark, tmp_path):
    rows = _conversations()
    spark.createDataFrame(rows, TURNS).withColumns({}).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, queries.op10_chat_snapshot_collapse(spark, str(tmp_path)).collect()))
    assert got == _brute(rows) and len(got) < 14
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(con.execute(chat.SQL).fetchall()) == got


def test_long_conversations_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "SPAN", 4)
    rows = [(c, k, "user", f"t{k}") for c, n in ((1, 30), (2, 11), (3, 30), (4, 31)) for k in range(n)] + [(4, 4, "user", "more")]
    got = sorted(map(tuple, chat.collapse(spark.createDataFrame(rows, TURNS)).collect()))
    whole = defaultdict(str)
    for c, _, _, t in got:
        whole[c] += t
    assert {c: t for c, t in whole.items()} == {c: t for c, _, _, t in _brute(rows)} and max(p for _, p, _, _ in got) == 7


def test_null_conversation_and_empty_table(spark):
    rows = [(None, 0, "user", "a"), (2, 0, "user", "a"), (None, 1, "user", "b")]
    assert [tuple(r) for r in chat.collapse(clashing(spark.createDataFrame(rows, TURNS))).collect()] == [(None, 0, 2, "<|user|>\na\n<|user|>\nb\n")]
    assert chat.collapse(spark.createDataFrame([], TURNS)).count() == 0


def test_sql_keeps_a_conversation_without_an_id(spark, tmp_path):
    import duckdb

    from clickflow.llm import chat

    rows = [(None, 0, "user", "a"), (None, 1, "bot", "b"), (1, 0, "user", "a"), (2, 0, "user", "x"), (3, 0, "user", "a"), (3, 1, "bot", "b"), (4, 0, "user", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.write.parquet(f"{tmp_path}/c.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c.parquet/*.parquet')")
    want = sorted(con.sql(f"SELECT conv_id, part, n_turns, text FROM ({chat.SQL})").fetchall(), key=str)
    got = sorted((tuple(r) for r in chat.collapse(table).collect()), key=str)
    assert got == want and [r[0] for r in got] == [2, None]
