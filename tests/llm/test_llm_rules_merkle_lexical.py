"""Line rules, the dataset manifest and ranked lexical search against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from llm_util import DOCS, clashing, documents, edge_texts, prose
from pyspark.sql import functions as F

from clickflow.llm import lexical, linerules, merkle

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# line rules


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    inside = {k + j for k, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in range(3)}
    lines = text.split("\n")
    again = sum(bool(WORD.search(x)) and x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)


def test_base_equals_brute_force(spark):
    r = random.Random(4)
    texts = edge_texts() + ["a b c a b c", "a a a a", "x\ny\nx\n\n\n  \n  \nx ", "one two three"] + [
        " ".join(r.choice("abc") for _ in range(r.randint(0, 40))) + "\n" + " ".join(r.choice("ab#|") for _ in range(5)) for _ in range(60)]
    docs = clashing(documents(spark, [(i, t[1] if isinstance(t, tuple) else t) for i, t in enumerate(texts)]))
    got = {x["doc_id"]: x for x in linerules.rules(docs, ["doc_id", "score", "text"]).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t = t[1] if isinstance(t, tuple) else t
        x = got[i]
        base = brute_base(t)
        assert tuple(x[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == base, (i, t and t[:80])
        assert x["base_failed"] == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (x["kept"] and x["base_failed"]) and x["score"] == "own"


def test_lines(spark):
    fails = lambda line: linerules.line_fails(line, line.encode().split(), sum(map(line.count, "#*$%&|<>")))
    for line in ("Home | About | Contact", "Home", "Sign in.", "Next Previous.", "https://a.b/c www.x.y.", "Released under the MIT License.", "All rights reserved.",
                 "no end of a sentence", "W!! O!! R!! D!! S!! A!! B!! C!! D!! E!!.", "a### b&&& c$$$ d.", "abc " * 30 + "| x | y | z | " * 9):
        assert fails(line), line
    for line in ("A sentence.", "Really?", "He said: “no.”", "R & D costs rise in every year, they said.", "Und so weiter…", prose(7, 40), "We read the privacy policy " + "again and again " * 10 + "."):
        assert not fails(line), line


def test_clean(spark):
    good = "\n".join(prose(k, 9).rstrip(",.") + "." for k in range(12))
    menu = "Home | About | Contact"
    texts = [good, good + "\n" + menu + "\nAll rights reserved.", "\n".join([menu + " | %d" % k for k in range(40)]) + "\n" + good[:300], None, "", good + "\n" + good]
    docs = clashing(documents(spark, texts))
    got = {x["doc_id"]: x for x in linerules.clean(docs).collect()}
    assert set(got) == {0, 1}
    assert got[0]["text"] == got[1]["text"] == good and got[1]["n_chars"] == len(good) and got[0]["n_chars"] == len(good)
    assert linerules.clean(docs.limit(0)).count() == 0 and linerules.rules(docs.limit(0), ["doc_id"]).count() == 0


# manifest


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree_levels(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append([h(out[-1][k:k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def path(levels, at):
    out = []
    for level in levels[:-1]:
        run = at // 8 * 8
        out.append((level[run:at], level[at + 1:run + 8]))
        at //= 8
    return out


def brute_manifest(rows):
    leaf = lambda d, t: h([enc(d["doc_id"]), enc(d["source"]), enc(d["lang"]), enc(d["n_chars"]), enc(t)])
    trees = {}
    for d in rows:
        low = d["text"] and re.sub("[A-Z]", lambda m: m.group().lower(), d["text"])
        own = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 3 == 0
        trees.setdefault(d["lang"], []).append((d["doc_id"], leaf(d, d["text"]), leaf(d, low if own else d["text"])))
    for x in trees.values():
        x.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    built = {k: tree_levels([r[1] for r in trees[k]]) for k in order}
    forest = tree_levels([built[k][-1][0] for k in order])
    root = forest[-1][0]
    out = []
    for j, k in enumerate(order):
        for at, (i, own, other) in enumerate(trees[k]):
            way = path(built[k], at) + path(forest, j)
            top = other
            for a, b in way:
                top = h([*a, top, *b])
            out.append((i, own, built[k][-1][0], root, h([x for a, b in way for x in a + b]), top, top == root))
    return out


def sorted_rows(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def check_manifest(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    got = [tuple(r) for r in merkle.manifest(clashing(docs), merkle.lower_every_third(docs)).collect()]
    assert sorted_rows(got) == sorted_rows(brute_manifest([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows]))
    return got


def test_manifest_equals_brute_force(spark, monkeypatch):
    r = random.Random(2)
    texts = edge_texts()
    rows = [(i, "Text %d" % i, r.choice(["en", "en", "en", "de", None, "", "é", "=x"]), r.choice(["a", None]), r.choice([None, i])) for i in r.sample(range(-50, 900), 700)]
    rows += [(i, t[1] if isinstance(t, tuple) else t, "fr", "s", 1) for i, t in enumerate(texts)] + [(None, "No Id", "en", "a", 3)] * 3 + [(5, "Again", "de", "a", 1)] * 2
    got = check_manifest(spark, rows)
    assert {x[6] for x in got} == {True, False}
    # small blocks: several rounds above the first one
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    assert sorted_rows(check_manifest(spark, rows)) == sorted_rows(got)


def test_manifest_of_few_rows(spark):
    (one,) = check_manifest(spark, [(3, "A", "en", "s", 1)])
    assert one[1] == one[2] == one[3] and one[4] == h([])
    check_manifest(spark, [(3, "A", "en", "s", 1), (4, None, None, None, None)])
    docs = spark.createDataFrame([], DOCS)
    assert merkle.manifest(docs, merkle.lower_every_third(docs)).count() == 0


def test_versions_share_untouched_nodes():
    built = merkle.Nodes([h([str(k)]) for k in range(100)], None)
    size, before = len(built.digests), list(built.digests)
    top = built.version(37, h(["other"]))
    assert len(built.digests) == size + 1 + built.height and built.digests[:size] == before
    leaves = [h(["other"]) if k == 37 else h([str(k)]) for k in range(100)]
    assert built.digests[top] == tree_levels(leaves)[-1][0] and built.digests[built.top] == tree_levels([h([str(k)]) for k in range(100)])[-1][0]
    reached, todo = set(), [top]
    while todo:
        node = todo.pop()
        reached.add(node)
        todo += built.children[node]
    assert len([n for n in reached if n >= size]) == 1 + built.height  # all else is shared
    built.forget(size)
    assert built.digests == before


# ranked lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_search(docs, items, k):
    counts = [(i, Counter(brute_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(brute_terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, rank + 1, None if no else i, -s) for rank, (s, no, i) in enumerate(sorted(scores)[:k])]
    return out


def test_search_equals_brute_force(spark, monkeypatch):
    r = random.Random(9)
    texts = [(i, t[1] if isinstance(t, tuple) else t) for i, t in enumerate(edge_texts())] + [(None, "lorem ipsum zebra"), (7, "zebra zebra lorem"), (7, "zebra zebra lorem")]
    texts += [(100 + i, " ".join(r.choice("abcdefghijé漢") * r.randint(1, 2) for _ in range(r.randint(0, 30)))) for i in range(400)] + [(900 + i, "copy of a copy") for i in range(60)]
    items = [("p", "Lorem IPSUM dolor"), ("q", "a b c dé 漢 漢"), ("r", "nothing-here"), ("s", None), ("t", ""), ("u", "copy of zebra"), ("v", "copy a"), (None, "ipsum amet"),
             *((f"x{j}", " ".join(r.choice("abcdefghij") * r.randint(1, 2) for _ in range(8))) for j in range(12))]
    docs = clashing(documents(spark, texts)).repartition(3)
    asked = clashing(spark.createDataFrame(items, "item_id string, text string"))
    want = sorted_rows(brute_search(texts, items, 10))
    assert sorted_rows(tuple(x) for x in lexical.search(docs, asked).collect()) == want
    # many shards, narrow steps and several blocks of items
    for name, value in (("SHARD_DOCS", 16), ("WIDE", 2), ("ITEM_CHARS", 60)):
        monkeypatch.setattr(lexical, name, value)
    assert sorted_rows(tuple(x) for x in lexical.search(docs, asked).collect()) == want
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 40)
    assert sorted_rows(tuple(x) for x in lexical.search(docs, asked, k=3).collect()) == sorted_rows(brute_search(texts, items, 3))


def test_search_of_empty_tables(spark):
    docs, asked = documents(spark, []), spark.createDataFrame([], "item_id long, text string")
    assert lexical.search(docs, asked).count() == 0
    assert lexical.search(documents(spark, [None, ""]), spark.createDataFrame([(1, "a")], asked.schema)).count() == 0
    assert lexical.search(documents(spark, ["a b"]), asked).count() == 0


def test_range_maxima_and_pruning():
    r = np.random.default_rng(3)
    counts = [5, 1, 700, 64, 2000]
    docs = np.concatenate([np.sort(r.choice(2000, c, replace=False)) for c in counts])
    impact = r.integers(1, 50, len(docs))
    starts = np.concatenate([[0], np.cumsum(counts)])
    shard = lexical.Impacts(starts, docs, impact, 2000)
    for _ in range(300):
        t = int(r.integers(0, 5))
        lo, hi = np.sort(r.integers(starts[t], starts[t + 1] + 1, 2))
        at = int(shard.greatest(np.array([[lo]]), np.array([[hi]]))[0, 0])
        assert at == (lo + int(np.argmax(impact[lo:hi])) if hi > lo else len(docs))
    places, own = shard.place(np.arange(5), np.arange(2000))
    for t in range(5):
        part = docs[starts[t]:starts[t + 1]]
        assert (places[:, t] - starts[t] == np.searchsorted(part, np.arange(2000))).all() and (own[:, t] == np.isin(np.arange(2000), part)).all()
    # one document of great impact: found without scoring all
    impact = np.ones(len(docs), dtype=np.int64)
    impact[100], impact[2100] = 10**6, 10**6
    names = [(False, k, 1, 0) for k in range(2000)]
    assert lexical.search_shard(lexical.Impacts(starts, docs, impact, 2000), np.arange(5), names, lexical.Best(1, [])) < 1000


def test_keys_of_the_new_queries(spark):
    from clickflow.llm.queries import QUERIES, SQL

    for name in ("op11_line_rules", "op12_merkle_manifest", "op13_ranked_lexical_search"):
        assert name in QUERIES and name in SQL
    assert QUERIES["op11_line_rules"](spark, "/root/testdata/sf0.001").where(F.col("base_failed") & F.col("kept")).count() == 0
