"""The n-gram join and the components against brute force over all pairs."""

import random

import pytest
from llm_util import clashing, documents, edge_texts, prose

from clickflow.llm import ngram_join, queries
from clickflow.llm.components import components


def _sets(texts, n):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


def _brute(rows, n, percent):
    """[(id, set size, smallest id reachable)] of each row."""
    sets = _sets([t for _, t in rows], n)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            groups[find(i)] = min(d, groups.get(find(i), d))
    return sorted(((d, len(s), groups.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _near(text, edits, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (1, 60)])
def test_equals_all_pairs(spark, n, percent):
    shared = prose(99, 60)  # a passage in many texts
    texts = [prose(i, 40 + i) for i in range(20)]
    texts += [_near(prose(i % 5, 120), i % 4, i) for i in range(60)] + [f"{prose(300 + i, 12)} {shared} {prose(400 + i, 6)}" for i in range(25)]
    texts += [prose(i, 3) for i in range(6)] + ["A B c", "a b C", "a\x0bb\x0cc", "a\xa0b c"] + [prose(3, 43)] * 5
    rows = list(enumerate(texts))
    random.Random(n).shuffle(rows)
    got = _got(ngram_join.join(documents(spark, rows), n, percent))
    assert got == _brute(rows, n, percent)
    assert any(c != d for d, _, c in got)


def test_second_pass_finds_links_that_no_hub_has(spark):
    # a chain of texts: each links with the next only, so that hubs alone can't join them
    words = [f"w{i}" for i in range(200)]
    rows = [(100 - k, " ".join(words[3 * k:3 * k + 60])) for k in range(30)]
    assert _got(ngram_join.join(documents(spark, rows), 4, 85)) == _brute(rows, 4, 85)


def test_edge_cases_and_clashing_columns(spark, tmp_path):
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(edge_texts())]
    df = clashing(documents(spark, rows))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert _got(queries.op4_ngram_jaccard_join(spark, str(tmp_path))) == _brute(rows, 4, 85)
    kept = ngram_join.first_of_groups(df)
    assert kept.columns == df.columns
    left = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    # 6 repeats 5's text; the two rows of (5, prose 4) are one document
    assert [x[1] for x in left if not x[0]].count(5) == 2 and len(left) == len(rows) - 2
    assert _got(ngram_join.join(documents(spark, []))) == [] and ngram_join.first_of_groups(documents(spark, [])).count() == 0


def test_rows_without_an_id_are_bridges(spark):
    words = [f"w{i}" for i in range(120)]
    a, b, c = (" ".join(words[k:k + 100]) for k in (0, 7, 14))  # a ~ b ~ c, but not a ~ c
    for middle in (None, 2):
        rows = [(1, a), (middle, b), (3, c), (None, b), (None, "no such words here at all"), (9, "something else again it is")]
        got = _got(ngram_join.join(documents(spark, rows), 4, 85))
        assert got == _brute(rows, 4, 85) and [x[2] for x in got if x[0] in (1, 3, middle)].count(1) >= 3
    alone = [(None, a), (None, b), (7, prose(1))]
    assert _got(ngram_join.join(documents(spark, alone), 4, 85)) == _brute(alone, 4, 85)


def test_a_column_that_a_third_of_all_classes_hold(spark, monkeypatch):
    """Near-copies of one text that mostly don't link with each other: their columns are long, and met in blocks."""
    monkeypatch.setattr(ngram_join, "COLUMN_BLOCK", 40)
    base = prose(77, 110)
    texts = [_near(base, 3 + i % 5, i) for i in range(150)] + [prose(1000 + i, 60) for i in range(300)] + [_near(prose(5, 900), i, 70 + i) for i in range(30)]
    rows = list(enumerate(texts))
    assert _got(ngram_join.join(documents(spark, rows), 4, 85)) == _brute(rows, 4, 85)


def test_parities_never_hide_a_link():
    import numpy as np

    r = np.random.default_rng(5)
    for size in (5, 60, 340, 345, 700, 3000):
        x = np.unique(r.integers(0, 2**63, size).astype(np.uint64))
        for share in (0.8, 0.85, 0.95, 1.0):
            y = np.concatenate([x[:int(share * len(x))], r.integers(0, 2**63, max(1, size // 9)).astype(np.uint64)])
            y = np.unique(y)
            both = len(np.intersect1d(x, y))
            bits = [np.frombuffer(ngram_join.parity(s), dtype=np.uint64)[None, :] for s in (x, y)]
            while bits[0].shape != bits[1].shape:
                k = int(bits[1].shape[1] > bits[0].shape[1])
                bits[k] = ngram_join.folded(bits[k])
            apart = int(np.bitwise_count(bits[0] ^ bits[1]).sum())
            assert apart <= len(x) + len(y) - 2 * both
            for percent in (60, 80, 85):
                if 100 * both >= percent * (len(x) + len(y) - both):
                    assert apart <= ngram_join.most_apart(np.int64(len(x)), len(y), percent)


def test_first_of_groups_with_repeated_and_null_ids(spark):
    words = prose(8, 80)
    rows = [(1, words), (2, words + " more"), (2, "a text unlike any other one here"), (None, words + " again"), (None, "another text of its own it is"), (None, None), (None, None),
            (4, None), (4, None), (4, ""), (0, words + " end")]
    left = sorted(((r["doc_id"], r["text"]) for r in ngram_join.first_of_groups(documents(spark, rows)).collect()), key=str)
    assert left == sorted([(0, words + " end"), (2, "a text unlike any other one here"), (None, "another text of its own it is"), (None, None), (4, None), (4, "")], key=str)


def test_order_of_grams_is_total_and_bounds_hold():
    import numpy as np

    s = ngram_join.Shingler(2).sets(["a b c d a b", "a", ""])
    assert [len(x) for x in s] == [4, 1, 0] and ngram_join.Shingler(2).sets(["a"])[0] == s[1]
    classes = np.random.default_rng(0).integers(0, 5, 1 << ngram_join.SLOT_BITS).astype(np.uint8)
    x = np.unique(np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2))
    part, _ = ngram_join._ordered(x[::3], classes)
    whole, own = ngram_join._ordered(x, classes)
    assert (np.diff(own.astype(int)) >= 0).all()
    assert [v for v in whole.tolist() if v in set(part.tolist())] == part.tolist()


def test_components_of_random_and_extreme_graphs(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)]
    edges += [(1000 + i, 1001 + i) for i in range(80)] + [(5000, 5001 + i) for i in range(300)] + [(7, 7), (9000, 9001), (9000, 9001), (9001, 9000)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"))
    assert {r["id"]: r["component"] for r in got.collect()} == want and got.count() == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
