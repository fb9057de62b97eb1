"""Embedding near-duplicates and nearest neighbours against comparing everything."""

import numpy as np
import pytest
from llm_util import clashing

from clickflow.llm import ann, embedding_dups, queries

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [(9001, None), (9002, []), (9003, [0.0] * 16), (9004, [float("nan")] * 16), (9005, [float("inf")] + [1.0] * 15), (9006, [None] + [1.0] * 15), (9007, [1.0, 2.0]), (9008, None)]


def _vectors(n=600, dim=16, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim)).astype(np.float32)
    for i in range(200):  # near copies of a few, in groups
        x[i] = x[200 + i % 12] + r.normal(size=dim).astype(np.float32) * 0.08
    x[580:] = x[579]  # equal ones
    x *= r.uniform(0.5, 2, size=(n, 1)).astype(np.float32)
    x[590:] = x[589]
    return x


def _table(spark, x, odd=True):
    return spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)] + [(i, v, 1) for i, v in (ODD if odd else [])], SCHEMA)


def test_near_duplicates_equal_all_pairs(spark, tmp_path):
    x = _vectors().astype(np.float64)
    clashing(_table(spark, x)).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r for r in queries.op7_embedding_pivot_dups(spark, str(tmp_path)).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = (u @ u.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    assert len(got) == len(x) + len(ODD)
    n = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (n <= link.sum(axis=1)).all() and n.sum() >= 0.97 * link.sum()
    root = np.arange(len(x))
    for _ in range(20):
        root = np.array([min(root[i], root[link[i]].min(initial=10**6)) for i in range(len(x))])
    c = np.array([got[i]["component_id"] for i in range(len(x))])
    assert (c == root).mean() > 0.98 and all(got[i]["kept"] == (c[i] == i) for i in range(len(x)))
    for i, _ in ODD:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)


def test_near_duplicates_over_several_blocks_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(embedding_dups, "BLOCK", 16)
    x = _vectors()
    one = embedding_dups.near_duplicates(_table(spark, x, odd=False))
    monkeypatch.setattr(embedding_dups, "BLOCK", 1024)
    other = embedding_dups.near_duplicates(_table(spark, x, odd=False))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [2.0, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, embedding_dups.near_duplicates(rows).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (3, 0, 3, True)], key=str)


def test_links_of_a_hot_group_and_of_small_ones(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    noise = r.normal(size=x.shape) / 8
    x[:1000] = x[0] + 0.2 * noise[:1000]  # a third: near-copies of one vector, cosine about 0.96
    x[1000:1400] = x[1400:1800] + 0.2 * noise[1000:1400]  # pairs
    got = {row["vec_id"]: row["n_links"] for row in embedding_dups.near_duplicates(_table(spark, x, odd=False)).collect()}
    u = x.astype(np.float32).astype(np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    true = (u @ u.T >= 0.95).sum(axis=1) - 1
    n = np.array([got[i] for i in range(len(x))])
    assert (n <= true).all() and true[:1000].sum() > 500_000 and true[1000:1800].sum() > 700
    assert n[:1000].sum() >= 0.95 * true[:1000].sum() and n[1000:1800].sum() >= 0.9 * true[1000:1800].sum()


def test_pivots_keep_apart_and_lists_widen_for_small_groups():
    r = np.random.default_rng(6)
    x = r.normal(size=(600, 64))
    x[::2] = x[0] + 0.02 * r.normal(size=(300, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    chosen = embedding_dups.spread(x, 100, 0.95)
    assert len(chosen) == 100 and (chosen % 2 == 0).sum() == 1
    assert ((x[chosen] @ x[chosen].T >= 0.95) == np.eye(100, dtype=bool)).all()
    # 40 probes with 1,000 links that share the first list, 32 with one that shares the third: the few decide
    links = np.zeros((72, 5), dtype=np.int64)
    links[:40, 0], links[40:, 2] = 1000, 1
    assert embedding_dups.lists_needed(links, 0.97) == 3
    links[40:] = [0, 0, 0, 0, 1]
    assert embedding_dups.lists_needed(links, 0.97) is None


@pytest.mark.parametrize("odd", [True, False])
def test_search_finds_the_nearest(spark, tmp_path, odd):
    x = _vectors(1500, seed=3).astype(np.float64)
    clashing(_table(spark, x, odd)).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op8_ann_kmeans_tree(spark, str(tmp_path)).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(by) == list(range(0, 1500, 20))
    hits = 0
    for q, found in by.items():
        s = x @ x[q]
        s[q] = -np.inf
        order = np.lexsort((np.arange(len(x)), -s))[:20]
        hits += len({v for _, v, _ in found} & set(order.tolist()))
        assert [k for k, _, _ in found] == list(range(1, 21)) and found == sorted(found, key=lambda f: (-f[2], f[1]))
        assert all(abs(s[v] - score) < 1e-9 for _, v, score in found)
    assert hits / (20 * len(by)) >= 0.9


def test_every_query_gets_its_number_of_neighbours(spark):
    from pyspark.sql import functions as F

    r = np.random.default_rng(8)
    x = r.normal(size=(4000, 32))
    x[:3800] = x[np.arange(3800) // 38] + 0.02 * r.normal(size=(3800, 32))  # groups of 38 near-copies, and 200 lone vectors
    x = x.astype(np.float32).astype(np.float64)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3999, x[3999].tolist())] * 40  # a query's own rows are no candidates
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 5 == 4, k=20).collect()
    by = {i: [] for i in range(4, 4000, 5)}
    for row in got:
        by[row["query_id"]].append(row["vec_id"])
    assert {len(v) for v in by.values()} == {20}
    recall = []
    for q, found in by.items():
        s = x @ x[q]
        s[q] = -np.inf
        if q != 3999:  # 3999 may stand in others' lists 41 times
            s = np.concatenate([s, np.full(40, s[3999])])
        kth = np.sort(s)[-20]
        recall.append(sum(s[v] >= kth for v in found) / 20)
    assert np.mean(recall) >= 0.95 and np.quantile(recall, 0.02) >= 0.4


def test_leaves_go_on_until_they_hold_enough_and_low_quantiles_count():
    r = np.random.default_rng(9)
    tree = ann.fit_tree(r.normal(size=(2000, 8)), 6.0)
    sizes = np.arange(sum(n >= 0 for n in tree.leaf)) % 3  # a third of the leaves are empty
    for met in tree.best_first(r.normal(size=(20, 8)), 1, sizes, np.full(20, 7)):
        assert sizes[met].sum() >= 7 > sizes[met[:-1]].sum()
    assert all(len(met) == len(sizes) for met in tree.best_first(r.normal(size=(2, 8)), 1, sizes, np.full(2, 10**6)))
    found = np.zeros((100, 9), dtype=np.int64)
    found[:98, 0], found[98:, 7] = 20, 20  # 98 find everything at the first leaf, two at the eighth
    assert ann.visits_needed(found, 0.97, ()) == 1 and ann.visits_needed(found, 0.97) == 8


def test_search_blocks_ties_and_few_rows(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(ann, "BLOCK", 8)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 2)
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(30, [3.0, 0.0]), (40, [-1.0, 1.0]), (0, [1.0, 0.0])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=5, target=1.0).collect()
    by = {q: [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 20, 40)}
    assert by[0] == [(30, 3.0), (1, 1.0), (2, 1.0), (3, 1.0), (4, 1.0)]
    assert by[20] == [(30, 3.0), (0, 1.0), (0, 1.0), (1, 1.0), (2, 1.0)]
    assert by[40][0] == (0, -1.0)
    assert ann.search(spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>"), F.lit(True), k=5).count() == 6


def test_empty_tables(spark):
    from pyspark.sql import functions as F

    empty = spark.createDataFrame([], SCHEMA)
    assert embedding_dups.near_duplicates(empty).count() == 0 and ann.search(empty, F.lit(True)).count() == 0
    odd = spark.createDataFrame([(i, v, 1) for i, v in ODD], SCHEMA).where("vec_id <> 9007")
    assert embedding_dups.near_duplicates(odd).where("n_links > 0 or not kept").count() == 0 and ann.search(odd, F.lit(True)).count() == 0
