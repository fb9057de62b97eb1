"""Approximate nearest neighbours by inner product: a hierarchical k-means tree searched best bin first.

Vectors get one more component that gives all of them the same length, so that the largest inner product is the
nearest vector. A tree of k-means splits is fitted on a bounded sample; every vector goes down to its leaf. A
query walks the tree through a priority queue of nodes by the distance of their centres and meets leaves best first.
How many leaves are visited is calibrated: for a bounded set of vectors outside the tree's sample the true neighbours
among all rows are found by comparing with everything, and visits widen until the neighbours in visited leaves reach
the target recall in all, and low quantiles of the probes' own recall the levels ``LOW``. A query whose leaves hold
fewer candidates than it asks for goes on until they hold enough, or no leaf is left.
Vectors and queries of a leaf meet in blocks, so no leaf and no query set has to fit one task.

Cases: vectors that are null, empty, zero, of another length than most, or hold null or non-finite components take
no part; ties go to the smaller id; a query's own id is no candidate; of rows that repeat a query's id one is the
query, while every row is a candidate; empty tables give an empty result. Only the columns named in the call are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import saved
from clickflow.llm.vectors import dimension, matrix, usable

#: Vectors that the tree is fitted on; children of a node; sampled vectors of a leaf, about; vectors that visits are calibrated with.
SAMPLE, BRANCH, LEAF, CALIBRATE = 16_384, 16, 64, 512
TARGET = 0.97
#: (share of the probes, recall): all but this share of the probes find this much of their own neighbours.
LOW = ((0.02, 0.8), (0.005, 0.5))
#: Vectors and queries of a leaf that are compared in one go.
BLOCK, QUERY_BLOCK = 8192, 2048


@dataclass
class Tree:
    """Nodes in order of depth: ``centres``; ``children``: node numbers, or none; ``leaf``: number of the leaf or -1; ``reach``: the longest vector."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    reach: float

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """With the component that makes all vectors as long as the longest; queries get 0 there."""
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.reach**2 - (x * x).sum(axis=1)))
        return np.concatenate([x, more[:, None]], axis=1)

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each vector belongs to."""
        y = self.lifted(x)
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            open_ = [n for n in np.unique(at).tolist() if self.children[n]]
            if not open_:
                return np.array(self.leaf)[at]
            for n in open_:
                rows = np.flatnonzero(at == n)
                kids = np.array(self.children[n])
                at[rows] = kids[_distances(y[rows], self.centres[kids]).argmin(axis=1)]

    def best_first(self, x: np.ndarray, visits: int, sizes: np.ndarray | None = None, need: np.ndarray | None = None) -> list[list[int]]:
        """For each query the first ``visits`` leaves that the priority queue gives, and more until they hold ``need`` vectors by the leaves' ``sizes``."""
        far = _distances(self.lifted(x, query=True), self.centres)
        out = []
        for i, d in enumerate(far.tolist()):
            queue, met, missing = [(0.0, 0)], [], 0 if need is None else int(need[i])
            while queue and (len(met) < visits or missing > 0):
                _, n = heapq.heappop(queue)
                if self.children[n]:
                    for kid in self.children[n]:
                        heapq.heappush(queue, (d[kid], kid))
                else:
                    met.append(self.leaf[n])
                    missing -= 0 if sizes is None else int(sizes[self.leaf[n]])
            out.append(met)
        return out


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (c * c).sum(axis=1)[None] - 2 * (x @ c.T)


def _split(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = _distances(x, centres).argmin(axis=1)
        for j in range(k):
            if (own == j).any():
                centres[j] = x[own == j].mean(axis=0)
    return centres, _distances(x, centres).argmin(axis=1)


def fit_tree(sample: np.ndarray, reach: float, branch: int = BRANCH, leaf: int = LEAF) -> Tree:
    rng = np.random.default_rng(11)
    tree = Tree(np.zeros((0, sample.shape[1] + 1)), [], [], reach)
    y = tree.lifted(sample)
    centres, waiting = [y.mean(axis=0)], [np.arange(len(y))]
    done = 0
    while done < len(waiting):
        rows, done = waiting[done], done + 1
        tree.children.append([])
        tree.leaf.append(-1)
        if len(rows) > leaf:
            found, own = _split(y[rows], min(branch, max(2, len(rows) // leaf)), rng)
            parts = [rows[own == j] for j in range(len(found))]
            if max(map(len, parts)) < len(rows):  # equal vectors can't be split
                for j, p in enumerate(parts):
                    tree.children[-1].append(len(waiting))
                    waiting.append(p)
                    centres.append(found[j])
                continue
        tree.leaf[-1] = sum(x >= 0 for x in tree.leaf)
    tree.centres = np.array(centres)
    return tree


def _best(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of the ``k`` nearest of ``x`` for each query: exact scores, ties to smaller ids."""
    near = q @ x.T
    near[q_id[:, None] == x_id[None]] = -np.inf
    rows, cols, scores = [], [], []
    kth = -np.partition(-near, min(k, near.shape[1]) - 1, axis=1)[:, min(k, near.shape[1]) - 1]
    for i in range(len(q)):
        # all that rounding might put among the first k, then the same sum for each
        at = np.flatnonzero((near[i] >= kth[i] - 1e-9 * max(1.0, abs(kth[i]))) & (near[i] > -np.inf)) if np.isfinite(kth[i]) else np.flatnonzero(near[i] > -np.inf)
        s = (x[at] * q[i]).sum(axis=1)
        order = np.lexsort((x_id[at], -s))[:k]
        rows.append(np.full(len(order), i))
        cols.append(at[order])
        scores.append(s[order])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(scores)


def visits_needed(found: np.ndarray, target: float, low: tuple[tuple[float, float], ...] = LOW) -> int:
    """The fewest visits that reach ``target`` in all and the levels ``low``. ``found``: [probes, leaves], true neighbours in the leaf of each visit."""
    found = found[found.sum(axis=1) > 0]
    if not len(found):
        return 1
    got, n = np.cumsum(found, axis=1), found.sum(axis=1)
    ok = got.sum(axis=0) >= target * n.sum()
    each = np.sort(got / n[:, None], axis=0)
    for share, level in low:
        ok &= each[int(share * len(found))] >= min(level, target)
    return int(np.flatnonzero(ok)[0]) + 1  # with all leaves everything is found


def _calibrated(rows: DataFrame, probes: list, tree: Tree, sizes: np.ndarray, dim: int, k: int, target: float) -> int:
    """Leaves to visit so that the probes find their true neighbours among all rows as ``visits_needed`` says."""
    q, q_id = np.array([r["v"] for r in probes], dtype=np.float64), np.array([r["id"] for r in probes])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.float64, np.int64)]  # of all that the task has read: probe, id, score, leaf
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                x, x_id, leaf = matrix(batch.column("v"), dim), batch.column("id").to_numpy(), batch.column("leaf").to_numpy()
                for first in range(0, len(q), 256):
                    i, j, s = _best(q[first:first + 256], q_id[first:first + 256], x, x_id, k)
                    best = [np.concatenate(c) for c in zip(best, (i + first, x_id[j], s, leaf[j]), strict=True)]
                order = np.lexsort((best[1], -best[2], best[0]))
                probe = best[0][order]
                order = order[np.arange(len(order)) - np.searchsorted(probe, probe) < k]
                best = [c[order] for c in best]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best], ["q", "id", "score", "leaf"])

    nth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    true = rows.select("id", "v", "leaf").mapInArrow(task, "q long, id long, score double, leaf long").withColumn("nth", nth).where(F.col("nth") <= k).select("q", "leaf").collect()
    every = tree.best_first(q, len(sizes))
    rank = np.argsort(np.array(every), axis=1)  # of each leaf
    # leaves that a probe visits anyway, to meet enough vectors
    anyway = np.array([len(met) for met in tree.best_first(q, 1, sizes, np.full(len(q), k + 1))])
    found = np.zeros(rank.shape, dtype=np.int64)
    for r in true:
        at = rank[r["q"], r["leaf"]]
        found[r["q"], at if at >= anyway[r["q"]] else 0] += 1
    return visits_needed(found, target)


def search(vectors: DataFrame, is_query: Column, k: int = 20, target: float = TARGET, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``k`` found vectors of largest inner product, nearest first."""
    spark = vectors.sparkSession
    dim = dimension(vectors, vector)
    rows = vectors.where(usable(vector) & (F.size(vector) == dim) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    drawn = rows.select("id", "v").orderBy(F.xxhash64("id", F.lit(5)), "id", "v").limit(SAMPLE + CALIBRATE).collect()
    if not drawn:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    square = F.aggregate("v", F.lit(0.0), lambda t, e: t + e * e)
    reach = float(rows.agg(F.max(square)).first()[0]) ** 0.5
    held = min(CALIBRATE, len(drawn) // 4)  # probes, which the tree isn't fitted on
    sample = drawn[:len(drawn) - held]
    tree = fit_tree(np.array([r["v"] for r in sample], dtype=np.float64), reach)

    def to_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("leaf", pa.array(tree.leaves_of(matrix(batch.column("v"), dim)), pa.int64()))

    index, _ = saved(spark, rows.mapInArrow(to_leaf, "id long, v array<double>, asks boolean, leaf long"), "ann-index")
    sizes = np.zeros(sum(x >= 0 for x in tree.leaf), dtype=np.int64)
    for r in index.groupBy("leaf").count().collect():  # as many rows as the tree has leaves, at most SAMPLE
        sizes[r["leaf"]] = r["count"]
    visits = _calibrated(index, drawn[len(sample):] or sample, tree, sizes, dim, k, target)

    def to_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                met = tree.best_first(matrix(batch.column("v"), dim), visits, sizes, k + batch.column("own").to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(met, pa.list_(pa.int64()))], ["id", "v", "leaves"])

    # rows of the query's own id are no candidates
    own = index.groupBy("id").agg(F.count("*").alias("own")).where("own > 1")
    queries = index.where("asks").groupBy("id").agg(F.min("v").alias("v")).join(own, "id", "left").select("id", "v", F.coalesce("own", F.lit(1)).alias("own"))
    queries = queries.mapInArrow(to_leaves, "id long, v array<double>, leaves array<long>").select("id", "v", F.explode("leaves").alias("leaf"))
    blocks = index.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    asked = queries.groupBy("leaf").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("groups"))
    plan, _ = saved(spark, blocks.join(asked, "leaf"), "ann-plan")
    plan = F.broadcast(plan)
    block, group = F.pmod(F.hash("id", F.lit(1)), F.col("blocks")).cast("int"), F.pmod(F.hash("id", F.lit(2)), F.col("groups")).cast("int")
    right = index.join(plan, "leaf").select("leaf", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("grp"), "id", "v")
    left = queries.join(plan, "leaf").select("leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), group.alias("grp"), "id", "v")

    def compared(asks: pa.Table, has: pa.Table) -> pa.Table:
        if not asks.num_rows or not has.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], ["query_id", "vec_id", "score"])
        q, q_id, x, x_id = matrix(asks.column("v"), dim), asks.column("id").to_numpy(), matrix(has.column("v"), dim), has.column("id").to_numpy()
        out = []
        for at in range(0, len(q), 256):
            i, j, s = _best(q[at:at + 256], q_id[at:at + 256], x, x_id, k)
            out.append((q_id[at:at + 256][i], x_id[j], s))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    by = ("leaf", "block", "grp")
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(compared, "query_id long, vec_id long, score double")
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", nth.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
