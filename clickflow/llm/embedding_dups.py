"""Embedding near-duplicates through a pivot-permutation index.

Reference points (pivots) are drawn from a bounded sample of the vectors, about the square root of their number, so
that no two of them are linked: a dense group gets few, however many rows it holds. A vector is described by its
nearest pivots in order and stands in the inverted lists of the first of them; two vectors that share a list are
candidates, and linked if their cosine in double precision reaches the limit. In how many lists a vector stands is
calibrated: a bounded set of vectors that are no pivots is compared with all rows, and the lists widen until the pairs
that share one hold the target recall of the true links, in all and in each part of the probes by number of links, so
that large groups don't decide for small ones. With hardly a link among the probes, partners made just at the limit
take their place. Equal vectors are one class with a weight. A long list is split into blocks, and every pair of blocks
is a task of its own; a pair that meets in several lists counts in the list of the smallest pivot that both stand in. A
task passes on sums of links and a forest, never all pairs.

Cases: vectors that are null, empty, zero, of another length than most, or hold null or non-finite components link
with nothing; equal vectors link; a repeated row is a vector each; a null id may be linked but is nobody's
component; empty tables give an empty result. Only the columns named in the call are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import saved
from clickflow.llm.components import components
from clickflow.llm.vectors import dimension, lists, matrix, usable

#: Pivots at most; vectors that they are drawn from, at most; lists a vector stands in, at least; vectors of a list that are compared in one go.
PIVOTS, DRAWN, PROBES, BLOCK = 4096, 16_384, 4, 1024
#: Vectors that are compared with all rows; links found among them, at least, of all and of each part; probes with links of a part, at least; descriptions that are tried first.
CALIBRATE, TARGET, PART, LENGTH = 2048, 0.97, 32, 64
#: Pairs whose descriptions are compared in one go.
PAIRS = 65_536


def spread(drawn: np.ndarray, wanted: int, limit: float) -> np.ndarray:
    """Numbers of the first ``wanted`` of the unit vectors ``drawn`` of which none reaches ``limit`` with one before it."""
    chosen: list[int] = []
    for at in range(0, len(drawn), 256):
        part = drawn[at:at + 256]
        free = (part @ drawn[chosen].T < limit).all(axis=1)
        within = part @ part.T < limit
        for i in range(len(part)):
            if free[i]:
                chosen.append(at + i)
                if len(chosen) == wanted:
                    return np.array(chosen)
                free &= within[i]
    return np.array(chosen, dtype=np.int64)


def nearest(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """For each row of ``x`` its ``length`` nearest pivots by cosine, nearest first."""
    far = -(x @ pivots.T) / np.linalg.norm(x, axis=1)[:, None]
    if length < len(pivots):
        near = np.sort(np.argpartition(far, length - 1, axis=1)[:, :length], axis=1)
    else:
        near = np.broadcast_to(np.arange(len(pivots)), far.shape)
    return np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable"), axis=1).astype(np.int32)


def _ranks(near: np.ndarray, pivots: int) -> np.ndarray:
    ranks = np.full((len(near), pivots), near.shape[1], dtype=np.int32)
    np.put_along_axis(ranks, near, np.arange(near.shape[1], dtype=np.int32)[None], axis=1)
    return ranks


def _described(classes: DataFrame, pivots: np.ndarray, length: int) -> DataFrame:
    """``classes`` with ``near``: the nearest pivots by cosine, nearest first."""
    dim = pivots.shape[1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                near = nearest(matrix(batch.column("v"), dim), pivots, length)
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("weight"), batch.column("v"), lists(near)], ["key", "weight", "v", "near"])

    return classes.select("key", "weight", "v").mapInArrow(task, "key long, weight long, v array<double>, near array<int>")


def _true_links(index: DataFrame, keys: np.ndarray, x: np.ndarray, pivots: np.ndarray, length: int, limit: float) -> np.ndarray:
    """[probes, length + 1]: true links of each probe among all rows, by the number of lists less one in which the pair meets (the last: in none)."""
    dim, wide, block = pivots.shape[1], length + 1, 2048
    near_probes, n_pivots = nearest(x, pivots, length), len(pivots)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, unit = _ranks(near_probes, n_pivots), x / np.linalg.norm(x, axis=1)[:, None]
        n = np.zeros(len(keys) * wide, dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, block):
                batch = whole.slice(at, block)
                y, key, weight = matrix(batch.column("v"), dim), batch.column("key").to_numpy(), batch.column("weight").to_numpy()
                near = batch.column("near").flatten().to_numpy().reshape(len(key), -1)
                i, j = np.nonzero((unit @ (y / np.linalg.norm(y, axis=1)[:, None]).T >= limit) & (keys[:, None] != key[None]))
                for k in range(0, len(i), PAIRS):
                    a, b = i[k:k + PAIRS], j[k:k + PAIRS]
                    np.add.at(n, a * wide + np.maximum(ranks[a[:, None], near[b]], np.arange(length)).min(axis=1), weight[b])
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["at", "n"])

    out = np.zeros(len(keys) * wide, dtype=np.int64)
    for r in index.mapInArrow(task, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # at most CALIBRATE * wide
        out[r["at"]] = r["n"]
    return out.reshape(-1, wide)


def _made_links(x: np.ndarray, pivots: np.ndarray, length: int, limit: float) -> np.ndarray:
    """As ``_true_links``, of a partner for each probe that is made just at the limit."""
    rng = np.random.default_rng(7)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    aside = rng.normal(size=x.shape)
    aside -= (aside * unit).sum(axis=1)[:, None] * unit
    aside /= np.maximum(np.linalg.norm(aside, axis=1), 1e-300)[:, None]
    other = nearest(limit * unit + np.sqrt(max(0.0, 1 - limit**2)) * aside, pivots, length)
    meets = np.maximum(np.take_along_axis(_ranks(nearest(x, pivots, length), len(pivots)), other, axis=1), np.arange(length)).min(axis=1)
    out = np.zeros((len(x), length + 1), dtype=np.int64)
    out[np.arange(len(x)), meets] = 1
    return out


def lists_needed(links: np.ndarray, target: float) -> int | None:
    """The fewest lists with which ``target`` of all links, and on average of the links of a probe in each part of the probes, share one; None if more are needed than were tried."""
    n = links.sum(axis=1)
    links, n = links[n > 0], n[n > 0]
    if not len(n):
        return 1
    found = np.cumsum(links, axis=1)[:, :-1]
    parts = np.array_split(np.argsort(n, kind="stable"), max(1, min(8, len(n) // PART)))
    worst = np.min([found.sum(axis=0) / n.sum(), *((found[p] / n[p][:, None]).mean(axis=0) for p in parts)], axis=0)
    ok = np.flatnonzero(worst >= target)
    return int(ok[0]) + 1 if len(ok) else None


def _compared(rows: DataFrame, dim: int, limit: float) -> DataFrame:
    """(key, n, root) from every pair of blocks of every list: the weight linked to ``key`` there, and a class it is connected to."""

    def task(group: pa.Table) -> pa.Table:
        pivot, i, j = (group.column(c)[0].as_py() for c in ("pivot", "i", "j"))
        key, weight, block = (group.column(c).to_numpy() for c in ("key", "weight", "block"))
        x = matrix(group.column("v"), dim)
        size = np.sqrt((x * x).sum(axis=1))
        unit = x / size[:, None]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        cosine = unit[left] @ unit[right].T
        a, b = np.nonzero(cosine >= limit - 1e-9)
        clear = cosine[a, b] >= limit + 1e-9
        a, b = left[a], right[b]
        if i == j:
            a, b, clear = a[a < b], b[a < b], clear[a < b]
        at = np.flatnonzero(~clear)  # so near the limit that the order of sums decides
        for k in range(0, len(at), PAIRS):
            c, d = a[at[k:k + PAIRS]], b[at[k:k + PAIRS]]
            clear[at[k:k + PAIRS]] = (x[c] * x[d]).sum(axis=1) / (size[c] * size[d]) >= limit
        a, b = a[clear], b[clear]
        if len(a):  # not the pairs that share the list of a smaller pivot
            near = group.column("near").combine_chunks().flatten().to_numpy().reshape(len(key), -1)
            (own_a, of_a), (own_b, of_b) = np.unique(a, return_inverse=True), np.unique(b, return_inverse=True)
            both = np.intersect1d(near[own_a], near[own_b])
            both = both[both < pivot]
            if len(both):
                stands = []
                for own in (own_a, own_b):
                    place = np.minimum(np.searchsorted(both, near[own]), len(both) - 1)
                    row, col = np.nonzero(both[place] == near[own])
                    stands.append(np.zeros((len(own), len(both)), dtype=np.float32))
                    stands[-1][row, place[row, col]] = 1
                first = (stands[0] @ stands[1].T)[of_a, of_b] == 0
                a, b = a[first], b[first]
        n = np.zeros(len(key), dtype=np.int64)
        np.add.at(n, a, weight[b])
        np.add.at(n, b, weight[a])
        root = key.copy()  # smallest key that pairs lead to
        while len(a):
            before = root.copy()
            least = np.minimum(root[a], root[b])
            np.minimum.at(root, a, least)
            np.minimum.at(root, b, least)
            if (before == root).all():
                break
        got = np.flatnonzero(n > 0)
        return pa.table([pa.array(key[got]), pa.array(n[got]), pa.array(root[got])], ["key", "n", "root"])

    return rows.groupBy("pivot", "i", "j").applyInArrow(task, "key long, n long, root long")


def near_duplicates(vectors: DataFrame, limit: float = 0.95, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of each row: how many other rows it is linked to, and the smallest id reachable."""
    spark = vectors.sparkSession
    dim = dimension(vectors, vector)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(usable(vector) & (F.size(vector) == dim), F.col(vector).cast("array<double>")).alias("v"))
    alone = rows.where("v is null").select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    # a class of equal vectors: numbered as it is written, so that the number holds
    classes, _ = saved(spark, rows.where("v is not null").groupBy("v").agg(F.count("*").alias("weight"), F.min("id").alias("least")).withColumn("key", F.monotonically_increasing_id()), "vector-classes")
    wanted = min(PIVOTS, max(32, math.isqrt(classes.count())))
    drawn = classes.orderBy(F.xxhash64("v"), "key").limit(DRAWN).select("key", "v").collect()
    if not drawn:
        return alone.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
    x = np.array([r["v"] for r in drawn], dtype=np.float64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    chosen = spread(unit, wanted, limit)
    pivots = unit[chosen]
    probes = np.setdiff1d(np.arange(len(x)), chosen)[-CALIBRATE:]
    keys, x = np.array([r["key"] for r in drawn], dtype=np.int64)[probes], x[probes]
    length, probes = min(LENGTH, len(pivots)), None
    while probes is None:  # with all pivots described, every pair shares a list
        index, _ = saved(spark, _described(classes, pivots, length), "vector-index")
        links = _true_links(index, keys, x, pivots, length, limit)
        if (links.sum(axis=1) > 0).sum() < PART:
            links = np.concatenate([links, _made_links(x, pivots, length, limit)])
        probes = lists_needed(links, TARGET)
        length = min(4 * length, len(pivots))
    stands = index.withColumn("near", F.slice("near", 1, max(PROBES, probes))).withColumn("pivot", F.explode("near"))
    blocks = stands.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))  # a row for each pivot: at most PIVOTS
    stands = stands.join(F.broadcast(blocks), "pivot").withColumn("block", F.pmod(F.hash("key"), F.col("blocks")).cast("int"))
    meets = stands.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meets = meets.select("pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key", "weight", "v", "near")
    links, _ = saved(spark, _compared(meets, dim, limit), "vector-links")

    found = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    n = links.groupBy("key").agg(F.sum("n").alias("n"))
    whole = classes.join(n, "key", "left").join(found.withColumnRenamed("id", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    whole = whole.join(least, "component").select("v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    answer = rows.where("v is not null").join(whole, "v").select(F.col("id").alias(id_col), "n_links", "component_id").unionAll(alone)
    return answer.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
