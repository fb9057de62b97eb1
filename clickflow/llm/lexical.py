"""Ranked lexical search: the best documents of each item, found best-first over intervals bounded by range-maximum queries.

Documents lie in shards, one row of packed posting lists each; a shard is made from the documents of one task, so nothing is
shuffled but counts and answers:

1. ``_shards``: terms of whole texts; for each shard the lengths of its documents and, for every term that an item asks for, the
   documents that hold it and how often. The items' terms are the only ones that an answer can depend on.
2. ``_statistics``: N, L and the document frequencies over all shards.
3. ``_searched``: per shard each posting gets its impact, and the posting lists one sparse table each of range maxima (where
   the greatest impact of a stretch stands). For an item, the open intervals of documents start as the whole shard; the
   bound of an interval is the sum over the item's terms of its greatest impact there. The intervals with the best bounds are
   split at the document of their greatest single impact, which gets its exact score; an interval goes when its bound
   can't reach the item's k-th score so far, which a task carries on from shard to shard.
4. The best ``k`` per task and item meet, and the best ``k`` of each item are ranked.

Items are handled in blocks of a bounded number of characters; a block's terms are sent to all tasks.

Cases: a null or empty text has no term and is in no answer; null items have no answer; an item whose terms no document holds
has none; repeated rows are documents each, and items with equal ids are items each if their texts differ (rows alike in id and text are
one); equal scores are ordered by id, null ids last, then by the document's length and a hash of its text; very long texts are read
whole; empty tables give an empty result. Only the columns named in the call are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import chunks, forget, saved, texts_of

#: Documents, and postings, of a shard at most (one document more than fits is the least).
SHARD_DOCS, SHARD_POSTINGS = 8192, 1_000_000
#: Characters of the items that are searched in one go, about.
ITEM_CHARS = 4_000_000
#: Intervals that are split at once; not above the first buffers in ``search_shard``.
WIDE = 256

# The characters that end a term, and the constants of the score.
_KEPT = bytes(c for c in range(256) if c >= 0x80 or chr(c).isalnum())
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEPT else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    """ASCII letters and digits and all characters above ASCII make terms; A-Z are lower-cased."""
    return text.encode().translate(_TABLE).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Impacts:
    """The posting lists of one shard, end to end, with their impacts and a sparse table of range maxima."""

    def __init__(self, starts: np.ndarray, docs: np.ndarray, impact: np.ndarray, size: int):
        """``starts``: where each term's list begins, and the end; ``docs``: places in the shard, rising within a list."""
        self.starts, self.docs, self.impact, self.size = starts, docs, np.append(impact, -1), size
        # places of the greatest impact of 1, 2, 4, ... postings from each one on (the first one of equals)
        level = np.arange(len(docs), dtype=np.int32)
        self.best = [level]
        longest, width = int(np.diff(starts).max(initial=0)), 1
        while 2 * width <= longest:
            after = np.minimum(np.arange(len(level)) + width, len(level) - 1)
            left, right = level, level[after]
            level = np.where(self.impact[left] >= self.impact[right], left, right)
            self.best.append(level)
            width *= 2
        self.best = np.stack(self.best)
        # for each term and 64 documents: the postings before, and which documents are in the list
        words = (size >> 6) + 1
        term = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        self.bits = np.zeros((len(starts) - 1, words), dtype=np.uint64)
        np.bitwise_or.at(self.bits, (term, docs >> 6), np.uint64(1) << (docs & 63).astype(np.uint64))
        counts = np.bitwise_count(self.bits).astype(np.int32)
        self.before = np.cumsum(counts, axis=1, dtype=np.int32) - counts + starts[:-1, None].astype(np.int32)

    def place(self, terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of ``docs`` (rows) and ``terms``: the place of the first posting at or after the document; whether it is the document's."""
        word, bit = (docs >> 6)[:, None], (docs & 63).astype(np.uint64)[:, None]
        bits = self.bits[terms[None, :], word]
        at = self.before[terms[None, :], word] + np.bitwise_count(bits & ((np.uint64(1) << bit) - np.uint64(1)))
        return at, (bits >> bit & np.uint64(1)).astype(bool)

    def greatest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The place of the greatest impact in each stretch of postings [lo, hi); the place after all if it is empty."""
        width = hi - lo
        level = np.frexp(np.maximum(width, 1))[1] - 1
        lo_ = np.minimum(lo, len(self.docs) - 1)
        left, right = self.best[level, lo_], self.best[level, np.maximum(hi - (1 << level), 0)]
        return np.where(width > 0, np.where(self.impact[left] >= self.impact[right], left, right), len(self.docs))


@dataclass
class Best:
    """The best documents of an item so far: (score, id key) and what identifies the document."""

    k: int
    rows: list[tuple]

    def add(self, found: list[tuple]) -> None:
        self.rows = sorted(self.rows + found)[:self.k]

    @property
    def least(self) -> int:
        """A document needs this score at least."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1


def search_shard(shard: Impacts, terms: np.ndarray, names: list[tuple], best: Best) -> int:
    """Merge the shard's best documents for the item with ``terms`` into ``best``; gives the number of documents scored.

    ``names``: what orders documents of equal scores, rising by place; ``best.rows`` hold (-score, name).
    """
    lists = len(terms)
    doc_lo, doc_hi, bounds = np.zeros(256, dtype=np.int64), np.zeros(256, dtype=np.int64), np.zeros(256, dtype=np.int64)
    lo, hi = np.zeros((256, lists), dtype=np.int32), np.zeros((256, lists), dtype=np.int32)
    doc_hi[0], lo[0], hi[0] = shard.size, shard.starts[terms], shard.starts[terms + 1]
    bounds[0] = shard.impact[shard.greatest(lo[:1], hi[:1])].clip(0).sum()
    n, scored = 1, 0
    while n:
        least = best.least
        open_ = bounds[:n] >= least
        if len(best.rows) == best.k:  # an equal bound matters only if a document of that score could stand before the last one
            last = best.rows[-1][1]
            for j in np.flatnonzero(bounds[:n] == least):
                open_[j] = names[doc_lo[j]] < last
        left = np.flatnonzero(open_)
        if not len(left):
            break
        picked = left if len(left) <= WIDE else left[np.argpartition(-bounds[left], WIDE)[:WIDE]]
        # split at the document where the greatest single impact of the interval stands
        at = shard.greatest(lo[picked], hi[picked])
        doc = shard.docs[at[np.arange(len(picked)), shard.impact[at].argmax(axis=1)]]
        place, own = shard.place(terms, doc)
        score = np.where(own, shard.impact[place], 0).sum(axis=1)
        scored += len(picked)
        best.add([(-int(score[j]), names[doc[j]]) for j in np.flatnonzero(score >= least)])
        new_lo, new_hi = np.concatenate([doc_lo[picked], doc + 1]), np.concatenate([doc, doc_hi[picked]])
        a, b = np.concatenate([lo[picked], place + own]), np.concatenate([place, hi[picked]])
        bound = shard.impact[shard.greatest(a, b)].clip(0).sum(axis=1)
        worth = np.flatnonzero((new_lo < new_hi) & (bound >= best.least))
        # the new intervals take the places of the split ones, then places at the end
        bounds[picked] = -1
        free = np.concatenate([picked, np.arange(n, n + len(worth))])[:len(worth)]
        n = max(n, int(free.max(initial=-1)) + 1)
        if n > len(bounds):
            doc_lo, doc_hi, bounds, lo, hi = (np.concatenate([x, np.zeros_like(x)]) for x in (doc_lo, doc_hi, bounds, lo, hi))
        doc_lo[free], doc_hi[free], bounds[free], lo[free], hi[free] = new_lo[worth], new_hi[worth], bound[worth], a[worth], b[worth]
    return scored


_SHARD = "ids array<long>, tie array<long>, lengths array<int>, terms array<int>, counts array<int>, docs binary, tfs binary, n_docs long, n_terms long"


def _shards(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``documents`` (id, text) as shards: documents in the order of ids, posting lists of the vocabulary's terms end to end."""
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary)
    names = [c.split()[0] for c in _SHARD.split(", ")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        docs: list[tuple] = []
        held = 0

        def made() -> pa.RecordBatch:
            docs.sort(key=lambda d: (d[0] is None, d[0] or 0, d[2], d[1]))
            sizes = [len(d[3]) for d in docs]
            term = np.concatenate([d[3] for d in docs]).astype(np.int32)
            doc, tf = np.repeat(np.arange(len(docs), dtype=np.uint16), sizes), np.concatenate([d[4] for d in docs])
            order = np.argsort(term, kind="stable")
            own, counts = np.unique(term, return_counts=True)
            # rows of documents without any asked term still count in N and L
            row = [[d[0] for d in docs], [d[1] for d in docs], [d[2] for d in docs], own, counts.astype(np.int32), doc[order].tobytes(), tf[order].astype(np.uint32).tobytes(),
                   len(docs), sum(d[2] for d in docs)]
            kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for part in chunks(batch):
                for i, text in zip(part.column("id").to_pylist(), texts_of(part), strict=True):
                    terms = terms_of(text)
                    if not terms:
                        continue
                    found = Counter(map(known.get, terms))
                    found.pop(None, None)
                    if docs and (len(docs) >= SHARD_DOCS or held + len(found) > SHARD_POSTINGS):
                        yield made()
                        docs, held = [], 0
                    held += len(found)
                    docs.append((i, xxhash.xxh3_64_intdigest(text) >> 1, len(terms), np.fromiter(found, dtype=np.int32, count=len(found)), np.fromiter(found.values(), dtype=np.int64, count=len(found))))
        if docs:
            yield made()

    return documents.mapInArrow(task, _SHARD)


@dataclass
class Statistics:
    n_docs: int
    n_terms: int
    weights: np.ndarray


def _statistics(shards: DataFrame, n_vocabulary: int) -> Statistics:
    """N, L, and the weight of each term (at most as many numbers as the vocabulary has terms)."""
    n, length = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    weights = np.zeros(n_vocabulary, dtype=np.int64)
    pairs = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts"))
    for term, df in pairs.collect():
        weights[term] = term_weight(n, df)
    return Statistics(n, length, weights)


def impacts(row: dict, stats: Statistics) -> Impacts:
    """A shard's posting lists with their impacts, in 64-bit integers."""
    lengths = np.asarray(row["lengths"], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(row["counts"], dtype=np.int64)])
    docs, tf = np.frombuffer(row["docs"], dtype=np.uint16).astype(np.int64), np.frombuffer(row["tfs"], dtype=np.uint32).astype(np.int64)
    m = 10 + 90 * lengths * stats.n_docs // max(1, stats.n_terms)
    weight = np.repeat(stats.weights[np.asarray(row["terms"], dtype=np.int64)], row["counts"])
    return Impacts(starts, docs, weight * (1_000_000_000 * tf // (1000 * tf + 8 * m[docs])), len(lengths))


def _searched(shards: DataFrame, items: list[list[int]], stats: Statistics, k: int) -> DataFrame:
    """(item, score, id, tie...) of the best ``k`` documents of each task for each of ``items`` (numbers of terms)."""
    sent = shards.sparkSession.sparkContext.broadcast(([np.array(t, dtype=np.int64) for t in items], stats))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, figures = sent.value
        best = [Best(k, []) for _ in wanted]
        for batch in batches:
            for j in range(batch.num_rows):  # one shard at a time
                row = {c: batch.column(c)[j].as_py() if c in ("docs", "tfs") else np.asarray(batch.column(c)[j].values) for c in ("terms", "counts", "lengths", "docs", "tfs")}
                ids, ties = batch.column("ids")[j].as_py(), batch.column("tie")[j].as_py()
                if not len(row["terms"]):
                    continue
                shard = impacts(row, figures)
                names = [(i is None, i or 0, int(n), t) for i, n, t in zip(ids, row["lengths"], ties, strict=True)]
                local = np.full(len(figures.weights), -1, dtype=np.int64)
                local[row["terms"]] = np.arange(len(row["terms"]))
                for terms, own in zip(wanted, best, strict=True):
                    there = local[terms]
                    there = there[there >= 0]
                    if len(there):
                        search_shard(shard, there, names, own)
        rows = [(i, -s, None if name[0] else name[1], name[2], name[3]) for i, own in enumerate(best) for s, name in own.rows]
        if rows:
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["item", "score", "id", "length", "tie"])

    return shards.select("ids", "tie", "lengths", "terms", "counts", "docs", "tfs").mapInArrow(task, "item int, score long, id long, length long, tie long")


def search(documents: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of greatest score above 0 for each item, best first."""
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("text is not null").distinct()
    blocks = max(1, -(-int(asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]) // ITEM_CHARS))
    answers = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        terms = [sorted(set(terms_of(r["text"]))) for r in own]
        vocabulary = {t: j for j, t in enumerate(sorted({t for x in terms for t in x}))}
        shards, path = saved(spark, _shards(docs, vocabulary), "lexical-shards")
        found = _searched(shards, [[vocabulary[t] for t in x] for x in terms], _statistics(shards, len(vocabulary)), k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "length", "tie")
        names = spark.createDataFrame([(j, r["item_id"]) for j, r in enumerate(own)], f"item int, item_id {dict(asked.dtypes)['item_id']}")
        part = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(names, "item").select(
            "item_id", "rank", F.col("id").alias(id_col), "score")
        part, _ = saved(spark, part, "lexical-answers")
        forget(spark, path)
        answers = part if answers is None else answers.unionAll(part)
    return answers


SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM n),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
i AS (SELECT f.doc_id, f.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))) AS impact FROM f JOIN w ON f.term = w.term JOIN n ON f.doc_id = n.doc_id, s),
r AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM q JOIN i ON q.term = i.term GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) WHERE rank <= 10
"""
