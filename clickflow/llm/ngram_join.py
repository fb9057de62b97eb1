"""N-gram Jaccard join: groups of documents whose sets of word n-grams overlap, as a blocked sparse matrix product.

The incidence of documents by n-grams is a sparse matrix A; the overlaps are A * A^T. Only the part of it that can
hold a linked pair is made, and rows that are equal are one row (a class of documents with the same set):

1. ``_scan``: n-grams of whole texts as 64-bit hashes; for each document the size and the key of its set, for the
   corpus a table of fixed size with the (hashed) document frequency of n-grams.
2. ``_columns``: with n-grams ordered from rare to frequent, a pair that links shares one of the first
   n - ceil(t * n) + 1 of either set, so only these entries are shuffled, by n-gram (the columns of A).
3. Every class is paired with one hub (``_stars``), and these pairs are verified on the whole texts. Their components
   are the first answer, from work linear in the entries.
4. ``_crossing``: columns whose classes are still in different components, in blocks, a task for every pair of blocks. Pairs of
   sizes that can link are compared by their sets' parities before anything is emitted: every n-gram flips one bit, so
   the bits that differ are never more than the n-grams that only one of the two sets has. What passes is emitted for each shared
   n-gram that leaves enough n-grams after it.
5. ``_within_bounds``: the overlap counts are accumulated over the columns; a pair whose count, with all that the later n-grams can
   add, stays below the bound of its sizes is discarded, the others are verified. No link between different components is left out.

A hub's pairs are verified in blocks of ``BLOCK``. Classes are told apart by 64-bit keys, n-grams by 64-bit hashes.

Cases: null and empty texts (and texts without words) have no n-gram and link with nothing; texts with fewer words
than n have the whole sequence as the one n-gram; very long texts are read whole; equal texts are one class; a
repeated row is a document each, with one answer per row; rows with a null id link like others and get the smallest id that
they reach, or null; empty tables give an empty result. Only the columns named in the call are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import chunks, forget, saved, texts_of, tidy
from clickflow.llm.components import components

#: Slots of the frequency table (fixed: 2 MB as classes of frequency), and the parts in which it is summed.
SLOT_BITS, PARTS = 21, 64
#: Pairs of a hub that are verified in one go.
BLOCK = 256
#: Ids that may be broadcast (8 bytes each); with more of them the texts are shuffled.
BROADCAST_IDS = 1_000_000
#: Classes that a task remembers having sent, at most.
REMEMBER = 200_000
#: Entries of a column that meet in one block, about; the least bits of a parity, and the most that go with an entry.
COLUMN_BLOCK, LEAST_BITS, ENTRY_BITS = 4096, 512, 1024

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


class Shingler:
    """Sets of word n-grams of whole texts; ``lower``: A-Z are lower-cased. Words are runs without space, \\x09-\\x0D."""

    def __init__(self, n: int, lower: bool = True, most: int = 100_000):
        if not 1 <= n <= len(_ODD):
            raise ValueError(f"n must be 1 to {len(_ODD)}")
        self.n, self.lower, self.most = n, lower, most
        self.known: dict[bytes, int] = {}

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """For each text its distinct n-grams as sorted uint64 hashes."""
        known = self.known
        if len(known) > self.most:
            known.clear()
        split = [(t.encode().lower() if self.lower else t.encode()).split() for t in texts]
        for w in {w for x in split for w in x}.difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        flat = np.fromiter((known[w] for x in split for w in x), dtype=np.uint64)
        out, at, n = [], 0, self.n
        if len(flat) >= n:
            grams = flat[:len(flat) - n + 1] * _ODD[0]
            for k in range(1, n):
                grams += flat[k:len(flat) - n + 1 + k] * _ODD[k]
            grams = self._mixed(grams)
        for x in split:
            size = len(x)
            if size >= n:
                out.append(np.unique(grams[at:at + size - n + 1]))
            elif size:  # the number of words is part of the hash
                out.append(self._mixed(np.sum(flat[at:at + size] * _ODD[:size], keepdims=True) + _ODD[size]))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            at += size
        return out

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        h = h ^ (h >> np.uint64(31))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def _key(s: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes()))))


def parity(s: np.ndarray) -> bytes:
    """One bit for each of 512, 1024, ... places (about 1.5 times the set's size): whether an odd number of n-grams falls there."""
    bits = max(LEAST_BITS, 1 << (3 * len(s) // 2).bit_length())
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(x: np.ndarray) -> np.ndarray:
    """Parities (rows of uint64) for half as many places."""
    half = x.shape[1] // 2
    return x[:, :half] ^ x[:, half:]


def short(bits: bytes) -> bytes:
    """A parity folded to ``ENTRY_BITS`` at most."""
    x = np.frombuffer(bits, dtype=np.uint64)[None, :]
    while 64 * x.shape[1] > ENTRY_BITS:
        x = folded(x)
    return x.tobytes()


def most_apart(a: np.ndarray, b: np.ndarray | int, percent: int) -> np.ndarray:
    """n-grams that only one of two sets of sizes ``a`` and ``b`` may have if they link: sizes less twice the least overlap."""
    return a + b - 2 * (-(-percent * (a + b) // (100 + percent)))


def _scan(documents: DataFrame, n: int) -> DataFrame:
    """(id, hash, key, size, bits) of each document, ``hash`` of its text; (part, counts) of the task's frequency table."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, table = Shingler(n), np.zeros(1 << SLOT_BITS, dtype=np.uint32)
        names, any_row = ["id", "hash", "key", "size", "bits", "part", "counts"], False
        for batch in batches:
            for part in chunks(batch):
                sets = shingler.sets(texts_of(part))
                any_row = True
                table += np.bincount((np.concatenate(sets) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(table)).astype(np.uint32)
                k = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("hash"), pa.array([_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                                                  pa.array([parity(s) for s in sets], pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
        if any_row:
            counts = [zlib.compress(x.tobytes(), 1) for x in np.split(table, PARTS)]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(PARTS, pa.int64()) for _ in range(4)), pa.nulls(PARTS, pa.binary()), pa.array(np.arange(PARTS, dtype=np.int32)), pa.array(counts, pa.binary())], names)

    return documents.withColumn("hash", F.xxhash64("text")).mapInArrow(tidy(task), "id long, hash long, key long, size long, bits binary, part int, counts binary")


def _frequency_classes(parts: DataFrame) -> np.ndarray:
    """For each slot the (rounded) logarithm of its count: 2 MB, whatever the corpus."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # at most PARTS entries
        for batch in batches:
            for p, c in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                x = np.frombuffer(zlib.decompress(c), dtype=np.uint32)
                sums[p] = sums[p] + x if p in sums else x.astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.minimum(255, 8 * np.log2(1 + x)).astype(np.uint8).tobytes() for x in sums.values()], pa.binary())], ["part", "classes"])

    rows = parts.repartition(PARTS, "part").mapInArrow(tidy(total), "part int, classes binary").collect()
    out = np.zeros((PARTS, (1 << SLOT_BITS) // PARTS), dtype=np.uint8)
    for r in rows:
        out[r["part"]] = np.frombuffer(r["classes"], dtype=np.uint8)
    return out.ravel()


def _ordered(s: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams from rare to frequent, and their classes; the order is the same in every set."""
    own = classes[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
    order = np.argsort(own, kind="stable")  # equal classes stay in the order of hashes
    return s[order], own[order]


def _columns(documents: DataFrame, n: int, percent: int, classes: np.ndarray) -> DataFrame:
    """(gram, key, size, pos, rank) of the entries that may show a link; ``rank``: mean class of the key's entries."""
    shared = documents.sparkSession.sparkContext.broadcast(classes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sent = Shingler(n), set()
        for batch in batches:
            for part in chunks(batch):
                out = []
                for s in shingler.sets(texts_of(part)):
                    key = _key(s)
                    if not len(s) or key in sent:
                        continue
                    if len(sent) >= REMEMBER:
                        sent.clear()
                    sent.add(key)
                    grams, own = _ordered(s, shared.value)
                    most = len(s) - (percent * len(s) + 99) // 100 + 1
                    out.append((key, len(s), grams[:most], int(16 * own[:most].mean())))
                if out:
                    counts = [len(x) for _, _, x, _ in out]
                    key, size, rank = (np.repeat([x[j] for x in out], counts) for j in (0, 1, 3))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([x for _, _, x, _ in out]).view(np.int64)), pa.array(key), pa.array(size.astype(np.int32)),
                        pa.array(np.concatenate([np.arange(c) for c in counts]).astype(np.int32)), pa.array(rank.astype(np.int32))], ["gram", "key", "size", "pos", "rank"])

    return documents.select("text").mapInArrow(tidy(task), "gram long, key long, size int, pos int, rank int")


def _shared(columns: DataFrame, percent: int) -> DataFrame:
    """The entries of columns that two classes or more stand in, each once, with a hub: the first class of the column (by bands of size).

    In a group of near-copies the text that the others were made from has the fewest n-grams of its own, so the
    classes of a column are ordered by falling rank.
    """
    band = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    names = ["gram", "key", "size", "pos", "rank", "band"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, told, hub = None, True, None  # the entry before, whether it has been passed on, and its hub
        for batch in batches:
            if not batch.num_rows:
                continue
            gram = batch.column("gram").to_numpy()
            same = np.zeros(len(gram), dtype=bool)
            same[1:] = gram[1:] == gram[:-1]
            same[0] = last is not None and last[0] == gram[0]
            multi = same.copy()
            multi[:-1] |= same[1:]
            multi[-1] = True  # the next batch may go on with it
            out = []
            rows = batch.filter(pa.array(multi))
            for entry in zip(*(rows.column(c).to_pylist() for c in names), strict=True):
                if last is not None and last[0] == entry[0]:
                    if last[1] == entry[1]:
                        continue
                    if not told:
                        out.append((*last[:4], hub[4], hub[1], hub[2]))
                    hub = hub if hub[5] == entry[5] else entry
                    out.append((*entry[:4], hub[4], hub[1], hub[2]))
                    last, told = entry, True
                else:
                    last, told, hub = entry, False, entry
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i in (0, 1, 5) else pa.int32()) for i, c in enumerate(zip(*out, strict=True))],
                                                 ["gram", "key", "size", "pos", "hub_rank", "hub", "hub_size"])

    rows = columns.withColumn("band", band).repartition("gram").sortWithinPartitions("gram", "band", F.desc("rank"), "key")
    return rows.select(*names).mapInArrow(tidy(task), "gram long, key long, size int, pos int, hub_rank int, hub long, hub_size int")


def _stars(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class ``b`` with the best hub ``a`` of its columns, both of sizes that can link. One pair for each class, whatever the size of its group."""
    best = lists.groupBy("key", "size").agg(F.max(F.struct("hub_rank", "hub", "hub_size")).alias("best"))
    return best.where("key <> best.hub").where(percent * F.greatest("size", "best.hub_size") <= 100 * F.least("size", "best.hub_size")).select(
        F.col("best.hub").alias("a"), F.col("key").alias("b"))


def _open_columns(lists: DataFrame, part: DataFrame, classes: DataFrame) -> DataFrame:
    """(gram, key, size, pos, component, bits) of the columns whose classes are in different components; ``part`` (key, component) holds linked classes.

    An entry carries its class's parity folded to a fixed width; what it lets pass meets the whole parity once (``_near``).
    """
    told = lists.select("gram", "key", "size", "pos").join(within(part), "key", "left").withColumn("component", F.coalesce("component", "key"))
    differ = told.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("gram")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([short(x) for x in batch.column("bits").to_pylist()], pa.binary())], ["key", "bits"])

    return told.join(differ, "gram", "left_semi").join(classes.select("key", "bits").mapInArrow(tidy(task), "key long, bits binary"), "key")


def _pairs(run: dict[str, np.ndarray], percent: int) -> Iterator[tuple]:
    """Columns (a, b, a_size, b_size, a_pos, b_pos) of the pairs of a block, or of two, that may link. ``run`` is in the order of sizes."""
    key, size, pos, comp, own, bits = (run[c] for c in ("key", "size", "pos", "component", "own", "bits"))
    across = bool((own != own[0]).any())
    width = np.array([len(x) for x in bits])
    last = np.searchsorted(size, 100 * size // percent, side="right")
    rows: dict[int, np.ndarray] = {w: np.frombuffer(b"".join(bits[width == w]), dtype=np.uint64).reshape(-1, w // 8) for w in np.unique(width).tolist()}
    first = {w: int(np.argmax(width == w)) for w in rows}  # sizes rise, so parities of one width stand together
    narrow: dict[tuple[int, int], np.ndarray] = {}

    def at_width(wide: int, w: int) -> np.ndarray:
        if (wide, w) not in narrow:
            x = rows[wide]
            while 8 * x.shape[1] > w:
                x = folded(x)
            narrow[wide, w] = x
        return narrow[wide, w]

    for i in range(len(key) - 1):
        at = np.arange(i + 1, last[i])
        ok = comp[at] != comp[i]
        if across:
            ok &= own[at] != own[i]
        at = at[ok]
        if not len(at):
            continue
        most = most_apart(size[at], int(size[i]), percent)
        need = (size[at] + size[i] - most) // 2
        at, most = (x[need <= np.minimum(size[i] - pos[i], size[at] - pos[at])] for x in (at, most))
        w = int(width[i])
        mine = rows[w][i - first[w]]
        apart = np.empty(len(at), dtype=np.int64)
        for wide in np.unique(width[at]).tolist():
            where = width[at] == wide
            apart[where] = np.bitwise_count(at_width(wide, w)[at[where] - first[wide]] ^ mine).sum(axis=1)
        at = at[apart <= most]
        if len(at):
            yield np.full(len(at), key[i]), key[at], np.full(len(at), size[i]), size[at], np.full(len(at), pos[i]), pos[at]


def _crossing(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of a column's entries in different components that may link by sizes, places and parities, the smaller first."""
    fields = ["gram", "lo", "hi", "own", "key", "size", "pos", "component", "bits"]
    names = ["a", "b", "a_size", "b_size", "a_pos", "b_pos"]

    def made(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64 if j < 2 else np.int32)) for j, c in enumerate(zip(*found, strict=True))], names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []
        found, held = [], 0

        def meet() -> list[tuple]:
            if len(run) < 2 or all(r[7] == run[0][7] for r in run):
                return []
            cols = list(zip(*run, strict=True))
            arrays = {c: np.array(cols[j], dtype=object if c == "bits" else np.int64) for j, c in enumerate(fields) if j > 2}
            return list(_pairs(arrays, percent))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in fields), strict=True):
                if run and run[-1][:3] != row[:3]:
                    more = meet()
                    found += more
                    held += sum(len(x[0]) for x in more)
                    if held > 200_000:
                        yield made(found)
                        found, held = [], 0
                    run = []
                run.append(row)
        found += meet()
        if found:
            yield made(found)

    # a long column is dealt into blocks by the hash of its classes, and every pair of blocks meets
    long = entries.groupBy("gram").agg(F.count("*").alias("c")).where(F.col("c") > COLUMN_BLOCK).select("gram", F.ceil(F.col("c") / COLUMN_BLOCK).cast("int").alias("blocks"))
    rows = entries.join(long, "gram", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).select(*fields)
    return rows.repartition("gram", "lo", "hi").sortWithinPartitions("gram", "lo", "hi", "size", "key").mapInArrow(
        tidy(task), "a long, b long, a_size int, b_size int, a_pos int, b_pos int")


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose parities leave a link possible."""
    one = lambda side: classes.select(F.col("key").alias(side), F.col("n").alias(f"{side}_n"), F.col("bits").alias(f"{side}_bits"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("a_n", "b_n", "a_bits", "b_bits")), strict=True):
                x, y = (np.frombuffer(b, dtype=np.uint64)[None, :] for b in (x, y))
                while x.shape[1] != y.shape[1]:
                    x, y = (folded(x), y) if x.shape[1] > y.shape[1] else (x, folded(y))
                keep.append(int(np.bitwise_count(x ^ y).sum()) <= int(most_apart(np.int64(n), m, percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "a_n", "b_n", "a_bits", "b_bits").mapInArrow(tidy(task), "a long, b long")


def _within_bounds(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) whose overlap so far, and what may follow the last shared n-gram, reach the bound of their sizes."""
    need = F.ceil(percent * (F.col("a_size") + F.col("b_size")) / F.lit(100.0 + percent) - 1e-9)
    rest = F.least(F.col("a_size") - F.col("a_last"), F.col("b_size") - F.col("b_last")) - 1
    return pairs.groupBy("a", "b", "a_size", "b_size").agg(F.count("*").alias("n"), F.max("a_pos").alias("a_last"), F.max("b_pos").alias("b_last")).where(
        F.col("n") + rest >= need).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by the whole sets. ``a`` is the hub; its pairs are split into blocks, each with the hub's text."""
    blocks = pairs.groupBy("a").agg(F.count("*").alias("c")).select("a", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))
    hubs = blocks.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("a").alias("key"))
    others = pairs.join(blocks, "a").select("a", F.pmod(F.hash("b"), F.col("blocks")).cast("int").alias("block"), F.col("b").alias("key"))
    rows = hubs.withColumn("other", F.lit(False)).unionAll(others.withColumn("other", F.lit(True))).join(texts, "key")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, at, own = Shingler(n), None, None
        for batch in batches:
            for part in chunks(batch):
                out = []
                for a, block, key, other, s in zip(*(part.column(c).to_pylist() for c in ("a", "block", "key", "other")), shingler.sets(texts_of(part)), strict=True):
                    if _key(s) != key:  # another text under the same id
                        continue
                    if not other:
                        at, own = (a, block), s
                    elif at == (a, block):
                        both = len(np.intersect1d(own, s, assume_unique=True))
                        if 100 * both >= percent * (len(own) + len(s) - both):
                            out.append((a, key))
                yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.int64()) for j in (0, 1)], ["a", "b"])

    return rows.repartition("a", "block").sortWithinPartitions("a", "block", "other").mapInArrow(tidy(task), "a long, b long")


def within(ids: DataFrame) -> DataFrame:
    """``ids`` with a broadcast hint if they are few (counted)."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _texts(documents: DataFrame, scan: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """(key, text) for each of ``keys``, from one of its rows: that of the smallest id, a null id last. A text may come once per task."""
    row = F.struct(F.col("id").isNull().alias("nameless"), "id", "hash")
    wanted = scan.join(keys, "key", "left_semi").groupBy("key").agg(F.min(row).alias("row")).select("key", F.col("row.id").alias("own"), "row.hash")
    wanted, _ = saved(documents.sparkSession, wanted, "ngram-wanted")
    rows = documents.withColumn("hash", F.xxhash64("text")).join(within(wanted), "hash").where(F.col("id").eqNullSafe(F.col("own"))).select("key", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            keep = []
            for k in batch.column("key").to_pylist():
                if len(sent) >= REMEMBER:
                    sent.clear()
                keep.append(k not in sent)
                sent.add(k)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(tidy(task), "key long, text string")


def first_of_groups(documents: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row, with all its columns, of each group of rows that link (directly or not) or repeat each other's n-grams: that of the smallest id, a null id last.

    Rows are numbered once, in a written table, and linked, kept and dropped by that number, so repeated and null ids do no
    harm. Rows without words link with nothing; of those that are alike in id and text one stays.
    """
    spark = documents.sparkSession
    rows, path = saved(spark, documents.withColumn("__row", F.monotonically_increasing_id()), "ngram-rows")
    named = rows.select("__row", F.col(id_col).alias("__id"), F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull()).alias("__hash"))
    found = join(rows, n, percent, "__row", text)
    found = found.withColumn("group", F.when(F.col("n_shingles") > 0, F.col("component_id"))).drop("component_id").join(named, "__row")
    # rows without words: the same id and text
    found = found.select("__row", "__id", "group", *(F.when(F.col("group").isNull(), F.col(c)).alias(f"{c}_") for c in ("__id", "__hash")))
    found, _ = saved(spark, found, "ngram-found")
    by = ["group", "__id_", "__hash_"]
    kept = found.groupBy(*by).agg(F.count("*").alias("c"), F.min(F.struct(F.col("__id").isNull().alias("nameless"), "__id", "__row")).alias("first")).where("c > 1")
    firsts = kept.select("first.__row")
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"k{c}")) for c in by))
    grouped = found.join(kept.select(*(F.col(c).alias(f"k{c}") for c in by)), same, "left_semi")
    gone, _ = saved(spark, grouped.select("__row").join(firsts, "__row", "left_anti"), "ngram-gone")
    return rows.join(within(gone), "__row", "left_anti").select(*documents.columns)


def join(documents: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of each row: documents link if 100 * overlap >= ``percent`` * union of their n-gram sets.

    ``component_id`` is the smallest id reachable by links, the own included.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    scan, _ = saved(spark, _scan(docs, n), "ngram-scan")
    rows = scan.where("part is null").select("id", "key", "size")
    frequency = _frequency_classes(scan.where("part is not null").select("part", "counts"))
    lists, lists_path = saved(spark, _shared(_columns(docs, n, percent, frequency), percent), "ngram-lists")
    classes = scan.where("part is null and size > 0").join(lists.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.min("size").alias("n"), F.min("bits").alias("bits"))
    classes, classes_path = saved(spark, classes, "ngram-classes")

    # the counts of hub pairs are not accumulated yet, so their bound is that of the parities; what passes is verified
    stars, stars_path = saved(spark, _near(_stars(lists, percent), classes, percent), "ngram-stars")
    texts, texts_path = saved(spark, _texts(docs, scan.where("part is null"), _ends(stars), n), "ngram-texts")
    links, _ = saved(spark, _verified(stars, texts, n, percent), "ngram-links")
    forget(spark, texts_path)
    part = components(links)

    entries, entries_path = saved(spark, _open_columns(lists, part.withColumnRenamed("id", "key"), classes), "ngram-open")
    forget(spark, lists_path)
    left = _within_bounds(_crossing(entries, percent), percent).join(stars.unionAll(stars.select("b", "a")), ["a", "b"], "left_anti")
    pairs, pairs_path = saved(spark, _near(left, classes, percent), "ngram-pairs")
    for p in (entries_path, stars_path, classes_path):
        forget(spark, p)
    whole = part
    if pairs.limit(1).count():
        texts, texts_path = saved(spark, _texts(docs, scan.where("part is null"), _ends(pairs), n), "ngram-texts")
        more, _ = saved(spark, _verified(pairs, texts, n, percent), "ngram-links")
        forget(spark, texts_path)
        if more.limit(1).count():
            whole = components(links.unionAll(more))
    forget(spark, pairs_path)

    keys = rows.where("size > 0").groupBy("key").agg(F.min("id").alias("least")).join(whole.withColumnRenamed("id", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = keys.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = keys.join(least, "component").select("key", "component_id")
    return rows.where("size > 0").join(answer, "key").select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id").unionAll(
        rows.where("size = 0").select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.col("id").alias("component_id")))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key"))).distinct()
