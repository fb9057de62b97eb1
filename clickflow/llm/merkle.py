"""Merkle dataset manifest: a persistent hash tree over all rows, with a proof for each row and versions for altered rows.

Each row is a leaf, the SHA-256 of its fields. The leaves of a language stand in the order of their ids; every ``FAN``
consecutive nodes have a parent, the SHA-256 of their digests, until one node, the language's subroot, remains. The
subroots in the order of languages have a root in the same way. Digests are lowercase hex text.

1. ``leaves``: digests of the rows as they are and of the rows to be tested (``altered``), by SQL functions; texts go no farther.
2. ``ranked``: the place of each leaf in its tree, from one range partitioning and counts per partition.
3. ``_raised``: aligned blocks of ``BLOCK`` leaves (``LEVELS`` levels) become one node each, round after round, so that no
   task holds more than a block, whatever the size of a tree. Only a node's path within its block is kept.
4. ``_block_versions``: each block is a persistent tree (``Nodes``). An altered leaf makes a version that shares every untouched
   node and copies only the leaf's ancestors; the version's top goes on through the paths of the blocks above to the root.

Cases: a null field counts as ``-``; a null language is a tree of its own, the first one; null ids come first and rows without an id are
not altered; rows with equal ids are leaves each, in the order of their digests (equal digests may change places without any effect); empty and
very long texts are leaves like others; a tree of one leaf is its own subroot and a table of one language its own root, and a proof without
siblings is the hash of nothing; an empty table gives an empty result. Only the named columns are read, under names of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import forget, saved

FAN, LEVELS = 8, 3
BLOCK = FAN**LEVELS
#: Blocks' rows that a task hands back at once.
ROWS_OUT = 4 * BLOCK

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"


def _field(value: Column) -> Column:
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def lower_every_third(documents: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """The tampering of the test: A-Z of the text become lower case where 3 divides the crc32 of the id as text."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0, F.translate(F.col(text), _UPPER, _LOWER)


def leaves(documents: DataFrame, altered: tuple[Column, Column], id_col: str = "doc_id", source: str = "source", lang: str = "lang",
           length: str = "n_chars", text: str = "text") -> DataFrame:
    """(tree, id, leaf, other, at): the leaf's digest and, where ``altered`` says so, that of the altered text (otherwise null)."""
    where, changed = altered
    fields = [_field(F.col(c)) for c in (id_col, source, lang, length)]
    tree = F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit(""))  # a null language comes first
    return documents.select(
        tree.alias("tree"), F.col(id_col).cast("long").alias("id"), F.sha2(F.concat(*fields, _field(F.col(text))).cast("binary"), 256).alias("leaf"),
        F.when(where, F.sha2(F.concat(*fields, _field(changed)).cast("binary"), 256)).alias("other"), F.monotonically_increasing_id().alias("at"))


def ranked(rows: DataFrame, order: list[str], name: str) -> tuple[DataFrame, str]:
    """``rows`` (a written table) with ``idx``, the place in their ``tree`` by ``order``, from 0, and ``n``, the tree's size; written.

    One range partitioning by tree and order, so a large tree is spread over many partitions; places come from
    a table of counts with a row for each partition and tree.
    """
    spark = rows.sparkSession
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("__at", F.monotonically_increasing_id())
    dealt, path = saved(spark, dealt.withColumn("__part", F.shiftright("__at", 33)), f"{name}-sorted")
    sizes = dealt.groupBy("tree", "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__c"))
    before = "sum(__c) over (partition by tree order by __part rows between unbounded preceding and current row) - __c - __first as __shift"
    sizes = sizes.selectExpr("tree", "__part", before, "sum(__c) over (partition by tree) as n")
    out, out_path = saved(spark, dealt.join(sizes, ["tree", "__part"]).withColumn("idx", F.col("__at") + F.col("__shift")).drop("__at", "__part", "__shift"), name)
    forget(spark, path)
    return out, out_path


class Nodes:
    """A persistent tree: nodes are never changed, a version is the number of its top node."""

    def __init__(self, digests: list[str], levels: int | None):
        """Over ``digests``, ``levels`` high, or as high as one node needs."""
        self.digests, self.children = list(digests), [()] * len(digests)
        level = list(range(len(digests)))
        self.height = 0
        while self.height < levels if levels is not None else len(level) > 1:
            level = [self._made(tuple(level[k:k + FAN])) for k in range(0, len(level), FAN)]
            self.height += 1
        self.top = level[0]

    def _made(self, children: tuple[int, ...]) -> int:
        self.digests.append(digest([self.digests[c] for c in children]))
        self.children.append(children)
        return len(self.digests) - 1

    def way(self, at: int) -> list[tuple[int, int]]:
        """(node, which of its children) from the top down to leaf ``at``."""
        out, node = [], self.top
        for height in range(self.height - 1, -1, -1):
            which = at // FAN**height % FAN
            out.append((node, which))
            node = self.children[node][which]
        return out

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """Of leaf ``at`` and its ancestors, from below: the digests to the left and to the right in the run, each joined."""
        out = []
        for node, which in reversed(self.way(at)):
            run = [self.digests[c] for c in self.children[node]]
            out.append(("".join(run[:which]), "".join(run[which + 1:])))
        return out

    def version(self, at: int, leaf: str) -> int:
        """The top of a version with another leaf: a new leaf and copies of its ancestors, all else is shared."""
        self.digests.append(leaf)
        self.children.append(())
        node = len(self.digests) - 1
        for old, which in reversed(self.way(at)):
            run = self.children[old]
            node = self._made((*run[:which], node, *run[which + 1:]))
        return node

    def forget(self, size: int) -> None:
        """Drop the nodes that were made after the tree had ``size`` of them."""
        del self.digests[size:], self.children[size:]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each (tree, block), which come one after the other."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[0]["tree"], held[0]["block"]) != (row["tree"], row["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _of_rows(rows: list[dict], n: int) -> Nodes:
    return Nodes([r["digest"] for r in rows], LEVELS if n > BLOCK else None)


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _raised(nodes: DataFrame, paths: bool) -> DataFrame:
    """For ``nodes`` (tree, idx, n, digest): the tops of their blocks (path null) and, if ``paths``, each node's path within its block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        schema = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.string()), ("path", kind)])
        out: list[dict] = []
        for rows in _blocks(batches):
            tree, n = rows[0]["tree"], rows[0]["n"]
            built = _of_rows(rows, n)
            out.append({"tree": tree, "idx": rows[0]["block"], "n": -(-n // BLOCK), "digest": built.digests[built.top], "path": None})
            if paths:
                out += [{"tree": tree, "idx": r["idx"], "path": [{"left": a, "right": b} for a, b in built.siblings(k)]} for k, r in enumerate(rows)]
            if len(out) >= ROWS_OUT:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    rows = _by_block(nodes.withColumn("block", F.floor(F.col("idx") / BLOCK))).select("tree", "block", "idx", "n", "digest")
    return rows.mapInArrow(task, f"tree string, idx long, n long, digest string, path {_PATH}")


def _subroots(tops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From the blocks' tops (tree, idx, n, digest): (tree, digest) of the subroots, and (tree, idx, path) of every block up to its subroot."""
    spark = tops.sparkSession
    way = tops.select("tree", "idx", F.col("idx").alias("up"), F.array().cast(_PATH).alias("path"))
    while tops.where("n > 1").limit(1).count():
        both, _ = saved(spark, _raised(tops, paths=True), "merkle-raised")
        steps = both.where("path is not null").select("tree", F.col("idx").alias("up"), F.col("path").alias("step"))
        way = way.join(steps, ["tree", "up"]).select("tree", "idx", F.floor(F.col("up") / BLOCK).alias("up"), F.concat("path", "step").alias("path"))
        way, _ = saved(spark, way, "merkle-way")
        tops = both.where("path is null").drop("path")
    return tops.select("tree", "digest"), way.drop("up")


def _block_versions(rows: DataFrame, above: DataFrame) -> DataFrame:
    """The answer for every leaf of ``rows`` (tree, idx, n, id, digest, other), with ``above`` (tree, idx of a block, path, subroot, root)."""
    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64(), *[pa.string()] * 5, pa.bool_()], strict=True)], names)

        for head, *held in _blocks(batches):  # the block's row of ``above`` comes first
            built = _of_rows(held, held[0]["n"])
            size, up = len(built.digests), [(s["left"], s["right"]) for s in head["path"]]
            shared = [a + b for a, b in up]
            for k, r in enumerate(held):
                proof = digest([*(a + b for a, b in built.siblings(k)), *shared])
                top = built.digests[built.top if r["other"] is None else built.version(k, r["other"])]
                built.forget(size)
                for a, b in up:
                    top = digest([a, top, b])
                out.append((r["id"], r["digest"], head["subroot"], head["root"], proof, top, top == head["root"]))
            if len(out) >= ROWS_OUT:
                yield made()
                out = []
        if out:
            yield made()

    none = F.lit(None)
    low = rows.select("tree", F.floor(F.col("idx") / BLOCK).alias("block"), "idx", "n", "id", "digest", "other", none.cast(_PATH).alias("path"),
                      none.cast("string").alias("subroot"), none.cast("string").alias("root"))
    high = above.select("tree", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("idx"), none.cast("long").alias("n"), none.cast("long").alias("id"),
                        none.cast("string").alias("digest"), none.cast("string").alias("other"), "path", "subroot", "root")
    return _by_block(low.unionAll(high)).mapInArrow(
        task, "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def manifest(documents: DataFrame, altered: tuple[Column, Column], id_col: str = "doc_id", source: str = "source", lang: str = "lang", length: str = "n_chars",
             text: str = "text") -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``altered``: which rows are tested with another text, and that text. ``folded_root`` is the root of the version that holds
    the row's altered leaf (or the leaf itself); ``verified``: it equals the root.
    """
    spark = documents.sparkSession
    made, made_path = saved(spark, leaves(documents, altered, id_col, source, lang, length, text), "merkle-leaves")
    rows, _ = ranked(made, ["id", "leaf", "at"], "merkle-ranked")
    forget(spark, made_path)
    rows = rows.select("tree", "idx", "n", "id", F.col("leaf").alias("digest"), "other")

    tops, _ = saved(spark, _raised(rows.select("tree", "idx", "n", "digest"), paths=False), "merkle-tops")
    subroots, way = _subroots(tops.drop("path"))
    subroots, _ = saved(spark, subroots, "merkle-subroots")

    # the languages are the leaves of one more tree
    forest, _ = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest"), ["own"], "merkle-forest")
    both, _ = saved(spark, _raised(forest.select("tree", "idx", "n", "digest"), paths=True), "merkle-forest-raised")
    step = both.where("path is not null").select("idx", F.col("path").alias("step"))
    root, rest = _subroots(both.where("path is null").drop("path"))
    last = forest.join(step, "idx").join(rest.select(F.col("idx").alias("block"), F.col("path").alias("rest")), F.floor(F.col("idx") / BLOCK) == F.col("block"))
    last = last.join(root.select("tree", F.col("digest").alias("root")), "tree").select(
        F.col("own").alias("tree"), F.col("digest").alias("subroot"), "root", F.concat("step", "rest").alias("last"))
    above = way.join(last, "tree").select("tree", "idx", F.concat("path", "last").alias("path"), "subroot", "root")
    answer = _block_versions(rows, above)
    return answer.withColumnRenamed("id", id_col)


def _sql() -> str:
    """The same in DuckDB, level by level; crc32 is computed bit by bit."""
    said = "CASE WHEN {0} IS NULL THEN '-' ELSE CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR) END"
    fields = " || ".join(said.format(c) for c in ("documents.doc_id", "source", "lang", "n_chars"))
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    bits = "c"
    for _ in range(8):
        bits = f"(CASE WHEN ({bits}) & 1 = 1 THEN xor(({bits}) >> 1, 3988292384) ELSE ({bits}) >> 1 END)" if bits == "c" else f"(list_transform([{bits}], lambda c: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)[1])"
    return f"""
WITH RECURSIVE table_ AS (SELECT list(v ORDER BY b) AS t FROM (SELECT c AS b, {bits} AS v FROM (SELECT CAST(unnest(range(0, 256)) AS BIGINT) AS c))),
ids AS (SELECT doc_id, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda x: CAST(ascii(x) AS BIGINT))),
          lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])) AS crc FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), table_),
leaf AS (SELECT coalesce('=' || lang, '') AS tree, documents.doc_id, sha256({fields} || {said.format('text')}) AS leaf,
          CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256({fields} || {said.format(lower)}) ELSE sha256({fields} || {said.format('text')}) END AS other
         FROM documents LEFT JOIN ids ON documents.doc_id = ids.doc_id),
base AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaf),
up AS (SELECT 0 AS level, tree, idx, leaf AS digest FROM base
  UNION ALL
  SELECT level + 1, tree, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM up) WHERE n > 1 GROUP BY level, tree, idx // 8),
sub AS (SELECT tree, digest AS subroot, level AS height FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY level DESC) AS k FROM up) WHERE k = 1),
subbase AS (SELECT *, row_number() OVER (ORDER BY tree) - 1 AS tidx FROM sub),
top AS (SELECT 0 AS level, tidx AS idx, subroot AS digest FROM subbase
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY level, idx // 8),
rt AS (SELECT digest AS root, level AS height FROM top ORDER BY level DESC LIMIT 1),
fold AS (SELECT 0 AS level, base.tree, base.idx AS pos, base.idx, other AS h, '' AS proof FROM base
  UNION ALL
  SELECT fold.level + 1, fold.tree, pos, fold.idx // 8, sha256(string_agg(CASE WHEN up.idx = fold.idx THEN h ELSE up.digest END, '' ORDER BY up.idx)),
         any_value(proof) || coalesce(string_agg(CASE WHEN up.idx = fold.idx THEN NULL ELSE up.digest END, '' ORDER BY up.idx), '')
  FROM fold JOIN sub ON sub.tree = fold.tree JOIN up ON up.tree = fold.tree AND up.level = fold.level AND up.idx // 8 = fold.idx // 8
  WHERE fold.level < sub.height GROUP BY fold.level, fold.tree, pos, fold.idx // 8),
tfold AS (SELECT 0 AS level, fold.tree, pos, subbase.tidx AS idx, h, proof FROM fold JOIN subbase ON subbase.tree = fold.tree AND subbase.height = fold.level
  UNION ALL
  SELECT tfold.level + 1, tfold.tree, pos, tfold.idx // 8, sha256(string_agg(CASE WHEN top.idx = tfold.idx THEN h ELSE top.digest END, '' ORDER BY top.idx)),
         any_value(proof) || coalesce(string_agg(CASE WHEN top.idx = tfold.idx THEN NULL ELSE top.digest END, '' ORDER BY top.idx), '')
  FROM tfold JOIN rt ON tfold.level < rt.height JOIN top ON top.level = tfold.level AND top.idx // 8 = tfold.idx // 8
  GROUP BY tfold.level, tfold.tree, pos, tfold.idx // 8)
SELECT base.doc_id, base.leaf, sub.subroot, rt.root, sha256(proof) AS proof_sha256, h AS folded_root, h = rt.root AS verified
FROM base JOIN sub ON sub.tree = base.tree JOIN rt ON TRUE JOIN tfold ON tfold.tree = base.tree AND tfold.pos = base.idx AND tfold.level = rt.height
"""


SQL = _sql()
