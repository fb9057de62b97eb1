"""Temperature mixing of sources: token shares to a power, the power found by bisection, realised as block permutations.

A source with share p of the tokens gets the weight p^x / sum(p^x). The exponent x is the smallest in [0, 1] (the
flattest mixture) that keeps within the repetition limit, or the one whose weights have the target entropy (of the
two, the larger x if both are asked for). The budget is the given number of tokens, or the least that reads every
document once. Weight times budget over the source's tokens is how often the source is read (its epochs).

Documents of a source are dealt to ``BLOCKS`` blocks by the id's hash. An epoch is a permutation of the blocks; the
last, broken epoch is the start of one, cut where its tokens come nearest to what is left of the budget, so that a
source misses its budget by half a block at most. Each copy of a document has a slot in [0, 1): its block's place
in the whole run. Read in the order of slots, every part of the run has the sources in the target weights.

All sums are Spark aggregates; the bisection works on the table of sources in rounds that try ``GRID`` exponents at
once, so the driver sees one row per exponent however many sources there are.

Tokens are what the caller's column says (the registered query takes them from the token counts, the corpus pipeline
takes UTF-8 bytes), or words if it gives none.

Cases: a null source counts as the empty name; null and empty texts have no tokens and follow their block; a source
without any token has no weight and is read once; very long texts count in full; repeated rows are documents each and
share a block; a null id has a block like any other; an empty table gives an empty result; one source gets weight 1.
Columns named with two leading underscores are for inner use.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import saved

BLOCKS, GRID, ROUNDS = 1024, 32, 5
#: Rows of the block plan that may be broadcast (under 100 bytes each); a larger plan is joined by a shuffle on source and block.
BROADCAST_ROWS = 200_000


def words(text: str) -> Column:
    """Number of runs without white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"\S+")), F.lit(0)).cast("long")


def _placed(documents: DataFrame, id_col: str, source: str) -> DataFrame:
    return documents.withColumn("__source", F.coalesce(F.col(source).cast("string"), F.lit(""))).withColumn(
        "__block", F.pmod(F.xxhash64(F.col(id_col), F.lit(101)), F.lit(BLOCKS)).cast("int"))


def exponent(shares: DataFrame, budget: float | None, total: float, entropy: float | None, repeats: float | None) -> tuple[float, float]:
    """(x, budget) for the sources' ``p``; ``entropy`` in nats, ``repeats``: epochs of any source at most."""

    def tried(lo: float, hi: float) -> list[tuple[float, float, float, float]]:
        """(x, entropy, epochs at most, budget) of GRID + 1 exponents."""
        xs = [lo + (hi - lo) * i / GRID for i in range(GRID + 1)] if lo < hi else [lo]
        at = shares.select("p", F.explode(F.array(*map(F.lit, xs))).alias("x")).withColumn("w", F.pow("p", F.col("x")))
        rows = at.groupBy("x").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.log("p")).alias("l"), F.max(F.col("w") / F.col("p")).alias("most"), F.min(F.col("w") / F.col("p")).alias("least")).collect()
        out = []
        for r in sorted(rows, key=lambda r: r["x"]):
            t = total * r["z"] / r["least"] if budget is None else budget  # epochs of a source: w / z * t / (p * total)
            out.append((r["x"], math.log(r["z"]) - r["x"] * r["l"] / r["z"], r["most"] / r["z"] * t / total, t))
        return out

    def least(ok) -> float:
        """The smallest x in [0, 1] that is ``ok``, which is a property of all larger ones; 1 if none is."""
        lo, hi = 0.0, 1.0
        for _ in range(ROUNDS):
            rows = tried(lo, hi)
            k = next((i for i, r in enumerate(rows) if ok(r)), None)
            if k is None:
                return 1.0
            if k == 0:
                return rows[0][0]
            lo, hi = rows[k - 1][0], rows[k][0]
        return hi

    found = [0.0 if entropy is None and repeats is None else -1.0]
    if entropy is not None:
        found.append(least(lambda r: r[1] <= entropy + 1e-12))
    if repeats is not None:
        found.append(least(lambda r: r[2] <= repeats + 1e-9))
    x = max(found)
    return x, next(r[3] for r in tried(x, x))


def plan(documents: DataFrame, entropy: float | None = None, repeats: float | None = None, budget: float | None = None,
         id_col: str = "doc_id", source: str = "source", tokens: Column | None = None, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(block plan, sources): how often each block of each source is read, and each source's weight, epochs and budget."""
    spark = documents.sparkSession
    sizes = _placed(documents, id_col, source).groupBy("__source", "__block").agg(F.sum(words(text) if tokens is None else tokens).alias("tokens"))
    sizes, _ = saved(spark, sizes, "mix-blocks")
    totals, _ = saved(spark, sizes.groupBy("__source").agg(F.sum("tokens").alias("n")), "mix-sources")
    total = float(totals.agg(F.sum("n")).first()[0] or 0)
    if not total:
        weighed = totals.select("__source", "n", F.lit(0.0).alias("weight"), F.lit(1.0).alias("epochs"), F.lit(0.0).alias("tokens_budget"))
    else:
        shares = totals.where("n > 0").select((F.col("n") / total).alias("p"))
        x, run = exponent(shares, budget, total, entropy, repeats)
        z = float(shares.agg(F.sum(F.pow("p", F.lit(x)))).first()[0])
        weight = F.when(F.col("n") > 0, F.pow(F.col("n") / total, F.lit(x)) / z).otherwise(0.0)
        weighed = totals.withColumn("weight", weight).withColumn("tokens_budget", F.col("weight") * run).withColumn(
            "epochs", F.when(F.col("n") > 0, F.round(F.col("tokens_budget") / F.col("n"), 9)).otherwise(1.0)).select("__source", "n", "weight", "epochs", "tokens_budget")
    # the broken epoch reads blocks in the order of a permutation of its own, up to the nearest block border
    order = Window.partitionBy("__source").orderBy(F.xxhash64("__block", "__source", F.floor("epochs").cast("int")), "__block")
    rest = (F.col("epochs") - F.floor("epochs")) * F.col("n")
    blocks = sizes.join(weighed, "__source").withColumn("before", F.sum("tokens").over(order) - F.col("tokens")).withColumn(
        "extra", (rest > 1e-6) & (F.col("before") + F.col("tokens") / 2.0 <= rest)).select("__source", "__block", "epochs", F.col("extra"))
    return blocks, weighed.withColumnRenamed("__source", "source").withColumnRenamed("n", "tokens")


def mixed(documents: DataFrame, blocks: DataFrame, id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """All columns, and for each copy of a row ``__epoch`` (from 0), ``__block`` and ``__slot``."""
    blocks, _ = saved(documents.sparkSession, blocks, "mix-plan")
    small = blocks.count() <= BROADCAST_ROWS
    rows = _placed(documents, id_col, source).join(F.broadcast(blocks) if small else blocks, ["__source", "__block"])
    copies = (F.floor("epochs") + F.col("extra").cast("int")).cast("int")
    rows = rows.withColumn("__epoch", F.explode(F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>"))))
    # the block's place in its epoch's permutation: a hash in [0, 1), which needs no count of blocks
    place = (F.pmod(F.xxhash64("__block", "__source", F.col("__epoch")), F.lit(1 << 40)) / float(1 << 40))
    last = F.col("__epoch") >= F.floor("epochs")
    part = F.when(last, F.col("epochs") - F.floor("epochs")).otherwise(1.0)
    return rows.withColumn("__slot", (F.col("__epoch") + place * part) / F.greatest(F.col("epochs"), F.col("__epoch") + part)).drop("__source", "epochs", "extra")


def mix(documents: DataFrame, keep: list[str], entropy: float | None = None, repeats: float | None = None, budget: float | None = None,
        id_col: str = "doc_id", source: str = "source", tokens: Column | None = None, text: str = "text") -> DataFrame:
    """A row for each copy that the run reads: the columns ``keep``, ``epoch``, ``block`` and ``slot`` (like-named input columns are not kept)."""
    blocks, _ = plan(documents, entropy, repeats, budget, id_col, source, tokens, text)
    keep = [c for c in dict.fromkeys(keep) if c not in ("epoch", "block", "slot")]
    out = mixed(documents.select(*dict.fromkeys([*keep, id_col, source])), blocks, id_col, source)
    return out.select(*keep, F.col("__epoch").alias("epoch"), F.col("__block").alias("block"), F.col("__slot").alias("slot"))
