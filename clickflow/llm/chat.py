"""Chat formatting: logged snapshots of growing conversations are collapsed to the longest ones, which are rendered.

A conversation's turns in order have rolling prefix hashes (two 64-bit hashes of position, role and text, combined turn by
turn). A conversation whose whole hash is a proper prefix hash of another one is a snapshot of it and goes by an
anti-join; of equal conversations the smallest id stays. The kept ones are rendered, a turn after the other.

Turns are handled in spans of ``SPAN`` turn numbers: windows run within a span, and spans are chained by a small table,
so a conversation of any length is spread over tasks; its text comes in parts of ``SPAN`` turns.

Cases: a null role or text counts as empty; a null turn number comes first; a null conversation id is a conversation of its
own; equal turn numbers are ordered by role and text; a row repeated in all four columns counts once; an
empty table gives an empty result. Only the columns named in the call are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import saved

SPAN = 1024


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def _chained(turns: DataFrame) -> DataFrame:
    """``turns`` (conv, turn, role, text; distinct) with ``pos`` from 1, the conversation's ``n`` turns, and prefix hashes ``p1``, ``p2``."""
    turns = turns.withColumn("span", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / SPAN))
    order = Window.partitionBy("conv", "span").orderBy(F.asc_nulls_first("turn"), "role", "text")
    before = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)

    def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
        spans = spans.withColumnRenamed("conv", "__conv").withColumnRenamed("span", "__span")
        return rows.join(spans, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("span") == F.col("__span"))).drop("__conv", "__span")

    rows = turns.withColumn("at", F.row_number().over(order))
    spans = rows.groupBy("conv", "span").agg(F.count("*").alias("c"))
    spans = spans.withColumn("first", F.coalesce(F.sum("c").over(before), F.lit(0))).withColumn("n", F.sum("c").over(Window.partitionBy("conv"))).drop("c")
    rows = with_spans(rows, spans).withColumn("pos", F.col("first") + F.col("at"))
    rows = rows.withColumn("h1", F.xxhash64("pos", "role", "text")).withColumn("h2", F.xxhash64("text", F.lit(7), "role", "pos"))
    spans = rows.groupBy("conv", "span").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    for k in ("1", "2"):
        spans = spans.withColumn("b" + k, F.coalesce(F.bit_xor("x" + k).over(before), F.lit(0).cast("long")))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = with_spans(rows, spans.drop("x1", "x2"))
    for k in ("1", "2"):
        rows = rows.withColumn("p" + k, F.col("b" + k).bitwiseXOR(F.bit_xor("h" + k).over(upto)))
    return rows.select("conv", "pos", "n", "role", "text", "p1", "p2")


def collapse(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, part, n_turns, text): the rendered maximal conversations."""
    spark = conversations.sparkSession
    turns = conversations.select(F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
                                 F.coalesce(text, F.lit("")).alias("text")).distinct()
    rows, _ = saved(spark, _chained(turns), "chat-turns")
    whole = rows.where("pos = n").groupBy("pos", "p1", "p2").agg(F.min("conv").alias("least"), F.max(F.col("conv").isNull()).alias("nameless"))
    longer = rows.where("pos < n").select("pos", "p1", "p2").distinct()
    kept = whole.join(longer, ["pos", "p1", "p2"], "left_anti").select(F.when(~F.col("nameless"), F.col("least")).alias("kept"))
    texts = rows.join(kept, F.col("conv").eqNullSafe(F.col("kept")), "left_semi").withColumn("part", F.floor((F.col("pos") - 1) / SPAN))
    parts = texts.groupBy("conv", "part", "n").agg(F.sort_array(F.collect_list(F.struct("pos", rendered_turn(F.col("role"), F.col("text")).alias("line")))).alias("lines"))
    return parts.select(F.col("conv").alias("conv_id"), F.col("part").cast("long").alias("part"), F.col("n").alias("n_turns"), F.array_join("lines.line", "").alias("text"))


#: The same in DuckDB, comparing whole bodies instead of hashes.
SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
c AS (SELECT conv_id, count(*) AS n, string_agg(role || chr(1) || text || chr(2), '' ORDER BY pos) AS body FROM o GROUP BY conv_id),
k AS (SELECT CASE WHEN bool_or(conv_id IS NULL) THEN NULL ELSE min(conv_id) END AS conv_id, n, body FROM c GROUP BY n, body),
m AS (SELECT conv_id, n FROM k WHERE NOT EXISTS (SELECT 1 FROM k AS d WHERE d.n > k.n AND starts_with(d.body, k.body)))
SELECT o.conv_id, CAST((pos - 1) // {SPAN} AS BIGINT) AS part, CAST(m.n AS BIGINT) AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY pos) AS text
FROM o JOIN m ON o.conv_id IS NOT DISTINCT FROM m.conv_id GROUP BY o.conv_id, (pos - 1) // {SPAN}, m.n
"""
