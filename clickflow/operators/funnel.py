"""Page-to-page conversion (page task).

Plan notes
* The reference groups each session's rows in memory and sorts them. Here the
  predecessor of each action is a ``lag`` in three levels, each a window
  whose partitions have a bound, so no session, however hot, meets in one
  task:
    1. rows, per (session, exact action time, event-id block of at most
       ``block_rows`` ids): the key is monotone in the (time, event id)
       order, so each partition is a contiguous run of the session, holding
       at most ``block_rows`` rows;
    2. the last row of each such run, per (session, minute): at most one row
       per distinct time and block of that minute;
    3. the last row of each minute, per session: at most 1,440 rows a day.
  The first row of a run takes the last row of the previous run of its
  minute (level 2), and the first run of a minute the last row of the
  previous minute (level 3). The result is exactly the per-session
  time-ordered lag (tested against a sort in pandas, with tiny blocks).
* The flow match is an expression built from the flow parameter (no join),
  start-page views are folded into the same aggregate as step 0, so the
  counts need one partial/final aggregate over the pairs.
* The final rate table has one row per flow step (bounded by the parameter).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.numbers import ratio2

EPOCH_NTZ = "1970-01-01 00:00:00"
PAIR_SEP = "_"
RATE_FIELD_SEP = "|"


def _time_bucket(ts: Column, bucket_seconds: int) -> Column:
    secs = F.timestamp_diff("SECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))
    return F.floor(secs / bucket_seconds)


def _ordered(df: DataFrame, keys: list[str], order: list[str], value: str, prev_name: str) -> DataFrame:
    """Within each ``keys`` partition ordered by ``order``: the previous
    ``value`` (as ``prev_name``), the row number ``_rn`` and the partition
    size ``_size`` (so ``_rn == 1`` is the first row, ``_rn == _size`` the last)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select("*", F.lag(value).over(w).alias(prev_name), F.row_number().over(w).alias("_rn"),
                     F.count(F.lit(1)).over(whole).alias("_size"))


def _sequenced(actions: DataFrame, bucket_seconds: int, block_rows: int) -> DataFrame:
    """Rows of sessions with their span ``_m`` and id block ``_blk``; rows without a session or a time belong to no sequence."""
    a = actions.select("session_id", "event_id", "page_id", "action_time",
                       _time_bucket(F.col("action_time"), bucket_seconds).alias("_m"),
                       F.coalesce(F.floor(F.col("event_id") / int(block_rows)), F.lit(-1)).alias("_blk"))
    return a.where(F.col("session_id").isNotNull() & F.col("_m").isNotNull())


def page_transitions(actions: DataFrame, bucket_seconds: int = 60, block_rows: int = 100_000) -> DataFrame:
    """W7 without the rows themselves: (prev_page_id, page_id) of every action, as ``page_pairs`` has them.

    The rows are shuffled once and never joined: pairs inside a run (session, time, block) come from the rows, pairs
    across runs from the runs' first and last pages, and pairs across spans from the spans'.
    """
    run, pair = ["session_id", "action_time", "_blk"], ["prev_page_id", "page_id"]
    rows = _ordered(_sequenced(actions, bucket_seconds, block_rows), run, ["event_id"], "page_id", "prev_page_id")

    def ends(part: DataFrame, keys: list[str], last: str) -> DataFrame:
        return part.where((F.col("_rn") == 1) | (F.col("_rn") == F.col("_size"))).groupBy(*keys).agg(
            F.min_by("page_id", "_rn").alias("page_id"), F.max_by(last, "_rn").alias("_last"))

    runs = _ordered(ends(rows, [*run, "_m"], "page_id"), ["session_id", "_m"], ["action_time", "_blk"], "_last", "prev_page_id")
    spans = ends(runs, ["session_id", "_m"], "_last").withColumn(
        "prev_page_id", F.lag("_last").over(Window.partitionBy("session_id").orderBy("_m")))
    return rows.where("_rn > 1").select(*pair).unionAll(runs.where("_rn > 1").select(*pair)).unionAll(spans.select(*pair))


def page_pairs(actions: DataFrame, bucket_seconds: int = 60, block_rows: int = 100_000) -> DataFrame:
    """Every action with the page of the action before it in its session.

    Output: session_id, event_id, page_id, prev_page_id (null for the first
    action of a session). Order: action_time, then event_id.

    The rows are shuffled once (on session, time, block); the carry tables
    hold one row per run and one per (session, ``bucket_seconds`` span).
    """
    a = _sequenced(actions, bucket_seconds, block_rows)
    run = ["session_id", "action_time", "_blk"]
    # level 1: inside a run
    rows = _ordered(a, run, ["event_id"], "page_id", "_prev_in")
    runs = rows.where(F.col("_rn") == F.col("_size")).select(*run, "_m", F.col("page_id").alias("_last"))
    # level 2: runs of one span, in order
    runs = _ordered(runs, ["session_id", "_m"], ["action_time", "_blk"], "_last", "_prev_run")
    spans = runs.where(F.col("_rn") == F.col("_size")).select("session_id", "_m", F.col("_last").alias("_span_last"))
    # level 3: spans of one session, in order
    spans = spans.select("session_id", "_m",
                         F.lag("_span_last").over(Window.partitionBy("session_id").orderBy("_m")).alias("_prev_span"))
    carry = runs.join(spans, ["session_id", "_m"]).select(
        *run, "_m", F.when(F.col("_rn") == 1, F.col("_prev_span")).otherwise(F.col("_prev_run")).alias("_carry"))
    # joining on _m too (it follows from the time) keeps the same columns in
    # every use of ``rows``, so its shuffle is computed once and reused
    out = rows.join(carry, [*run, "_m"])
    return out.select(
        "session_id", "event_id", "page_id",
        F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_prev_in")).alias("prev_page_id"),
    )


def _step_matches(flow: list[int]) -> Column:
    """Steps matched by a row: 0 when the row is a view of the start page,
    i when (prev, page) is the i-th pair of the flow."""
    terms = [F.when(F.col("page_id") == flow[0], F.lit(0))]
    for i in range(1, len(flow)):
        terms.append(F.when((F.col("prev_page_id") == flow[i - 1]) & (F.col("page_id") == flow[i]), F.lit(i)))
    return F.filter(F.array(*terms), lambda x: x.isNotNull())


def flow_step_counts(pairs: DataFrame, flow: list[int]) -> DataFrame:
    """W8 + C8 + C9: step (0 = start-page views) and its count, steps with a match only."""
    return (pairs.select(F.explode(_step_matches(flow)).alias("step"))
            .groupBy("step").agg(F.count(F.lit(1)).alias("pv")))


def _steps(spark, flow: list[int]) -> DataFrame:
    pages = F.array(*[F.lit(int(p)).cast("bigint") for p in flow])
    r = spark.range(0, len(flow)).select(F.col("id").cast("int").alias("step"))
    return r.select(
        "step",
        F.when(F.col("step") > 0, F.concat(F.element_at(pages, F.col("step")).cast("string"), F.lit(PAIR_SEP),
                                           F.element_at(pages, F.col("step") + 1).cast("string"))).alias("page_pair"),
    )


def conversion_rates(pairs: DataFrame, flow: list[int]) -> DataFrame:
    """One row per flow step i >= 1.

    Output: step, page_pair, pair_count, prev_count, convert_rate.
    prev_count is the start-page views for step 1, else the previous pair's
    count; a missing pair counts 0; a zero denominator gives a null rate.
    """
    if len(flow) < 2:
        raise ValueError("a page flow needs at least two pages")
    counts = flow_step_counts(pairs, flow)
    t = _steps(pairs.sparkSession, flow).join(counts, "step", "left") \
        .withColumn("pv", F.coalesce(F.col("pv"), F.lit(0).cast("bigint")))
    w = Window.orderBy("step")  # at most len(flow) rows
    t = t.withColumn("prev_count", F.lag("pv").over(w))
    return t.where(F.col("step") > 0).select(
        "step", "page_pair", F.col("pv").alias("pair_count"), "prev_count",
        ratio2("pv", "prev_count").alias("convert_rate"),
    )


def page_pair_counts(pairs: DataFrame, flow: list[int]) -> DataFrame:
    """Count of each flow pair (0 when absent), one row per step."""
    return conversion_rates(pairs, flow).select("step", "page_pair", "pair_count")


def rate_string(rates: DataFrame) -> DataFrame:
    """``a_b=rate|b_c=rate`` in flow order (one row)."""
    item = F.concat(F.col("page_pair"), F.lit("="), F.coalesce(F.col("convert_rate").cast("string"), F.lit("null")))
    agg = rates.agg(F.array_sort(F.collect_list(F.struct("step", item.alias("s")))).alias("_a"))
    return agg.select(F.array_join(F.transform("_a", lambda x: x["s"]), RATE_FIELD_SEP).alias("convert_rate"))
