"""Session aggregation, filter and length statistics (session task, part 1).

Plan notes
* ``session_aggregates`` is one hash aggregate keyed by session_id: min, max
  and count are algebraic, ``collect_set`` is partial too, so even a session
  holding a large share of all rows is combined map-side before the shuffle.
  The sets are bounded by the number of distinct keywords / categories.
* ``session_statistics`` is a single global aggregate of conditional sums
  (partial per task, one tiny final merge) in place of the reference's
  string accumulator; it is computed exactly once per action.
* ``session_detail`` is a left-semi join on session_id; AQE splits a skewed
  session partition (skew join handles left semi).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.functions.numbers import ratio2
from clickflow.operators.predicates import integers, session_filter
from clickflow.sources.task_params import TaskParams

# Length buckets (fixed values): name, lower bound, upper bound, upper inclusive.
# Visit length in seconds; 0 falls in no bucket but counts in session_count.
VISIT_BUCKETS = [
    ("1s_3s", 1, 3, True),
    ("4s_6s", 4, 6, True),
    ("7s_9s", 7, 9, True),
    ("10s_30s", 10, 30, False),
    ("30s_60s", 30, 60, False),
    ("1m_3m", 60, 180, False),
    ("3m_10m", 180, 600, False),
    ("10m_30m", 600, 1800, False),
    ("30m", 1800, None, False),
]
# Step length (actions per session).
STEP_BUCKETS = [
    ("1_3", 1, 3, True),
    ("4_6", 4, 6, True),
    ("7_9", 7, 9, True),
    ("10_30", 10, 30, False),
    ("30_60", 30, 60, False),
    ("60", 60, None, False),
]


KEYWORD_HIT = "_keyword_hit"
CATEGORY_HIT = "_category_hit"


def session_aggregates(actions: DataFrame, p: TaskParams | None = None) -> DataFrame:
    """G1: one row per session.

    Output: session_id, user_id, search_keywords (sorted distinct array),
    click_category_ids (sorted distinct array), start_time, end_time,
    visit_length (seconds, end - start), step_length (actions).

    With task parameters that filter on keywords or categories, also
    ``_keyword_hit`` / ``_category_hit``: whether any of the session's
    keywords / click categories is a parameter token (``bool_or``, an
    algebraic aggregate). The filter tests these, so when the output does not
    show the collected sets Catalyst drops them from the aggregate.
    """
    extra = []
    if p is not None and p.keywords:
        extra.append(F.bool_or(F.col("search_keyword").isin([str(k) for k in p.keywords])).alias(KEYWORD_HIT))
    if p is not None and p.category_ids:
        cats = integers(p.category_ids)
        extra.append(F.bool_or(F.col("click_category_id").isin(cats)).alias(CATEGORY_HIT))
    g = actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.array_sort(F.collect_set("search_keyword")).alias("search_keywords"),
        F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
        *extra,
    )
    return g.select(
        "session_id", "user_id", "search_keywords", "click_category_ids", "start_time", "end_time",
        F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time")).alias("visit_length"),
        "step_length", *[c for c in (KEYWORD_HIT, CATEGORY_HIT) if c in g.columns],
    )


def full_session_aggregates(actions: DataFrame, users: DataFrame, p: TaskParams | None = None) -> DataFrame:
    """G1 + J1: sessions with the user's age, professional, city and sex.
    Sessions whose user has no dimension row are dropped (inner join).
    ``p``: see ``session_aggregates``."""
    u = users.select("user_id", "age", "professional", "city", "sex")
    return session_aggregates(actions, p).join(u, "user_id")


def filter_sessions(full: DataFrame, p: TaskParams) -> DataFrame:
    """Keep sessions passing every given parameter term (the helper
    columns of ``session_aggregates``, if any, are used and dropped)."""
    cols = full.columns
    cond = session_filter(p, KEYWORD_HIT if KEYWORD_HIT in cols else None,
                          CATEGORY_HIT if CATEGORY_HIT in cols else None)
    out = full if cond is None else full.where(cond)
    return out.drop(*[c for c in (KEYWORD_HIT, CATEGORY_HIT) if c in cols])


#: Profile terms that all tasks' filters are joined on: list of a task, column of a session.
PROFILE_TERMS = (("professionals", "professional"), ("cities", "city"), ("sex", "sex"))


def filter_sessions_of_tasks(full: DataFrame, tasks: DataFrame) -> DataFrame:
    """S9 + P4 for many tasks in one pass: (task_id, and the columns of ``full``) of each session that a task's filter keeps.

    ``full``: sessions of one date range, read once whatever the number of tasks; ``tasks``: rows of
    ``task_params.param_values`` with that range. The profile lists are inverted: a task stands under each
    combination of its tokens, or of "any" where it sets none, and a session looks under its own values and "any"
    (eight keys). So the two meet in an equi-join, once at most; ages and set overlaps are tested on the pairs that
    meet. A term whose parameter is missing passes, one whose data value is missing fails.
    """
    t = tasks
    s = full
    keys = []
    for listed, column in PROFILE_TERMS:
        key = f"_key_{column}"
        keys.append(key)
        known = F.transform(F.col(listed), lambda x: F.concat(F.lit("="), x))
        t = t.withColumn(key, F.explode(F.coalesce(known, F.array(F.lit("*")))))
        s = s.withColumn(key, F.explode(F.array_compact(F.array(F.lit("*"), F.concat(F.lit("="), F.col(column).cast("string"))))))
    t = t.select("task_id", "start_age", "end_age", "keywords", F.col("category_ids").alias("_category_ids"), *keys)
    no_range = F.col("start_age").isNull() | F.col("end_age").isNull()
    met = s.join(t, keys).where(
        (no_range | F.col("age").between(F.col("start_age"), F.col("end_age")))
        & (F.col("keywords").isNull() | F.arrays_overlap("search_keywords", "keywords"))
        & (F.col("_category_ids").isNull() | F.arrays_overlap("click_category_ids", "_category_ids")))
    return met.select("task_id", *full.columns)


def session_detail(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Action rows of the given sessions."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def _bucket(col: Column, lo: int, hi: int | None, hi_inclusive: bool) -> Column:
    cond = col >= lo
    if hi is not None:
        cond = cond & ((col <= hi) if hi_inclusive else (col < hi))
    return F.count_if(cond)


def _visit_units(unit_seconds: int) -> Column:
    return F.col("visit_length") if unit_seconds == 1 else F.floor(F.col("visit_length") / unit_seconds)


def visit_length_histogram(sessions: DataFrame, unit_seconds: int = 1) -> DataFrame:
    """One row, session_count and one count per visit-length bucket.
    ``unit_seconds`` scales the bucket bounds (60: minutes instead of seconds)."""
    v = _visit_units(unit_seconds)
    return sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *[_bucket(v, lo, hi, inc).alias(f"visit_{n}") for n, lo, hi, inc in VISIT_BUCKETS],
    )


def step_length_histogram(sessions: DataFrame, buckets: list[tuple] = STEP_BUCKETS) -> DataFrame:
    """One row, session_count and one count per step-length bucket."""
    s = F.col("step_length")
    return sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *[_bucket(s, lo, hi, inc).alias(f"step_{n}") for n, lo, hi, inc in buckets],
    )


def session_statistics(sessions: DataFrame, unit_seconds: int = 1, step_buckets: list[tuple] = STEP_BUCKETS) -> DataFrame:
    """session_count and the 15 bucket ratios (2 decimals, half-up) in one pass.
    Ratios are null when there are no sessions."""
    v = _visit_units(unit_seconds)
    s = F.col("step_length")
    counts = sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *[_bucket(v, lo, hi, inc).alias(f"visit_{n}") for n, lo, hi, inc in VISIT_BUCKETS],
        *[_bucket(s, lo, hi, inc).alias(f"step_{n}") for n, lo, hi, inc in step_buckets],
    )
    names = [f"visit_{n}" for n, *_ in VISIT_BUCKETS] + [f"step_{n}" for n, *_ in step_buckets]
    return counts.select(
        "session_count",
        *[ratio2(n, "session_count").alias(f"{n}_ratio") for n in names],
    )
