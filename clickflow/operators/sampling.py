"""Time-proportional random session sample (session task, part 3).

Quota rule of the reference, kept (integer arithmetic, floors kept):
  per-day quota = sample_size div number_of_days
  per-hour quota = min(hour_count, hour_count * per_day_quota div day_count)
The sessions taken in an hour are the ``quota`` smallest by
``md5(session_id || seed)`` (then session_id): seeded and reproducible.

Plan notes
* No driver loop and no per-hour index lists: counts and quotas are small
  aggregates (one row per hour).
* Ranking inside an hour is split by the first hex digits of the hash (4096
  buckets by default): per (day, hour, bucket) counts and a running sum over
  the buckets of the hour (at most 4096 rows per hour) give how many sessions
  come before each bucket; only buckets that start below the quota are kept,
  and the row_number runs per (day, hour, bucket). A busy hour is therefore
  spread over thousands of tasks, never sorted in one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.dates import date_hour


def session_starts(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("_d", F.col("start_time").cast("date")).withColumn("_hr", F.hour("start_time"))


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Number of sessions starting in each ``yyyy-MM-dd_HH``."""
    return sessions.groupBy(date_hour("start_time").alias("date_hour")).agg(
        F.count(F.lit(1)).alias("session_count"))


def hour_quotas(hour_counts: DataFrame, sample_size: int) -> DataFrame:
    """(_d, _hr, _quota) for every hour with sessions, from (_d, _hr, _c)."""
    # one row per day: its total and the number of days. The un-partitioned
    # window runs over this per-day table only (one row per calendar day in
    # the data, so bounded by the date range, not by the row count).
    days = hour_counts.groupBy("_d").agg(F.sum("_c").alias("_day_total"))
    days = days.select("_d", "_day_total", F.count(F.lit(1)).over(Window.partitionBy()).alias("_n_days"))
    q = hour_counts.join(days, "_d")
    per_day = F.floor(F.lit(int(sample_size)) / F.col("_n_days")).cast("bigint")
    num = F.col("_c") * per_day
    quota = F.least(F.col("_c"), ((num - num % F.col("_day_total")) / F.col("_day_total")).cast("bigint"))
    return q.select("_d", "_hr", quota.alias("_quota"))


def random_extract(sessions: DataFrame, sample_size: int, seed: str = "42", prefix_len: int = 3) -> DataFrame:
    """The sampled sessions (all input columns)."""
    s = session_starts(sessions)
    s = s.withColumn("_h", F.md5(F.concat(F.col("session_id"), F.lit(str(seed)))))
    s = s.withColumn("_b", F.substring("_h", 1, prefix_len))
    bc = s.groupBy("_d", "_hr", "_b").agg(F.count(F.lit(1)).alias("_n"))
    # hour totals from the bucket counts (at most 16^prefix_len rows per hour),
    # not from a second pass over the sessions
    quotas = hour_quotas(bc.groupBy("_d", "_hr").agg(F.sum("_n").alias("_c")), sample_size)
    wb = Window.partitionBy("_d", "_hr").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bc = bc.withColumn("_before", F.coalesce(F.sum("_n").over(wb), F.lit(0)).cast("bigint"))
    needed = bc.join(quotas, ["_d", "_hr"]).where(F.col("_before") < F.col("_quota")) \
        .select("_d", "_hr", "_b", "_before", "_quota")
    w = Window.partitionBy("_d", "_hr", "_b").orderBy("_h", "session_id")
    ranked = s.join(needed, ["_d", "_hr", "_b"]).withColumn("_rn", F.row_number().over(w))
    picked = ranked.where(F.col("_before") + F.col("_rn") <= F.col("_quota"))
    return picked.drop("_d", "_hr", "_h", "_b", "_before", "_quota", "_rn")


def sampled_sessions(actions: DataFrame, sample_size: int, seed: str = "42", prefix_len: int = 3) -> DataFrame:
    """W6 from action rows, output as ``session_aggregates`` rows.

    The sample depends on each session's id and start time only, so it is
    drawn from a plain ``min`` aggregate over all sessions; the full
    aggregates (keyword and category sets included) are then built for the
    sampled sessions alone, from their rows picked by a semi-join with the
    sampled keys."""
    from clickflow.operators.sessions import session_aggregates

    starts = actions.groupBy("session_id").agg(F.min("action_time").alias("start_time"))
    keys = random_extract(starts, sample_size, seed, prefix_len).select("session_id")
    return session_aggregates(actions.join(keys, "session_id", "left_semi"))


def sample_detail(sampled: DataFrame, actions: DataFrame) -> DataFrame:
    """Action rows of the sampled sessions (the planner sees the sample's size)."""
    return actions.join(sampled.select("session_id"), "session_id", "left_semi")
