"""Ad click statistics as batch DataFrame functions (also used per micro-batch).

Plan notes
* Every count is a partial/final hash aggregate (the reference's
  ``reduceByKey`` map-side combine), so a hot ad, user or province is
  pre-counted in each task before the shuffle.
* The blacklist removal is a ``left_anti`` join without a hint: the list is
  read from storage and grows with the data, so the planner decides from its
  size (broadcast under ``spark.sql.autoBroadcastJoinThreshold``, else a
  shuffle join that AQE may still convert at runtime).
* ``windows_of_panes`` reads windows off counts per (pane, ad) as differences
  of running sums: a pane adds its count where it enters a window and takes it
  away where it leaves, so nothing is copied per window but the answer's rows.
* Sliding windows are computed from per-slide counts: rows are first counted
  per (slide bucket, ad), and only those counts are fanned out to the
  length/slide windows that contain them, so a 60 min / 10 s window costs
  360 copies of a count row, not of every click.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.dates import millis_to_timestamp
from clickflow.operators.products import top_n_per_group

EPOCH_NTZ = "1970-01-01 00:00:00"


def parse_ad_log(lines: DataFrame, value_col: str = "value", keep_value: bool = False) -> DataFrame:
    """S7 + F7: ``<epoch_ms> <province> <city> <user_id> <ad_id>`` split on whitespace.

    Output: ts (timestamp), date (date), province, city, user_id, ad_id.
    Malformed numbers become null (the row is kept). ``keep_value``: with the line itself.
    """
    p = F.split(F.col(value_col), r"\s")
    ts = millis_to_timestamp(p[0].try_cast("bigint"))
    return lines.select(
        ts.alias("ts"),
        ts.cast("date").alias("date"),
        p[1].alias("province"),
        p[2].alias("city"),
        p[3].try_cast("bigint").alias("user_id"),
        p[4].try_cast("bigint").alias("ad_id"),
        *([F.col(value_col).alias("value")] if keep_value else []),
    )


def with_date(log: DataFrame) -> DataFrame:
    return log if "date" in log.columns else log.withColumn("date", F.col("ts").cast("date"))


def remove_blacklisted(log: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Drop clicks of listed users."""
    return log.join(blacklist.select("user_id").distinct(), "user_id", "left_anti")


def user_ad_counts(log: DataFrame) -> DataFrame:
    """C11: clicks per (date, user_id, ad_id)."""
    return with_date(log).groupBy("date", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def users_over_threshold(counts: DataFrame, threshold: int) -> DataFrame:
    """P9 + C14: distinct users with a (date, user, ad) count >= threshold."""
    return counts.where(F.col("click_count") >= threshold).select("user_id").distinct()


def ad_stat(log: DataFrame) -> DataFrame:
    """Clicks per (date, province, city, ad_id)."""
    return with_date(log).groupBy("date", "province", "city", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count"))


def province_counts(stat: DataFrame) -> DataFrame:
    """Roll the city counts up to (date, province, ad_id)."""
    return stat.groupBy("date", "province", "ad_id").agg(F.sum("click_count").cast("bigint").alias("click_count"))


def province_top3(prov: DataFrame, n: int = 3) -> DataFrame:
    """The n ads with most clicks per (date, province); ad_id breaks ties."""
    return top_n_per_group(prov, ["date", "province"], [F.desc("click_count"), F.asc("ad_id")], n)


def _minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def minute_counts(log: DataFrame) -> DataFrame:
    """A6 (event time): clicks per (minute, ad_id); minute is a timestamp_ntz."""
    return log.groupBy(_minute_of(F.col("ts")).alias("minute"), "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def click_trend(log: DataFrame) -> DataFrame:
    """A6 as the reference's table: date, hour, minute (strings), ad_id, click_count."""
    m = minute_counts(log)
    return m.select(
        F.date_format("minute", "yyyy-MM-dd").alias("date"),
        F.date_format("minute", "HH").alias("hour"),
        F.date_format("minute", "mm").alias("minute"),
        "ad_id", "click_count",
    )


def sliding_counts(log: DataFrame, window_minutes: int = 60, slide_minutes: int = 10,
                   slide_seconds: int | None = None) -> DataFrame:
    """Clicks per ad in windows of ``window_minutes`` every ``slide_minutes``
    (or every ``slide_seconds``, e.g. the reference's 10 s).

    Windows are [start, start + length) with start a multiple of the slide
    (Spark's ``window()`` semantics); only windows containing clicks appear.
    Output: window_start, window_end (timestamp_ntz), ad_id, click_count.
    """
    slide_s = int(slide_seconds) if slide_seconds else slide_minutes * 60
    if (window_minutes * 60) % slide_s:
        raise ValueError("window length must be a multiple of the slide")
    secs = F.timestamp_diff("SECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))
    per_slide = log.groupBy(F.floor(secs / slide_s).alias("_slot"), "ad_id").agg(F.count(F.lit(1)).alias("_n"))
    copies = window_minutes * 60 // slide_s
    fanned = per_slide.select(F.explode(F.sequence(F.col("_slot") - (copies - 1), F.col("_slot"))).alias("_w"),
                              "ad_id", "_n")
    agg = fanned.groupBy("_w", "ad_id").agg(F.sum("_n").cast("bigint").alias("click_count"))
    start = F.timestamp_add("SECOND", F.col("_w") * slide_s, F.lit(EPOCH_NTZ).cast("timestamp_ntz"))
    return agg.select(
        start.alias("window_start"),
        F.timestamp_add("MINUTE", F.lit(window_minutes), start).alias("window_end"),
        "ad_id", "click_count",
    )


SLOTS_SCHEMA = "date date, slot bigint, ad_id bigint, click_count bigint"


def pane_of(ts: Column, seconds: int) -> Column:
    """The number of the pane (``seconds`` long, counted from the epoch) that a time lies in."""
    return F.floor(F.timestamp_diff("SECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), ts.cast("timestamp_ntz")) / int(seconds))


def windows_of_panes(panes: DataFrame, pane_seconds: int, window_minutes: int = 60, slide_seconds: int = 600) -> DataFrame:
    """A7 from counts per pane: ``panes`` (slot, ad_id, click_count), one row per pane and ad.

    Same windows and output as ``sliding_counts``. The running sums restart every day of window starts, from a carry per
    (ad, day), so a window function's partition holds two rows per slide of one day and ad at most.
    """
    length = window_minutes * 60
    if slide_seconds % pane_seconds or length % slide_seconds:
        raise ValueError("the slide must be a multiple of the pane, the window of the slide")
    copies, a_day = length // slide_seconds, max(1, 86400 // slide_seconds)
    slots = panes.groupBy(F.floor(F.col("slot") * pane_seconds / slide_seconds).alias("_s"), "ad_id").agg(F.sum("click_count").alias("_n"))
    # a slot enters the window that starts copies - 1 slots before it and is gone in the one that starts after it
    steps = slots.select("ad_id", F.explode(F.array(F.struct((F.col("_s") - (copies - 1)).alias("_w"), F.col("_n")), F.struct((F.col("_s") + 1).alias("_w"), (-F.col("_n")).alias("_n")))).alias("_x"))
    steps = steps.groupBy("ad_id", F.col("_x._w").alias("_w")).agg(F.sum("_x._n").alias("_n")).withColumn("_d", F.floor(F.col("_w") / a_day))
    ad_null = F.col("ad_id").isNull()
    days = steps.groupBy("ad_id", "_d").agg(F.sum("_n").alias("_n"))
    # the sum before each day, and before the day after each (which may hold no step of its own)
    days = days.unionAll(days.select("ad_id", F.col("_d") + 1, F.lit(0).cast("bigint"))).groupBy("ad_id", "_d").agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy(ad_null, "ad_id").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    starts = days.select("ad_id", (F.col("_d") * a_day).alias("_w"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"), "_d", F.lit(0).alias("_o"))
    rows = steps.select("ad_id", "_w", "_n", "_d", F.lit(1).alias("_o")).unionAll(starts)
    order = Window.partitionBy(ad_null, "ad_id", "_d").orderBy("_w", "_o")
    runs = rows.select("ad_id", "_w", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("_n"),
                       F.coalesce(F.lead("_w").over(order), (F.col("_d") + 1) * a_day).alias("_next"))
    runs = runs.where((F.col("_n") > 0) & (F.col("_next") > F.col("_w"))).select("ad_id", "_n", F.explode(F.sequence("_w", F.col("_next") - 1)).alias("_w"))
    start = F.timestamp_add("SECOND", F.col("_w") * slide_seconds, F.lit(EPOCH_NTZ).cast("timestamp_ntz"))
    return runs.select(start.alias("window_start"), F.timestamp_add("MINUTE", F.lit(window_minutes), start).alias("window_end"), "ad_id", F.col("_n").cast("bigint").alias("click_count"))
