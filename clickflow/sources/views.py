"""Adapter views: the reference's input tables derived from the driver's tables.

The reference reads ``user_visit_action``, ``user_info``, ``product_info``,
``city_info`` and an ad click log. Here they are projections and joins over
``events``, ``customer``, ``nation``, ``region`` and ``part``; every view is
lazy, so predicates and column pruning still reach the parquet scans.

Mapping (fixed; the oracle SQL of ``clickflow.plans.oracle`` uses the same):
  session_id   = "<user_id>_<yyyyMMdd of ts>"   (a session is a user-day)
  page_id      = k % 10, where k is the integer in props {"k": n}
  action_time  = ts truncated to whole seconds
  search       = event_type 'view'      keyword "kw<k % 10>"
  click        = event_type 'click'     category k, product event_id % 200
  order        = event_type 'purchase'  categories [k, (k+1) % 100],
                                        products [event_id % 200, (event_id+1) % 200]
  pay          = event_type 'signup'    categories [k], products [event_id % 200]
  city_id      = user_id % 25  (a nation key)
  ad log       = click events, province = region name, city = nation name,
                 ad_id = k % 10
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.sources.tables import table


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def events_with_k(spark: SparkSession, base_dir: str) -> DataFrame:
    return table(spark, base_dir, "events").withColumn("k", _k())


def user_visit_action(spark: SparkSession, base_dir: str) -> DataFrame:
    """One row per action (search, click, order, pay) with real types.

    Columns: event_id, date, user_id, session_id, page_id, action_time,
    search_keyword, click_category_id, click_product_id, order_category_ids,
    order_product_ids, pay_category_ids, pay_product_ids, city_id.
    """
    e = events_with_k(spark, base_dir)
    et = F.col("event_type")
    k = F.col("k")
    eid = F.col("event_id")
    return e.select(
        eid,
        F.col("ts").cast("date").alias("date"),
        F.col("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("_"),
                 F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        (k % 10).alias("page_id"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("action_time"),
        F.when(et == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(et == "click", k).alias("click_category_id"),
        F.when(et == "click", eid % 200).alias("click_product_id"),
        F.when(et == "purchase", F.array(k, (k + 1) % 100)).alias("order_category_ids"),
        F.when(et == "purchase", F.array(eid % 200, (eid + 1) % 200)).alias("order_product_ids"),
        F.when(et == "signup", F.array(k)).alias("pay_category_ids"),
        F.when(et == "signup", F.array(eid % 200)).alias("pay_product_ids"),
        (F.col("user_id") % 25).alias("city_id"),
    )


def user_info(spark: SparkSession, base_dir: str) -> DataFrame:
    c = table(spark, base_dir, "customer")
    n = table(spark, base_dir, "nation")
    return c.where(F.col("c_custkey") % 10 != 3).join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def product_info(spark: SparkSession, base_dir: str) -> DataFrame:
    p = table(spark, base_dir, "part")
    return p.where(F.col("p_partkey") % 7 != 5).select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_partkey") % 2).cast("string"),
                 F.lit("}")).alias("extend_info"),
    )


def city_info(spark: SparkSession, base_dir: str) -> DataFrame:
    n = table(spark, base_dir, "nation")
    r = table(spark, base_dir, "region")
    return n.where(F.col("n_nationkey") != 24).join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def ad_log(spark: SparkSession, base_dir: str) -> DataFrame:
    """Parsed ad clicks: event_id, ts (timestamp_ntz), province, city, user_id, ad_id."""
    e = events_with_k(spark, base_dir).where(F.col("event_type") == "click")
    geo = city_info(spark, base_dir)
    return e.join(geo, (e.user_id % 25) == geo.city_id).select(
        "event_id", "ts",
        F.col("area").alias("province"),
        F.col("city_name").alias("city"),
        "user_id",
        (F.col("k") % 10).alias("ad_id"),
    )


def ad_log_lines(spark: SparkSession, base_dir: str) -> DataFrame:
    """The ad log as the text the reference's producer emits:
    ``<epoch_ms> <province> <city> <user_id> <ad_id>``; spaces inside a
    province name become ``-`` so that whitespace splitting stays correct."""
    return ad_log(spark, base_dir).select("event_id", ad_line().alias("value"))


def ad_line() -> Column:
    """Text form of one parsed ad click (columns ts, province, city, user_id, ad_id)."""
    return F.concat_ws(
        " ",
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
        F.regexp_replace("province", " ", "-"),
        F.col("city"),
        F.col("user_id").cast("string"),
        F.col("ad_id").cast("string"),
    )


def pv_lines(spark: SparkSession, base_dir: str) -> DataFrame:
    """CSV lines ``site,user,yyyy-MM-dd HH:mm:ss``: site = event type, user = user id."""
    e = table(spark, base_dir, "events")
    return e.select(
        F.concat_ws(",", F.col("event_type"), F.col("user_id").cast("string"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("value")
    )


def task_table(spark: SparkSession, base_dir: str, start_date: str, end_date: str,
               page_flow: list[int]) -> DataFrame:
    """A ``task`` table: one session-analysis task per user, whose filter is
    that user's profile. Columns task_id, task_name, task_type, task_param;
    ``task_param`` is JSON with arrays of one string, multi-values
    comma-joined, and absent names for unset parameters (odd users set no
    keywords, users divisible by 3 no categories)."""
    u = user_info(spark, base_dir)
    uid = F.col("user_id")

    def one(c: Column) -> Column:
        return F.when(c.isNotNull(), F.array(c.cast("string")))

    params = F.create_map(
        F.lit("startDate"), one(F.lit(start_date)),
        F.lit("endDate"), one(F.lit(end_date)),
        F.lit("startAge"), one(F.greatest(F.col("age") - 5, F.lit(0))),
        F.lit("endAge"), one(F.col("age") + 5),
        F.lit("professionals"), one(F.col("professional")),
        F.lit("cities"), one(F.col("city")),
        F.lit("sex"), one(F.col("sex")),
        F.lit("keywords"), one(F.when(uid % 2 == 0, F.concat(F.lit("kw"), (uid % 10).cast("string"), F.lit(",kw"),
                                                             ((uid + 1) % 10).cast("string")))),
        F.lit("categoryIds"), one(F.when(uid % 3 != 0, F.concat_ws(",", (uid % 100).cast("string"),
                                                                    ((uid + 7) % 100).cast("string")))),
        F.lit("targetPageFlow"), one(F.lit(",".join(str(int(p)) for p in page_flow))),
    )
    return u.select(
        uid.alias("task_id"),
        F.col("username").alias("task_name"),
        F.lit("session").alias("task_type"),
        F.to_json(F.map_filter(params, lambda k, v: v.isNotNull())).alias("task_param"),
    )
