"""Readers for the input tables as the click-log jobs store them: dates, times and id lists as text.

A table is a folder ``<dir>/<table>`` of parquet files, or a catalog table ``<database>.<table>``. The readers give
the typed columns that the operators take. ``user_visit_action`` has no event id there, so the hash of the whole
row breaks ties between actions of one instant: the same order in every run.

Date ranges are compared as the text they are stored as (``yyyy-MM-dd`` sorts by day, and the jobs compare it so), so
both bounds reach the parquet reader, or prune whole folders of a table that is laid out by date (``store_actions``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.functions.dates import parse_time
from clickflow.functions.strings import join_ids, split_ids

# Columns of the stored tables (fixed values).
ACTION_COLUMNS = ["date", "user_id", "session_id", "page_id", "action_time", "search_keyword", "click_category_id", "click_product_id",
                  "order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids", "city_id"]
ID_LISTS = ["order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids"]
USER_COLUMNS = ["user_id", "username", "name", "age", "professional", "city", "sex"]
PRODUCT_COLUMNS = ["product_id", "product_name", "extend_info"]
CITY_COLUMNS = ["city_id", "city_name", "area"]


def stored(spark: SparkSession, source: str, table: str) -> DataFrame:
    """A stored table by folder (anything with a slash) or by database."""
    return spark.read.parquet(f"{source.rstrip('/')}/{table}") if "/" in source else spark.table(f"{source}.{table}")


def _ids(col: str) -> Column:
    """the ids of a comma list; null stays null."""
    return F.when(F.col(col).isNotNull(), split_ids(col))


def _in_range(rows: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Rows of the days from ``start`` to ``end`` (``yyyy-MM-dd``, a missing one is open), by the type that ``date`` has in ``rows``: a
    date in tables laid out by it, else text."""
    kind = dict(rows.dtypes)["date"]
    for bound, keep in ((start, F.col("date").__ge__), (end, F.col("date").__le__)):
        if bound is not None:
            rows = rows.where(keep(F.lit(str(bound)).cast(kind)))
    return rows


def user_visit_action(spark: SparkSession, source: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Typed action rows, of a range of days if bounds are given. With a bound, rows whose date is no date drop out; without, it is null.

    The range is taken on the stored form, which prunes, and again on the date, which drops malformed ones."""
    rows = _in_range(stored(spark, source, "user_visit_action").select(*ACTION_COLUMNS), start, end)
    typed = {"date": F.col("date").try_cast("date"), "action_time": parse_time("action_time"), **{c: _ids(c) for c in ID_LISTS}}
    hashed = [F.col(c).cast("string") if c == "date" else F.col(c) for c in ACTION_COLUMNS]
    out = rows.select(F.xxhash64(*hashed).alias("event_id"), *[typed.get(c, F.col(c)).alias(c) for c in ACTION_COLUMNS])
    return _in_range(out, start, end)


def store_actions(actions: DataFrame, path: str, name: str | None = None, session_buckets: int | None = None) -> None:
    """Write typed action rows in the stored form, laid out by ``date``, appending to what is there.

    ``session_buckets`` (with the catalog ``name`` of the table) also deals every day's rows by session into so many buckets
    and sorts them, so that session aggregates and joins by session need no shuffle. A bucket is read by one task: leave
    buckets out where one session may hold a large share of all rows.
    """
    rows = rendered_actions(actions)
    if session_buckets:
        (rows.repartition(session_buckets, "session_id").write.mode("append").partitionBy("date").bucketBy(session_buckets, "session_id")
         .sortBy("session_id").option("path", path).saveAsTable(name))
    else:
        rows.repartition("date", F.pmod(F.xxhash64("session_id"), F.lit(16))).write.mode("append").partitionBy("date").parquet(path)


def user_info(spark: SparkSession, source: str) -> DataFrame:
    return stored(spark, source, "user_info").select(*USER_COLUMNS)


def product_info(spark: SparkSession, source: str) -> DataFrame:
    return stored(spark, source, "product_info").select(*PRODUCT_COLUMNS)


def city_info(spark: SparkSession, source: str) -> DataFrame:
    return stored(spark, source, "city_info").select(F.col("city_id").cast("bigint").alias("city_id"), "city_name", "area")


def rendered_actions(actions: DataFrame) -> DataFrame:
    """Typed action rows in the stored form: the inverse of ``user_visit_action``."""
    text = {"date": F.date_format("date", "yyyy-MM-dd"), "action_time": F.date_format("action_time", "yyyy-MM-dd HH:mm:ss"), **{c: join_ids(c) for c in ID_LISTS}}
    return actions.select(*[text.get(c, F.col(c)).alias(c) for c in ACTION_COLUMNS])
