"""Top products per area (product task).

click scan -> join city dimension -> count per (area, product) with the
distinct city list -> join product dimension -> row_number per area.

Plan notes
* The click scan projects two columns and pushes the date range and the
  not-null predicate into the parquet reader.
* The aggregate is partial (map-side) before the shuffle on (area, product),
  so a hot product is pre-counted per input partition; the distinct city list
  is a ``collect_set`` (also partial), bounded by the number of cities.
* Dimension joins carry no broadcast hint: the planner broadcasts them only
  under ``spark.sql.autoBroadcastJoinThreshold`` (a size check) and AQE can
  switch at runtime after measuring the shuffle.
* ``row_number() <= 3`` is planned with a partial WindowGroupLimit before the
  shuffle, so each input partition sends at most 3 rows per area.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.udfs import concat_long_string, group_concat_distinct, json_field

# Area to level mapping for the test tables (fixed values; a parameter).
DEFAULT_AREA_LEVELS = {
    "AFRICA": "A",
    "AMERICA": "A",
    "ASIA": "B",
    "EUROPE": "B",
    "MIDDLE EAST": "C",
}
OTHER_LEVEL = "D"

SELF_STATUS = "Self"
THIRD_PARTY_STATUS = "Third Party"


def click_scan(actions: DataFrame, start_date=None, end_date=None) -> DataFrame:
    """(city_id, product_id) of click actions, date range inclusive."""
    cond = F.col("click_product_id").isNotNull()
    if start_date is not None and end_date is not None:
        cond = cond & F.col("date").between(F.lit(start_date).cast("date"), F.lit(end_date).cast("date"))
    return actions.where(cond).select("city_id", F.col("click_product_id").alias("product_id"))


def clicks_with_city(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Inner join on city_id; clicks from unknown cities are dropped."""
    return clicks.join(cities, "city_id").select("city_id", "city_name", "area", "product_id")


def area_product_counts(basic: DataFrame) -> DataFrame:
    """Click count and distinct ``city_id:city_name`` list per (area, product)."""
    return basic.groupBy("area", "product_id").agg(
        F.count(F.lit(1)).alias("click_count"),
        group_concat_distinct(concat_long_string("city_id", "city_name", ":")).alias("city_infos"),
    )


def product_status(extend_info) -> Column:
    """``Self`` when the JSON field product_status is "0", else ``Third Party``
    (also for a missing field or bad JSON)."""
    js = F.col(extend_info) if isinstance(extend_info, str) else extend_info
    return F.when(F.coalesce(json_field(js, "product_status") == "0", F.lit(False)), SELF_STATUS) \
        .otherwise(THIRD_PARTY_STATUS)


def with_product(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Inner join with the product dimension; adds name and status."""
    p = products.select("product_id", "product_name", product_status("extend_info").alias("product_status"))
    return counts.join(p, "product_id")


def area_level(area_col: str = "area", levels: dict | None = None) -> Column:
    """CASE mapping of an area to its level."""
    levels = DEFAULT_AREA_LEVELS if levels is None else levels
    expr = None
    for name, lvl in levels.items():
        expr = (F.when(F.col(area_col) == name, lvl) if expr is None
                else expr.when(F.col(area_col) == name, lvl))
    return F.lit(OTHER_LEVEL) if expr is None else expr.otherwise(OTHER_LEVEL)


def top_n_per_group(df: DataFrame, group_cols, order_cols, n: int) -> DataFrame:
    """Rows with ``row_number() <= n`` per group (ties broken by ``order_cols``)."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def area_top3_products(actions: DataFrame, cities: DataFrame, products: DataFrame,
                       start_date=None, end_date=None, n: int = 3,
                       levels: dict | None = None) -> DataFrame:
    """Top-n products by clicks in each area.

    Output: area, area_level, product_id, click_count, city_infos,
    product_name, product_status.
    """
    basic = clicks_with_city(click_scan(actions, start_date, end_date), cities)
    full = with_product(area_product_counts(basic), products)
    top = top_n_per_group(full, ["area"], [F.desc("click_count"), F.asc("product_id")], n)
    return top.select(
        "area", area_level("area", levels).alias("area_level"), "product_id", "click_count",
        "city_infos", "product_name", "product_status",
    )
