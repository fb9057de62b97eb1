"""Site traffic and small SQL jobs: PV/UV per site-hour, global top-1, catalog scan.

Plan notes
* ``pv_uv`` uses ``count_distinct``; Spark rewrites it into an aggregate on
  (site, date, hour, user) first, so a hot site-hour is spread by user
  before the final count. ``approx=True`` switches to HyperLogLog
  (``approx_count_distinct``), one partial sketch per task, for very large
  groups when an estimate is acceptable.
* ``pv_sketches`` stores a mergeable sketch of the users beside the page views of
  every site and hour (a few KB each), so that days, sites or any other groups of
  hours are counted from the stored rows (``rolled_up``), without the log.
* ``global_ranks`` sorts by one range partitioning; the rows before a partition
  are known from a count per partition, so no window spans all rows.
* ``global_top1`` is ``orderBy(desc).limit(1)``: TakeOrderedAndProject, each
  task keeps one row; there is no full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.functions.dates import date_part, hour_part, parse_time
from clickflow.session import checkpoint_root


def parse_pv_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``site,user,yyyy-MM-dd HH:mm:ss`` -> site, user, date, hour (strings;
    hour of day unpadded)."""
    parts = F.split(F.col(value_col), ",")
    ts = parse_time(parts[2])
    return lines.select(
        parts[0].alias("site"), parts[1].alias("user"),
        date_part(ts).alias("date"), hour_part(ts).alias("hour"),
    )


def pv_uv(pv: DataFrame, approx: bool = False) -> DataFrame:
    """Page views and unique users per (site, date, hour)."""
    uv = F.approx_count_distinct("user") if approx else F.count_distinct("user")
    return pv.groupBy("site", "date", "hour").agg(F.count("user").alias("pv"), uv.alias("uv"))


#: log2 of the registers of a stored sketch, and the error that an estimate keeps (more than three times its standard error).
SKETCH_BITS, SKETCH_ERROR = 13, 0.04


def pv_sketches(pv: DataFrame) -> DataFrame:
    """C10 in a form that can be merged: page views and a HyperLogLog sketch of the users per (site, date, hour)."""
    return pv.groupBy("site", "date", "hour").agg(F.count("user").alias("pv"), F.hll_sketch_agg("user", SKETCH_BITS).alias("users"))


def rolled_up(sketches: DataFrame, by: list[str]) -> DataFrame:
    """``by``, pv, uv_estimate from stored ``pv_sketches`` rows; a user of many hours counts once."""
    return sketches.groupBy(*by).agg(F.sum("pv").cast("bigint").alias("pv"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("uv_estimate"))


def global_ranks(df: DataFrame, col: str, tie: str) -> DataFrame:
    """W5 for every row: ``df`` with ``rank``, its place from 1 in the order of falling ``col`` (nulls last), then rising ``tie``.

    The sorted partitions are checkpointed once; the driver gets a count per partition. ``col`` and ``tie`` together should
    tell rows apart: rows alike in both are not split.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    order = [F.desc_nulls_last(col), F.asc_nulls_last(tie)]
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_at", 33).cast("int")
    counts = {r["p"]: r["c"] for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}
    before, shifts = 0, []
    for p in sorted(counts):
        shifts.append((p, before + 1 - (p << 33)))
        before += counts[p]
    shift = spark.createDataFrame(shifts, "_p int, _shift bigint")
    return rows.join(shift, part == F.col("_p")).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_p", "_shift")


def global_top1(df: DataFrame, col: str) -> DataFrame:
    """The greatest value of ``col`` (first row of a descending sort)."""
    return df.select(col).orderBy(F.desc(col)).limit(1)


def catalog_scan(spark: SparkSession, database: str, table_name: str) -> DataFrame:
    """``USE database; SELECT * FROM table`` through the session catalog."""
    return spark.table(f"{database}.{table_name}")
