"""Replay of a table as a file stream (tests and the registered stream queries).

The ad log lines are grouped into producer batches of ``days_per_batch``
consecutive days. The replay plays the producer: it appends one batch to the
source folder, then runs one trigger (``availableNow``) of each query, which
takes exactly the files that arrived since the previous trigger, as a
processing-time trigger takes what arrived in its interval.

``replay_in_one_run`` appends all batches first, each as the same number of files, and runs each query once
with that number of files per trigger: the same micro-batches, without starting a query for each of them.
The queries keep their state in as many partitions as the largest batch needs (``state_partitions``): every task of a
stateful stage sends the metrics of its state stores to the driver, in every batch, however few rows it gets.

Writing is parallel throughout: one pass writes all lines into a staging
folder partitioned by batch (every task writes its own files), and each
batch is copied from its own staging partition (partition pruning, so batch
``i`` reads only its folder) into the source folder, again one file per task.
No batch is funnelled through a single task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.sources import views as V

BATCH_COL = "replay_batch"
#: Lines of a batch for each partition of a stateful query.
LINES_PER_PARTITION = 25_000


@dataclass
class ReplayInput:
    lines: DataFrame  # columns: ts, value, replay_batch
    n_batches: int


def day_batches(lines_with_ts: DataFrame, days_per_batch: int, first_day) -> DataFrame:
    day_index = F.datediff(F.col("ts").cast("date"), F.lit(first_day))
    return lines_with_ts.withColumn(BATCH_COL, F.floor(day_index / int(days_per_batch)).cast("int"))


def ad_log_replay_lines(spark: SparkSession, base_dir: str, days_per_batch: int, late_every: int | None = None) -> ReplayInput:
    """``late_every``: each so many-th event id arrives one batch, so ``days_per_batch`` days, late."""
    a = V.ad_log(spark, base_dir)
    lo, hi = a.agg(F.min(F.col("ts").cast("date")), F.max(F.col("ts").cast("date"))).first()  # two scalars
    n = 0 if lo is None else (hi - lo).days // int(days_per_batch) + 1
    if not late_every:
        return ReplayInput(day_batches(a.select("ts", V.ad_line().alias("value")), days_per_batch, lo), n)
    lines = day_batches(a.select("ts", "event_id", V.ad_line().alias("value")), days_per_batch, lo)
    late = (F.col("event_id") % late_every == 0).cast("int")
    return ReplayInput(lines.withColumn(BATCH_COL, F.col(BATCH_COL) + late).drop("event_id"), n + 1)


def stage(lines: DataFrame, staging_dir: str, batch_col: str = BATCH_COL) -> None:
    """All lines in one parallel write, partitioned by batch."""
    lines.select(batch_col, "value").write.partitionBy(batch_col).text(staging_dir)


def replay(spark: SparkSession, staging_dir: str, source_dir: str, n_batches: int,
           triggers: list[Callable[[], None]], batch_col: str = BATCH_COL) -> None:
    """For each batch in order: append it to ``source_dir/<id>/`` and run every
    trigger once (each trigger runs one query to completion on the new files)."""
    staged = spark.read.text(staging_dir)
    for i in range(int(n_batches)):
        staged.where(F.col(batch_col) == i).select("value").write.text(f"{source_dir}/{i:06d}")
        for run in triggers:
            run()


def _files(spark: SparkSession, folder: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [x.getPath().getName() for x in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    return sum(not n.startswith(("_", ".")) for n in names)


@contextmanager
def state_partitions(spark: SparkSession, most_lines: int, least: int = 4) -> Iterator[None]:
    """Queries started inside keep their state in partitions for batches of up to ``most_lines`` lines, not more than the session's shuffle partitions."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), max(least, -(-int(most_lines) // LINES_PER_PARTITION)))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def replay_in_one_run(spark: SparkSession, staging_dir: str, source_dir: str, n_batches: int,
                      queries: list[Callable[[int], None]], files: int = 4, batch_col: str = BATCH_COL) -> None:
    """Append every batch to ``source_dir/<id>/`` as ``files`` files, in order, then run each query once to completion.

    A query is called with the number of files per trigger; the file source takes files by age, so a trigger takes
    exactly one batch. Batches too small to fill so many files are written as one file each.
    """
    staged = spark.read.text(staging_dir)
    least, most, filled = staged.groupBy(batch_col).count().agg(F.min("count"), F.max("count"), F.count("*")).first()  # three scalars
    if filled < n_batches or least < 64 * files:
        files = 1
    for i in range(int(n_batches)):
        folder = f"{source_dir}/{i:06d}"
        staged.where(F.col(batch_col) == i).select("value").repartition(files).write.text(folder)
        if _files(spark, folder) != files:
            raise RuntimeError(f"{folder} has not {files} files")
    with state_partitions(spark, most or 0):
        for run in queries:
            run(files)
