"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.session import checkpoint_root

#: Characters of text that a task turns into Python or numpy objects at once; bounds a worker's memory whatever the Arrow batch holds.
CHUNK_CHARS = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to a new table in the shared checkpoint folder and read back: cuts the lineage, survives lost executors."""
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a table that ``saved`` wrote and that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def id_crc(col: str) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` characters of ``text`` each, or one row."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start, base = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, base = stop, ends[stop - 1]


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return [x or "" for x in batch.column(text).to_pylist()]


def give_back() -> None:
    """What this process has freed goes back to the system; allocators would keep it, and an executor's workers live on between tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task`` for ``mapInArrow``, with ``give_back`` at its end: a worker does not carry a stage's memory into the next ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int,
                    id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """(id, text, label) of at most ``per_class`` training rows of each label, drawn by the id's hash, and how many rows each label has.

    Rows with a null id or label, and ids with two different labels, teach nothing. The chosen ids (at most
    2 * ``per_class`` of them, a bound that is a parameter) are broadcast; documents are never shuffled.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & train)
             .groupBy(F.col(id_col).alias("id")).agg(F.min(label).alias("lo"), F.max(label).alias("label"))
             .where("lo = label and label in (0, 1)").select("id", F.col("label").cast("int").alias("label")))
    sizes = {int(r[0]): int(r[1]) for r in known.groupBy("label").count().collect()}
    chosen = None
    for k in (0, 1):
        part = known.where(F.col("label") == k).orderBy(F.xxhash64("id", F.lit(17)), "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    return rows, sizes
