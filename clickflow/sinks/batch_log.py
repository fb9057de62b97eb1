"""Sinks: append, and keyed upserts as a micro-batch log (K1-K5).

Without a table format, an upsert store is kept as a log of batches:
``<path>/batches/gen=<G>/batch_id=<N>/...parquet``. Writing batch N replaces
exactly that folder, so a retried micro-batch (same N) leaves the store
unchanged: exactly-once with plain parquet. Readers reduce the log:

* ``latest``      key exists -> overwrite value      (max_by value, batch_id)
* ``increments``  key exists -> value = value + delta (sum of deltas)
* ``replace_group`` delete a group's rows, insert the batch's (rows of the
  greatest batch_id per group)

All three reductions are partial/final aggregates or a join against one,
so they scale with the number of keys, not with a single task.

Generations bound upkeep and reads, however old the store is. With
``batches_per_generation=E`` and a ``reduce`` function (one of the views
above), the first write of generation G = N div E first reduces what
generation G-1 wrote:

* a store laid out by a partition column (``date``) rewrites the bases of the
  dates that generation G-1 touched, and only those:
  ``bases/gen=<G>/date=<D>`` holds date D up to batch G*E-1, and the empty file
  ``manifest/date=<D>/<G>`` says so. Other dates keep the base they have;
* a store without one writes the reduced rows of generation G-1 alone to
  ``bases/gen=<G>``; older bases are never touched again.

A read takes the newest base of each date (or all bases) and the current
generation's batches, at most E folders; ``days`` limits both to some dates.
A base is rebuilt from folders that no longer change, so a retried first
batch rewrites the same one. A generation becomes current by an empty file
``_generations/<G>``, made once its first batch is written and never changed
or removed; the greatest one counts. A generation that holds more than its
first batch without such a file, or a marked one that can't be read, is an
error, never an empty or older answer. A store reads as empty only before its
first batch.

Batch ids restart with a new streaming checkpoint, so one log belongs to one
query: the first write with an owner (the query's id, which a restart from its
checkpoint keeps) names it in ``_owner/``, and any other owner is refused.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_COL = "batch_id"
#: The folder value of rows without a value in the partition column (a fixed value of the file layout).
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K1: insert all rows."""
    df.write.mode("append").format(fmt).save(path)


def append_jdbc(df: DataFrame, url: str, table_name: str, properties: dict | None = None,
                batch_size: int = 1000) -> None:
    """K1 to a relational table; rows are inserted in batches per partition."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    df.write.jdbc(url, table_name, mode="append", properties=props)


class BatchLog:
    def __init__(self, spark: SparkSession, path: str, schema: str, partition_cols: tuple[str, ...] = (),
                 reduce: Callable[["BatchLog", DataFrame], DataFrame] | None = None,
                 batches_per_generation: int | None = None):
        """``partition_cols``: none, or one column whose values a read or an upkeep can leave out."""
        if batches_per_generation and reduce is None:
            raise ValueError("generations need a reduce function")
        if len(partition_cols) > 1:
            raise ValueError("a store is laid out by one column at most")
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_cols = tuple(partition_cols)
        self.reduce = reduce
        self.per_gen = int(batches_per_generation) if batches_per_generation else None
        self.columns = [c.split()[0] for c in schema.split(",")]

    # ---------------------------------------------------------------- layout
    def generation_of(self, batch_id: int) -> int:
        return int(batch_id) // self.per_gen if self.per_gen else 0

    def _names(self, folder: str) -> list[str]:
        """Names in a folder of the store; none if it isn't there."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []

    def _mark(self, folder: str, name: str) -> None:
        """An empty file; nothing happens if it is there."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}/{name}")
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(p)

    def _numbers(self, folder: str, prefix: str = "") -> list[int]:
        return sorted(int(n[len(prefix):]) for n in self._names(folder) if n.startswith(prefix) and n[len(prefix):].isdigit())

    def current_generation(self) -> int | None:
        """The newest complete generation; None before the first batch."""
        marked, begun = (max(x, default=None) for x in (self._numbers("_generations"), self._numbers("batches", "gen=")))
        if begun is not None and (marked is None or begun > marked):
            # its first batch may be on its way; anything later was written after the marker
            first = begun * self.per_gen if self.per_gen else 0
            if begun > (-1 if marked is None else marked) + 1 or any(b > first for b in self._numbers(f"batches/gen={begun}", f"{BATCH_COL}=")):
                raise RuntimeError(f"{self.path}: generation {begun} has batches but no marker")
        return marked

    def _base_folders(self, gen: int, days: list[str] | None = None) -> list[str]:
        """The folders that hold the rows before generation ``gen``: the newest base of each date, or all bases."""
        if not self.partition_cols:
            return [f"gen={g}" for g in self._numbers("bases", "gen=") if g <= gen]
        col = self.partition_cols[0]
        dates = [n for n in self._names("manifest") if days is None or n in {f"{col}={d}" for d in days}]
        newest = {d: max((g for g in self._numbers(f"manifest/{d}") if g <= gen), default=None) for d in dates}
        return [f"gen={g}/{d}" for d, g in sorted(newest.items()) if g is not None]

    def _touched(self, gen: int) -> list[str]:
        """Dates (as their folders' values) that the batches of a generation hold rows of."""
        prefix = f"{self.partition_cols[0]}="
        return sorted({n[len(prefix):] for b in self._names(f"batches/gen={gen}") for n in self._names(f"batches/gen={gen}/{b}") if n.startswith(prefix)})

    # ---------------------------------------------------------------- write
    def _write_folder(self, df: DataFrame, folder: str) -> None:
        w = df.select(*self.columns).write.mode("overwrite")
        if self.partition_cols:
            w = w.partitionBy(*self.partition_cols)
        w.parquet(f"{self.path}/{folder}")

    def _compact(self, gen: int) -> None:
        """The bases of generation ``gen``, from what the generation before it wrote."""
        if not self.partition_cols:
            self._write_folder(self.reduce(self, self._batches(gen - 1)), f"bases/gen={gen}")
            return
        days = self._touched(gen - 1)
        if days:
            self._write_folder(self.reduce(self, self.read(gen - 1, days)), f"bases/gen={gen}")
            for d in days:
                self._mark(f"manifest/{self.partition_cols[0]}={d}", str(gen))

    def write(self, df: DataFrame, batch_id: int, owner: str | None = None) -> None:
        """Replace batch ``batch_id`` with ``df`` (idempotent)."""
        if owner:
            known = self._names("_owner")
            if known and known != [owner]:
                raise RuntimeError(f"{self.path} belongs to the streaming query {known}, not to {owner}")
            self._mark("_owner", owner)
        gen = self.generation_of(batch_id)
        first = gen > 0 and int(batch_id) % self.per_gen == 0
        if first:
            self._compact(gen)
        self._write_folder(df, f"batches/gen={gen}/{BATCH_COL}={int(batch_id)}")
        if gen == 0 or first:
            self._mark("_generations", str(gen))

    # ---------------------------------------------------------------- read
    def empty(self) -> DataFrame:
        return self.spark.createDataFrame([], f"{self.schema}, {BATCH_COL} bigint")

    def _batches(self, gen: int) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, {BATCH_COL} bigint").parquet(f"{self.path}/batches/gen={gen}")

    def read(self, generation: int | None = None, days: list[str] | None = None) -> DataFrame:
        """All rows as of a generation (default: the current one) with a ``batch_id`` column (of a base: the last
        batch in it); an empty frame before the first batch. ``days``: only these values of the partition column."""
        gen = self.current_generation() if generation is None else int(generation)
        if gen is None:
            return self.empty()
        rows = self._batches(gen)
        if days is not None:
            col = self.partition_cols[0]
            known = [d for d in days if d != NO_VALUE]
            rows = rows.where(F.col(col).cast("string").isin(known) | (F.col(col).isNull() if NO_VALUE in days else F.lit(False)))
        bases = self._base_folders(gen, days)
        if not bases:
            return rows
        old = self.spark.read.schema(f"{self.schema}, gen bigint").option("basePath", f"{self.path}/bases").parquet(*[f"{self.path}/bases/{b}" for b in bases])
        old = old.withColumn(BATCH_COL, F.col("gen") * self.per_gen - 1).drop("gen")
        return rows.unionByName(old)

    def latest(self, keys: list[str], value: str, log: DataFrame | None = None) -> DataFrame:
        """K2: per key, the value of its latest batch."""
        log = self.read() if log is None else log
        return log.groupBy(*keys).agg(F.max_by(value, BATCH_COL).alias(value))

    def increments(self, keys: list[str], value: str, log: DataFrame | None = None) -> DataFrame:
        """K3: per key, the sum of all deltas."""
        log = self.read() if log is None else log
        return log.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value))

    def replace_group(self, group_keys: list[str], log: DataFrame | None = None) -> DataFrame:
        """K4: rows of the latest batch that wrote each group."""
        log = self.read() if log is None else log
        last = log.groupBy(*group_keys).agg(F.max(BATCH_COL).alias(BATCH_COL))
        return log.join(last, [*group_keys, BATCH_COL], "left_semi").drop(BATCH_COL)

    def lookup(self, wanted: DataFrame, keys: list[str], value: str, log: DataFrame | None = None) -> DataFrame:
        """K5: the cumulative value of every key that matches a row of ``wanted`` (on all its columns); absent keys have none."""
        log = self.read() if log is None else log
        return self.increments(keys, value, log.join(wanted, wanted.columns, "left_semi"))
