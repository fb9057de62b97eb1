"""Real-time ad click statistics on Structured Streaming (ad task, T4).

Source (S6): any streaming frame with a ``value`` text column in the ad log
format; ``text_source`` builds one from a folder of log files. In
production the same operators take a message-bus source's ``value``.

The stateful part (``click_state.gated``) runs before the sinks, inside the streaming query:
  P8  clicks of users that an earlier batch listed are dropped;
  A3  counts per (user, day, ad); users that reach the threshold are listed,
      which takes effect with the next batch;
  A5  totals per (day, province, ad) and the new top-n of touched groups.
Counts, lists and totals are state, rolled back and restored with the batch: no
batch reads what earlier batches wrote.

Per micro-batch (``foreachBatch``, A1) the rows go to the stores:
  A2  clicks per (date, user, ad) -> increment log (K3);
  A3  newly listed users -> blacklist log;
  A4  clicks per (date, province, city, ad) -> increment log: the running
      total per key, as the reference's never-expiring state;
  A5  the new top-n -> replace-group log (K4);
  A6  clicks per (event minute, ad) -> increment log.
Each log write replaces its own ``batch_id`` folder, so a replayed batch
after a failure gives the same store (exactly once). The batch's rows are
written once beside the stores and read by the writes, which run as concurrent
jobs: their tasks carry neither the stateful plan nor its state metrics, of
which every task would send each one to the driver.

Lines without a readable time belong to no day: they are counted and kept in
the reject log and take no part in the branches.

``stateful_ad_stat`` / ``windowed_trend`` are the pure Structured Streaming
forms of A4 / A6 / A7 (state store, no watermark) for pipelines that need no
blacklist feedback.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators import ads
from clickflow.sinks.batch_log import BatchLog
from clickflow.streaming import click_state

USER_CLICK_SCHEMA = "user_id bigint, ad_id bigint, click_count bigint, date date"
BLACKLIST_SCHEMA = "user_id bigint"
STAT_SCHEMA = "province string, city string, ad_id bigint, click_count bigint, date date"
TOP_SCHEMA = "province string, ad_id bigint, click_count bigint, date date"
TREND_SCHEMA = "minute timestamp_ntz, ad_id bigint, click_count bigint"
TREND_STORE_SCHEMA = f"{TREND_SCHEMA}, date date"
REJECT_SCHEMA = "value string"

USER_KEYS = ["date", "user_id", "ad_id"]
STAT_KEYS = ["date", "province", "city", "ad_id"]
GROUP_KEYS = ["date", "province"]


def text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming frame with ``value`` from text files under ``path``.
    Without ``max_files_per_trigger`` a trigger takes every file that arrived
    since the previous one."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path)


def kafka_source(spark: SparkSession, bootstrap_servers: str, topics: str,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S6 in production: the ad log topics (comma-separated) of a message bus
    as a streaming frame with ``value`` text. Needs Spark's Kafka connector
    package on the classpath (``spark.jars.packages``); without it, this
    raises an error naming the missing connector."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topics).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    try:
        df = r.load()
    except Exception as ex:  # noqa: BLE001 - re-raised with the cause attached
        if "kafka" in str(ex).lower():
            raise RuntimeError("the Kafka source needs Spark's Kafka connector package on the classpath "
                               "(spark.jars.packages); use text_source for files") from ex
        raise
    return df.selectExpr("CAST(value AS STRING) AS value")


@contextmanager
def adaptive(session: SparkSession):
    """Adaptive execution inside a micro-batch's function; Spark turns it off in the session of a stateful query, for the stateful part's sake."""
    key = "spark.sql.adaptive.enabled"
    before = session.conf.get(key)
    session.conf.set(key, "true")
    try:
        yield
    finally:
        session.conf.set(key, before)


class AdClickStats:
    """The per-batch logic of the ad task and the stores it maintains."""

    def __init__(self, spark: SparkSession, out_root: str, threshold: int = 100, top_n: int = 3,
                 batches_per_generation: int = 720):
        """``batches_per_generation``: batches after which every store reduces
        the dates that these batches touched (720 = one hour of 5 s batches),
        so upkeep and reads of a day stay bounded however long the stream runs."""
        self.spark = spark
        self.threshold = int(threshold)
        self.top_n = int(top_n)
        root = out_root.rstrip("/")
        self.batch_rows = f"{root}/batch_rows"
        e = int(batches_per_generation)
        self.user_clicks = BatchLog(spark, f"{root}/ad_user_click_count", USER_CLICK_SCHEMA, ("date",),
                                    lambda lg, df: lg.increments(USER_KEYS, "click_count", df), e)
        self.blacklist = BatchLog(spark, f"{root}/ad_blacklist", BLACKLIST_SCHEMA, (),
                                  lambda lg, df: df.select("user_id").distinct(), e)
        self.stat = BatchLog(spark, f"{root}/ad_stat", STAT_SCHEMA, ("date",),
                             lambda lg, df: lg.increments(STAT_KEYS, "click_count", df), e)
        self.province_top = BatchLog(spark, f"{root}/ad_province_top3", TOP_SCHEMA, ("date",),
                                     lambda lg, df: lg.replace_group(GROUP_KEYS, df), e)
        self.trend = BatchLog(spark, f"{root}/ad_click_trend", TREND_STORE_SCHEMA, ("date",),
                              lambda lg, df: lg.increments(["date", "minute", "ad_id"], "click_count", df), e)
        self.rejects = BatchLog(spark, f"{root}/ad_rejects", REJECT_SCHEMA, (),
                                lambda lg, df: df.select("value"), e)

    # ---------------------------------------------------------------- per batch
    def rows(self, lines: DataFrame) -> DataFrame:
        """The stateful part on a streaming frame of text lines."""
        return click_state.gated(ads.parse_ad_log(lines, keep_value=True), self.threshold, self.top_n)

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """One micro-batch's rows into the stores; only these rows are read."""
        session = rows.sparkSession
        owner = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        kept = f"{self.batch_rows}/{int(batch_id)}"
        rows.write.mode("overwrite").parquet(kept)  # the state is advanced by this one job; the writes below share what it kept
        try:
            rows = session.read.schema(rows.schema).parquet(kept)
            clicks = rows.where(F.col("kind") == "click")

            def summed(*keys):
                return clicks.groupBy(*keys).agg(F.sum("n").cast("bigint").alias("click_count"))

            def of_kind(kind):
                return rows.where(F.col("kind") == kind)

            writes = [
                (self.user_clicks, summed(*USER_KEYS)),  # A2
                (self.blacklist, of_kind("listed").select("user_id")),  # A3
                (self.stat, summed(*STAT_KEYS)),  # A4
                (self.province_top, of_kind("top").select("province", "ad_id", F.col("n").alias("click_count"), "date")),  # A5
                (self.trend, summed("date", "minute", "ad_id")),  # A6
                (self.rejects, of_kind("reject").select("value")),
            ]
            # Every write reads only the kept batch and replaces its own
            # batch folder: a failed one fails the batch, and the retry
            # rewrites the same folders from the same rows.
            # The threads inherit the query's job group: stopping it stops them.
            with adaptive(session), ThreadPoolExecutor(max_workers=len(writes)) as pool:
                jobs = [pool.submit(inheritable_thread_target(session)(store.write), df, batch_id, owner) for store, df in writes]
                for job in jobs:
                    job.result()
        finally:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(kept)
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    # ---------------------------------------------------------------- views
    def user_click_view(self) -> DataFrame:
        return self.user_clicks.increments(USER_KEYS, "click_count")

    def blacklist_view(self) -> DataFrame:
        return self.blacklist.read().select("user_id").distinct()

    def stat_view(self) -> DataFrame:
        return self.stat.increments(STAT_KEYS, "click_count")

    def province_top_view(self) -> DataFrame:
        return self.province_top.replace_group(GROUP_KEYS)

    def reject_view(self) -> DataFrame:
        return self.rejects.read().select("value")

    def trend_view(self, last_minutes: int | None = None) -> DataFrame:
        """Clicks per minute and ad; ``last_minutes`` keeps the trailing span
        ending at the greatest minute seen (the reference's last hour)."""
        t = self.trend.increments(["minute", "ad_id"], "click_count")
        if last_minutes:
            newest = self.trend.read().agg(F.max("minute")).scalar()  # a scalar subquery of the view
            t = t.where(F.col("minute") > newest - F.expr(f"INTERVAL {int(last_minutes)} MINUTES"))
        return t

    # ---------------------------------------------------------------- driver
    def start(self, lines: DataFrame, checkpoint: str, trigger: dict | None = None, query_name: str | None = None):
        """A1: run the per-batch logic on a streaming frame of text lines.
        Production: ``trigger={"processingTime": "5 seconds"}``; replay:
        ``{"availableNow": True}``."""
        with rocksdb_state(self.spark):
            w = self.rows(lines).writeStream.outputMode("append").foreachBatch(self.write_batch).option("checkpointLocation", checkpoint)
            w = w.trigger(**(trigger or {"processingTime": "5 seconds"}))
            if query_name:
                w = w.queryName(query_name)
            return w.start()

    def run_available(self, lines: DataFrame, checkpoint: str) -> None:
        """One ``availableNow`` run: process what arrived since the last run, then stop."""
        self.start(lines, checkpoint, {"availableNow": True}).awaitTermination()


PARSED_SCHEMA = "ts timestamp, province string, city string, user_id bigint, ad_id bigint, date date"


class FilteredClicks:
    """The stream's clicks minus the users on a list kept in storage.

    The list is looked up again in every micro-batch (a stream-static join whose
    static side may change between batches). A batch pins the files that make
    up the list under its batch id before it reads them, so a retried batch sees
    the same list as its first attempt, whatever was appended in between. The
    list's files must stay: it may be appended to, not rewritten in place. The
    kept rows are appended to a batch log (K1, retry-safe per batch id)
    partitioned by date.
    """

    def __init__(self, spark: SparkSession, list_path: str, out_path: str):
        self.spark = spark
        self.list_path = list_path
        self.out = BatchLog(spark, out_path, PARSED_SCHEMA, ("date",))
        self.pins = f"{out_path.rstrip('/')}/_list_versions"

    def _list_as_of(self, batch_id: int) -> DataFrame:
        """The list as the first attempt of this batch found it."""
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        pin = f"{self.pins}/{int(batch_id)}"
        done = jvm.org.apache.hadoop.fs.Path(f"{pin}/_SUCCESS")
        if not done.getFileSystem(conf).exists(done):
            folder = jvm.org.apache.hadoop.fs.Path(self.list_path)
            names = [x.getPath().toString() for x in folder.getFileSystem(conf).listStatus(folder) if not x.getPath().getName().startswith(("_", "."))]
            self.spark.createDataFrame([(n,) for n in sorted(names)], "value string").coalesce(1).write.mode("overwrite").text(pin)
        files = [r["value"] for r in self.spark.read.schema("value string").text(pin).collect()]  # a name per file of the list
        return self.spark.read.schema(BLACKLIST_SCHEMA).parquet(*files) if files else self.spark.createDataFrame([], BLACKLIST_SCHEMA)

    def process_batch(self, lines: DataFrame, batch_id: int) -> None:
        owner = lines.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        kept = ads.remove_blacklisted(ads.parse_ad_log(lines), self._list_as_of(batch_id))
        self.out.write(kept.select("ts", "province", "city", "user_id", "ad_id", "date"), batch_id, owner)

    def run_available(self, lines: DataFrame, checkpoint: str) -> None:
        (lines.writeStream.foreachBatch(self.process_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())

    def view(self) -> DataFrame:
        return self.out.read().drop("batch_id")


ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (off the JVM heap): the state of the forms below never expires."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB_STATE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stateful_ad_stat(parsed: DataFrame) -> DataFrame:
    """A4 with the state store: running clicks per (date, province, city, ad).

    There is no watermark: a click counts however late it comes, as in the
    reference, whose state never expires. The state is one row per key; use
    ``rocksdb_state`` and output mode ``update`` with an upsert sink
    (``BatchLog.latest``)."""
    return parsed.groupBy("date", "province", "city", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def pane_counts(parsed: DataFrame, pane_seconds: int) -> DataFrame:
    """A7 as a stream: running clicks per (pane, ad), one state row each, whatever the window and the slide;
    ``ads.windows_of_panes`` reads the windows off the stored counts. No click is too late."""
    pane = ads.pane_of(F.col("ts"), pane_seconds)
    return (parsed.where(F.col("ts").isNotNull()).groupBy(F.col("date"), pane.alias("slot"), "ad_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def windowed_trend(parsed: DataFrame, window: str = "1 minute", slide: str | None = None) -> DataFrame:
    """A6 (tumbling) / A7 (sliding) clicks per event-time window and ad; as above, no click is too late."""
    ts = F.col("ts").cast("timestamp")
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (parsed.groupBy(w.alias("window"), "ad_id").agg(F.count(F.lit(1)).alias("click_count"))
            .select(F.col("window.start").cast("timestamp_ntz").alias("minute"), "ad_id", "click_count"))
