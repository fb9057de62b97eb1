"""SparkSession construction and the few settings every operator relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library assumes. Times in the data are UTC wall-clock values;
# epoch-millisecond conversions (ad log) depend on the session time zone.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Joins against dimension tables are left to the planner: a side is broadcast
# only when its estimated size is under this threshold (a checked size), and
# AQE may still switch to broadcast at runtime once a shuffle stage has measured
# the real size. Explicit broadcast() hints are used only for results whose row
# count is bounded by a parameter (top-k lists, page flows, sample sizes).
BROADCAST_THRESHOLD = str(32 * 1024 * 1024)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "clickflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster ``master`` stays None and spark-submit decides; tests and the
    bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # PySpark captures a Python call site (several JVM round trips) for every
    # Column function when this is on; plans here build hundreds of columns.
    conf["spark.python.sql.dataFrameDebugging.enabled"] = "false"
    conf["spark.sql.autoBroadcastJoinThreshold"] = BROADCAST_THRESHOLD
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_defaults(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators depend on (idempotent)."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it is set by the deployment and read here (an unset value
    is an error there). Only in local mode, when it is unset (tests), do we
    create one under the system temp folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        # a machine-local folder is only valid when driver and executors
        # share the machine; a cluster must name a shared folder
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
        root = tempfile.mkdtemp(prefix="clickflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/clickflow/{name}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return path
