"""External sources: relational tables over JDBC.

The reference reads ``city_info`` from a relational database. Spark's JDBC
reader pushes filters and the column list into the generated SELECT; with
``partition_column`` and bounds the scan is split into ``num_partitions``
range queries that run in parallel on the executors (without them it is a
single task, acceptable only for small dimension tables).

No database is started by this library or its tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table_name: str, user: str | None = None,
              password: str | None = None, driver: str | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 10000) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table_name) \
        .option("fetchsize", str(fetch_size))
    if user is not None:
        r = r.option("user", user)
    if password is not None:
        r = r.option("password", password)
    if driver is not None:
        r = r.option("driver", driver)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions)))
    return r.load()
