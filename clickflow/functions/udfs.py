"""The reference's UDF / UDAF, as built-in expressions.

* ``concat_long_string(long, string, sep)``: nulls render as ``null``.
* ``json_field(json, field)``: a top-level field by plain name; null on bad JSON.
  (The builtin ``get_json_object`` needs a ``$.`` path; it is not shadowed.)
* ``group_concat_distinct(x)``: distinct values, sorted, joined with ``,``.
  Built from ``collect_set`` so it aggregates partially before the shuffle.

``register_sql_functions`` exposes the two scalar ones as session SQL
functions (SQL-bodied, so they stay inside codegen, no Python worker).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def concat_long_string(a, b, sep: str = ":") -> Column:
    return F.concat(F.coalesce(_c(a).cast("string"), F.lit("null")), F.lit(sep),
                    F.coalesce(_c(b).cast("string"), F.lit("null")))


def json_field(js, field: str) -> Column:
    return F.get_json_object(_c(js), f"$.{field}")


def group_concat_distinct(x, sep: str = ",") -> Column:
    return F.array_join(F.array_sort(F.collect_set(_c(x).cast("string"))), sep)


def register_sql_functions(spark: SparkSession) -> None:
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(a BIGINT, b STRING, sep STRING) "
        "RETURNS STRING RETURN concat(coalesce(cast(a AS STRING), 'null'), sep, coalesce(b, 'null'))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION json_field(js STRING, field STRING) "
        "RETURNS STRING RETURN get_json_object(js, concat('$.', field))"
    )
