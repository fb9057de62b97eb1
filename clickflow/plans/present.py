"""Final projection for registered queries: engine-neutral output types.

Dates become ``yyyy-MM-dd`` strings, timestamps ``yyyy-MM-dd HH:mm:ss``
strings and arrays comma-joined strings, so results compare value for value
with other engines (the reference itself stores all of these as strings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions.dates import DATE_FORMAT, TIME_FORMAT


def present(df: DataFrame, as_text: tuple[str, ...] = ()) -> DataFrame:
    """``as_text``: nullable integer columns rendered as strings, so a null is
    the same value in every client library (no float/NaN conversion)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, DATE_FORMAT)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TIME_FORMAT)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif f.name in as_text:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)
