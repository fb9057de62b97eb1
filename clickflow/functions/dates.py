"""Date and time column functions (all JVM-side, codegen friendly).

Formats used by the reference (fixed values):
  time      yyyy-MM-dd HH:mm:ss
  date      yyyy-MM-dd
  date key  yyyyMMdd
  minute    yyyyMMddHHmm
  date_hour yyyy-MM-dd_HH
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATEKEY_FORMAT = "yyyyMMdd"
MINUTE_FORMAT = "yyyyMMddHHmm"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_hour(ts) -> Column:
    """``yyyy-MM-dd_HH`` key of a timestamp (or of a time string)."""
    return F.date_format(_c(ts), DATE_HOUR_FORMAT)


def format_time(ts) -> Column:
    return F.date_format(_c(ts), TIME_FORMAT)


def format_date(ts) -> Column:
    return F.date_format(_c(ts), DATE_FORMAT)


def format_datekey(ts) -> Column:
    return F.date_format(_c(ts), DATEKEY_FORMAT)


def format_minute(ts) -> Column:
    return F.date_format(_c(ts), MINUTE_FORMAT)


def parse_time(s) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` string to timestamp; null when it does not parse."""
    return F.try_to_timestamp(_c(s), F.lit(TIME_FORMAT))


def parse_datekey(s) -> Column:
    """``yyyyMMdd`` string to date; null when it does not parse."""
    return F.try_to_date(_c(s), DATEKEY_FORMAT)


def time_before(a, b) -> Column:
    """True when time string ``a`` is before ``b``; false if either fails to parse."""
    return F.coalesce(parse_time(a) < parse_time(b), F.lit(False))


def time_after(a, b) -> Column:
    return F.coalesce(parse_time(a) > parse_time(b), F.lit(False))


def time_minus_seconds(a, b) -> Column:
    """Whole seconds from ``b`` to ``a`` (a - b); 0 if either fails to parse."""
    return F.coalesce(F.timestamp_diff("SECOND", parse_time(b), parse_time(a)), F.lit(0).cast("bigint"))


def today_date() -> Column:
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday_date() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)


def date_part(ts) -> Column:
    """``yyyy-MM-dd`` of a timestamp."""
    return F.date_format(_c(ts), DATE_FORMAT)


def hour_part(ts) -> Column:
    """Hour of day as an unpadded string (``"2"``, ``"11"``)."""
    return F.hour(_c(ts)).cast("string")


def millis_to_timestamp(ms) -> Column:
    """Epoch milliseconds to a timestamp (interpreted in the session time zone, UTC)."""
    return F.timestamp_millis(_c(ms).cast("bigint"))
