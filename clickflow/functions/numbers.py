"""Exact ratio rounding.

``round(n / d, 2)`` on doubles differs between engines (57/200 is 0.29 in
one and 0.28 in another). Counts are integers, so the half-up result is
computed on longs: ``(200 n + d) div (2 d)`` hundredths.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio2(n, d) -> Column:
    """n / d rounded half-up to 2 decimals for non-negative counts; null when d = 0."""
    if isinstance(n, str) and isinstance(d, str):  # one SQL expression, one JVM call
        n, d = f"CAST(`{n}` AS BIGINT)", f"CAST(`{d}` AS BIGINT)"
        return F.expr(f"CASE WHEN {d} <> 0 THEN ((200 * {n} + {d}) div (2 * {d})) / 100D END")
    n, d = _c(n).cast("bigint"), _c(d).cast("bigint")
    num, den = n * 200 + d, d * 2
    hundredths = ((num - num % den) / den).cast("bigint")  # exact integer division
    return F.when(d != 0, hundredths / F.lit(100.0))
