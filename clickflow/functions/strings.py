"""String helpers: key=value records, comma lists, padding.

Delimiters of the reference's text records (fixed values): fields are joined
with ``|``, key and value with ``=``, list items with ``,``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELD_SEP = "|"
KV_SEP = "="
LIST_SEP = ","


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _parts(piece: Column) -> Column:
    return F.split(F.regexp_replace(piece, "=+$", ""), KV_SEP)


def kv_get(s, field: str) -> Column:
    """Value of ``field`` in ``k=v|k=v``; first match wins; an empty value is missing.

    Empty parts at the end of a piece don't count (``a=1=`` holds ``1``); a piece with two or more values is skipped."""
    pairs = F.transform(F.split(_c(s), r"\|"), _parts)
    hits = F.filter(pairs, lambda a: (F.size(a) == 2) & (a[0] == F.lit(field)))
    return F.try_element_at(F.try_element_at(hits, F.lit(1)), F.lit(2))


def kv_set(s, field: str, value) -> Column:
    """Replace the value of the first ``field`` in ``k=v|k=v`` (other pieces unchanged; empty pieces at the end go)."""
    v = _c(value).cast("string") if not isinstance(value, str) else F.lit(value)
    pieces = F.split(F.regexp_replace(_c(s), r"\|+$", ""), r"\|")
    first = F.array_position(F.transform(pieces, lambda x: _parts(x)[0]), F.lit(field))
    replaced = F.transform(pieces, lambda x, i: F.when(i + 1 == first, F.concat(F.lit(field + KV_SEP), v)).otherwise(x))
    return F.array_join(replaced, FIELD_SEP)


def trim_comma(s) -> Column:
    """Strip one leading and one trailing comma."""
    return F.regexp_replace(_c(s), r"^,|,$", "")


def pad2(s) -> Column:
    """Prefix ``0`` unless the string already has length 2."""
    c = _c(s).cast("string")
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def is_empty(s) -> Column:
    return F.coalesce(_c(s), F.lit("")) == F.lit("")


def split_ids(s) -> Column:
    """``"1,2,,3"`` to ``[1, 2, 3]``; empty tokens dropped; bad tokens become null."""
    toks = F.filter(F.split(_c(s), LIST_SEP), lambda x: x != F.lit(""))
    return F.transform(toks, lambda x: x.try_cast("bigint"))


def join_ids(arr) -> Column:
    """Array to the reference's comma list (empty array gives ``""``)."""
    return F.array_join(_c(arr).cast("array<string>"), LIST_SEP)
