"""Parameter predicates of the session filter.

Rules of the reference, kept:
* a term whose parameter is missing passes everything (it is dropped from
  the plan, so Catalyst sees no predicate at all);
* a term whose data value is missing fails (null -> false).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickflow.sources.task_params import TaskParams


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def between(col, start, end) -> Column | None:
    """Inclusive range; None (no predicate) if either bound is missing."""
    if start is None or end is None:
        return None
    return F.coalesce(_c(col).between(F.lit(start), F.lit(end)), F.lit(False))


def in_values(col, values) -> Column | None:
    """P2 on a scalar column: the value equals one of the parameter tokens."""
    if not values:
        return None
    return F.coalesce(_c(col).isin(list(values)), F.lit(False))


def overlaps(arr_col, values, element_type: str = "string") -> Column | None:
    """P2 on a set column: any data token equals any parameter token."""
    if not values:
        return None
    vals = [str(v) for v in values] if element_type == "string" else integers(values)
    return F.coalesce(F.exists(_c(arr_col), lambda x: x.isin(vals)), F.lit(False))


def integers(tokens) -> list[int]:
    """The tokens that are numbers; any other matches no id."""
    return [int(t) for t in map(str, tokens) if re.fullmatch(r"-?[0-9]+", t)]


def equals(col, value) -> Column | None:
    """Equality; None if the parameter is missing."""
    if value is None:
        return None
    return F.coalesce(_c(col) == F.lit(value), F.lit(False))


def conjunction(*terms: Column | None) -> Column | None:
    out = None
    for t in terms:
        if t is None:
            continue
        out = t if out is None else (out & t)
    return out


def hit(col: str) -> Column:
    """A per-session ``bool_or`` of a P2 test (see ``sessions.session_aggregates``);
    a session without any value has null, which fails."""
    return F.coalesce(F.col(col), F.lit(False))


def session_filter(p: TaskParams, keyword_hit: str | None = None, category_hit: str | None = None) -> Column | None:
    """P4 over the session-with-user rows of ``sessions.full_session_aggregates``.

    With ``keyword_hit`` / ``category_hit`` (boolean columns aggregated per
    session) the two set-overlap terms test those instead of the collected
    keyword and category sets, so the sets need not be built at all when the
    output does not show them."""
    kw = hit(keyword_hit) if (p.keywords and keyword_hit) else overlaps("search_keywords", p.keywords, "string")
    cats = p.category_ids
    cat = hit(category_hit) if (cats and category_hit) else overlaps("click_category_ids", cats, "bigint")
    return conjunction(
        between("age", p.start_age, p.end_age),
        in_values("professional", p.professionals),
        in_values("city", p.cities),
        in_values("sex", p.sex),
        kw,
        cat,
    )
