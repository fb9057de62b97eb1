"""Running totals of the ad stream kept in Spark's state store (A3, A5).

``gated`` is the stateful part of the ad task as one streaming frame:

1. ``_counted``: every task counts its own clicks per (user, day, ad, province, city, minute), so that a hot user, province or
   ad sends a few rows per task to the next step;
2. ``ClickGate``, keyed by user: drops the clicks of a listed user; adds the others to the user's counts per (day, ad); a user
   whose count reaches the threshold is listed, which takes effect with the next micro-batch. The counts of a listed user
   are dropped, as nothing asks for them any more;
3. ``TopAds``, keyed by (day, province): adds the kept clicks to the totals per ad and gives the new ranking of every group that
   the batch touched. Totals only grow, so the new top n lie among the old ones and the ads that changed: the totals of other
   ads are not read.

A micro-batch reads the state of its own users and groups and none of the stores; failures roll the state back with the batch.
Rows leave as ``ROWS``, told apart by ``kind``: ``click`` (counted clicks that were kept), ``listed``, ``top``, ``reject`` (lines without a
readable time). Rows that a step only passes on are dealt by a hash, in ``PARTS`` parts.

Cases: clicks without a user are kept and their (missing) user may be listed without any effect; a null ad, province or city is a value of its own;
a late click counts for its day however late it comes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROWS = ("kind string, part int, user_id bigint, date date, ad_id bigint, province string, city string, "
        "minute timestamp_ntz, n bigint, value string")
_NAMES = [c.split()[0] for c in ROWS.split(", ")]
_CLICK = ["user_id", "date", "ad_id", "province", "city", "minute"]
PARTS = 64


def _summed(table: pa.Table, keys: list[str]) -> pa.Table:
    return table.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])


def _shaped(table: pa.Table, schema: pa.Schema, **constants) -> Iterator[pa.RecordBatch]:
    """``table`` with the columns of ``schema``; those it lacks are constants or null."""
    if table.num_rows:
        cols = [table[f.name].cast(f.type) if f.name in table.column_names else pa.array([constants.get(f.name)] * table.num_rows, f.type) for f in schema]
        yield from pa.table(cols, schema=schema).combine_chunks().to_batches()


def _counted(parsed: DataFrame) -> DataFrame:
    """``ROWS`` of parsed clicks (with ``value``), counted within each task; lines without a time stay rows of their own."""
    lost = F.col("date").isNull()
    rows = parsed.select(
        F.when(lost, "reject").otherwise("click").alias("kind"), F.when(lost, F.pmod(F.xxhash64("value"), F.lit(PARTS))).cast("int").alias("part"),
        "user_id", "date", "ad_id", "province", "city", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute"),
        F.lit(1).cast("bigint").alias("n"), F.when(lost, F.col("value")).alias("value"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            clicks = pc.equal(table["kind"], "click")
            yield from _shaped(_summed(table.filter(clicks), _CLICK), batch.schema, kind="click")
            yield from table.filter(pc.invert(clicks)).combine_chunks().to_batches()

    return rows.mapInArrow(task, ROWS)


class ClickGate(StatefulProcessor):
    """Per user: the clicks that count, the counts per (day, ad), and whether the user is listed."""

    def __init__(self, threshold: int):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.listed = handle.getValueState("listed", "v boolean")
        self.counts = handle.getMapState("counts", "day date, has_ad boolean, ad bigint", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        user, part = key
        if part is not None:  # rejects
            yield from rows
            return
        if user is not None and self.listed.exists():
            return
        added: dict[tuple, int] = {}
        for r in rows:
            at = (r.date, r.ad_id is not None, r.ad_id or 0)
            added[at] = added.get(at, 0) + r.n
            yield r
        reached = False
        for at, n in added.items():
            old = self.counts.getValue(at)
            n += old[0] if old else 0
            self.counts.updateValue(at, (n,))
            reached |= n >= self.threshold
        if reached:
            if user is not None:
                self.listed.update((True,))
                self.counts.clear()
            yield Row(kind="listed", part=None, user_id=user, date=None, ad_id=None, province=None, city=None, minute=None, n=None, value=None)

    def close(self) -> None:
        pass


_KEYED = ROWS + ", k_date date, k_province string, k_part int"


def _by_group(rows: DataFrame) -> DataFrame:
    """``rows`` with the keys of the next step: counts per (day, province, ad), summed within each task, go to their group, all rows go to parts."""
    parts = F.coalesce("part", F.pmod(F.xxhash64("user_id", "minute"), F.lit(PARTS)).cast("int"))
    keyed = rows.select(*_NAMES, F.lit(None).cast("date").alias("k_date"), F.lit(None).cast("string").alias("k_province"), parts.alias("k_part"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            table = pa.Table.from_batches([batch])
            sums = _summed(table.filter(pc.equal(table["kind"], "click")), ["date", "province", "ad_id"])
            sums = sums.append_column("k_date", sums["date"]).append_column("k_province", sums["province"])
            yield from _shaped(sums, batch.schema, kind="group", k_part=-1)

    return keyed.mapInArrow(task, _KEYED)


class TopAds(StatefulProcessor):
    """Per (day, province): the totals per ad and the ``n`` ads with most clicks, the smallest id first among equals."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getMapState("totals", "has_ad boolean, ad bigint", "n bigint")
        self.top = handle.getMapState("top", "has_ad boolean, ad bigint", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        date, province, part = key
        if part >= 0:  # nothing to rank
            for r in rows:
                yield Row(*_NAMES)(*(r[c] for c in _NAMES))
            return
        added: dict[tuple, int] = {}
        for r in rows:
            ad = (r.ad_id is not None, r.ad_id or 0)
            added[ad] = added.get(ad, 0) + r.n
        ranked = {tuple(ad): n[0] for ad, n in self.top.iterator()}
        before = set(ranked)
        for ad, n in added.items():
            old = self.totals.getValue(ad)
            ranked[ad] = n + (old[0] if old else 0)
            self.totals.updateValue(ad, (ranked[ad],))
        best = sorted(ranked, key=lambda ad: (-ranked[ad], ad))[:self.n]
        for ad in before.difference(best):
            self.top.removeKey(ad)
        for has, ad in best:
            self.top.updateValue((has, ad), (ranked[has, ad],))
            yield Row(kind="top", part=None, user_id=None, date=date, ad_id=ad if has else None, province=province, city=None, minute=None, n=ranked[has, ad], value=None)

    def close(self) -> None:
        pass


def gated(parsed: DataFrame, threshold: int, top_n: int) -> DataFrame:
    """``ROWS`` of a streaming frame of parsed clicks with their lines (``ads.parse_ad_log(..., keep_value=True)``).

    Needs the RocksDB state store (``ad_stream.rocksdb_state``) and output mode ``append``.
    """
    kept = _counted(parsed).groupBy("user_id", "part").transformWithState(ClickGate(int(threshold)), ROWS, "Append", "None")
    return _by_group(kept).groupBy("k_date", "k_province", "k_part").transformWithState(TopAds(int(top_n)), ROWS, "Append", "None")
