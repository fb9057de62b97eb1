import datetime as dt
import random

from click_util import rows
from clickflow.operators import ads
from clickflow.operators import traffic as tr
from pyspark.sql import functions as F


def _log(spark, seed=3, n=300):
    r = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1, 22, 0)
    data = [(t0 + dt.timedelta(seconds=r.choice([r.randrange(9000), r.randrange(9000), 5 * 86400 + r.randrange(60)])), r.choice([1, 1, 1, 2, None])) for _ in range(n)]
    return spark.createDataFrame(data + [(dt.datetime(1969, 12, 31, 23, 59, 55), 7)], "ts timestamp_ntz, ad_id long")


def test_windows_of_panes_equal_the_window_function(spark):
    log = _log(spark)
    panes = log.groupBy(ads.pane_of(F.col("ts"), 10).alias("slot"), "ad_id").agg(F.count("*").alias("click_count"))
    for window, slide in ((60, 600), (60, 10), (30, 1800), (2, 20)):
        got = rows(ads.windows_of_panes(panes, 10, window, slide).select(F.col("window_start").cast("string"), F.col("window_end").cast("string"), "ad_id", "click_count"))
        want = rows(log.groupBy(F.window(F.col("ts").cast("timestamp"), f"{window} minutes", f"{slide} seconds"), "ad_id").count().select(
            F.col("window.start").cast("timestamp_ntz").cast("string"), F.col("window.end").cast("timestamp_ntz").cast("string"), "ad_id", "count"))
        assert got == want, (window, slide)


def test_global_ranks_with_ties_and_nulls(spark):
    r = random.Random(1)
    data = [(i, r.choice([None, 1.5, 2.5, float(r.randrange(50))])) for i in range(500)]
    want = sorted(data, key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
    got = tr.global_ranks(spark.createDataFrame(data, "id long, v double").repartition(7), "v", "id").collect()
    assert [(x.id, x.v) for x in sorted(got, key=lambda x: x["rank"])] == want and sorted(x["rank"] for x in got) == list(range(1, 501))
    assert tr.global_ranks(spark.createDataFrame([], "id long, v double"), "v", "id").count() == 0


def test_sketches_merge(spark):
    pv = spark.createDataFrame([("s", f"u{(i * 7) % 4000}", "2024-01-01", str(i % 24)) for i in range(30_000)] + [("t", "x", "2024-01-01", "1")] * 5, "site string, user string, date string, hour string")
    rolled = {x.site: x for x in tr.rolled_up(tr.pv_sketches(pv), ["site"]).collect()}
    assert rolled["s"].pv == 30_000 and abs(rolled["s"].uv_estimate - 4000) <= 4000 * tr.SKETCH_ERROR and rolled["t"].uv_estimate == 1
