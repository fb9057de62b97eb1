"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

written to the ``noop`` sink (full execution, no output cost). The ad stream
is measured the same way: each run replays the staged log (6 producer
batches at 5 days each, a micro-batch each of one availableNow run) into a
fresh folder and reads the ``ad_stat`` store; staging the log once (the
message bus's content) is not timed. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickflow.plans.registry import LATE_EVERY, QUERIES, run_ad_stream, run_stateful, staged_replay  # noqa: E402
from clickflow.session import build_session  # noqa: E402
from clickflow.streaming.ad_stream import STAT_KEYS  # noqa: E402

HEADLINE = [
    "area_top3_product",
    "session_aggr_stat",
    "session_detail",
    "top10_category",
    "top10_session",
    "page_convert_rate",
    "session_random_extract",
    "sample_detail",
    "pv_uv_hourly",
    "ad_province_top3",
    "ad_blacklist_batch",
    "ad_sliding_hour",
    "sink_upsert_increment",
]
STATEFUL = "ad_stream_stateful_stat"
STREAM = "ad_stream_stat"


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times: dict[str, float] = {}
    for name in HEADLINE:
        fn = QUERIES[name]
        _run(fn(spark, sf_dir))  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            _run(fn(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    staged_replay(spark, sf_dir)
    _run(run_ad_stream(spark, sf_dir).stat_view())  # warm-up
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        _run(run_ad_stream(spark, sf_dir).stat_view())  # replay + read of the store
        samples.append(time.perf_counter() - t0)
    times[STREAM] = round(statistics.median(samples), 3)
    staged_replay(spark, sf_dir, LATE_EVERY)
    t0 = time.perf_counter()  # three state-store queries over the replay with late clicks, once
    _run(run_stateful(spark, sf_dir)[0].latest(STAT_KEYS, "click_count"))
    times[STATEFUL] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
