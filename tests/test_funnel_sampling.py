import datetime as dt
import hashlib
from collections import Counter

import pandas as pd

from clickflow.operators import funnel as fun
from clickflow.operators import sampling as smp
from clickflow.operators import sessions as ses
from clickflow.sources import views as V
from click_util import SF_SMALL

SCHEMA = "session_id string, event_id long, page_id long, action_time timestamp_ntz"


def _t(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def _rates(df, flow):
    return [(r.step, r.page_pair, r.pair_count, r.prev_count, r.convert_rate)
            for r in fun.conversion_rates(fun.page_transitions(df, 60), flow).orderBy("step").collect()]


def test_funnel_hand_built(spark):
    df = spark.createDataFrame([
        # s1: 1 -> 2 -> 5 ; rows out of order, equal times broken by event_id
        ("s1", 3, 5, _t(200)), ("s1", 1, 1, _t(0)), ("s1", 2, 2, _t(0)),
        # s2 interleaved in time with s1: 1 -> 9 -> 2 (no 1_2 pair)
        ("s2", 4, 1, _t(1)), ("s2", 5, 9, _t(100)), ("s2", 6, 2, _t(150)),
        # s3: 1 -> 2 twice, across minute buckets
        ("s3", 7, 1, _t(10)), ("s3", 8, 2, _t(130)), ("s3", 9, 1, _t(400)), ("s3", 10, 2, _t(1000)),
    ], SCHEMA)
    assert _rates(df, [1, 2, 5]) == [(1, "1_2", 3, 4, 0.75), (2, "2_5", 1, 3, 0.33)]
    # flow with a pair that never occurs, then a zero denominator
    assert _rates(df, [1, 7, 2]) == [(1, "1_7", 0, 4, 0.0), (2, "7_2", 0, 0, None)]
    # zero start views
    assert _rates(df, [8, 1]) == [(1, "8_1", 0, 0, None)]
    # a repeated pair in the flow gets its count at each step
    assert _rates(df, [1, 2, 1, 2]) == [(1, "1_2", 3, 4, 0.75), (2, "2_1", 1, 3, 0.33), (3, "1_2", 3, 1, 3.0)]
    s = fun.rate_string(fun.conversion_rates(fun.page_transitions(df, 60), [1, 2, 5])).first().convert_rate
    assert s == "1_2=0.75|2_5=0.33"


def _pandas_prev(df):
    pdf = df.select("session_id", "event_id", "page_id", "action_time").toPandas()
    pdf = pdf.sort_values(["session_id", "action_time", "event_id"])
    pdf["prev"] = pdf.groupby("session_id")["page_id"].shift(1)
    return {int(e): (None if pd.isna(p) else int(p)) for e, p in zip(pdf.event_id, pdf.prev)}


def test_bucketed_lag_equals_per_session_sort(spark):
    a = V.user_visit_action(spark, SF_SMALL)
    want = _pandas_prev(a)
    for bucket, block in ((60, 100_000), (3600, 1), (86400 * 40, 3), (1, 2)):
        got = {r.event_id: r.prev_page_id for r in fun.page_pairs(a, bucket, block).collect()}
        assert got == want, (bucket, block)
        pairs = Counter((want[r.event_id], r.page_id) for r in a.select("event_id", "page_id").collect())
        assert Counter(map(tuple, fun.page_transitions(a, bucket, block).collect())) == pairs, (bucket, block)


def test_lag_splits_a_hot_instant(spark):
    """One session with 60 rows at three instants (20 each, ids interleaved)
    and a second session: blocks of 4 ids split every instant into runs."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    data = [("hot", i, i % 7, t0 + dt.timedelta(seconds=(i * 7) % 3)) for i in range(60)]
    data += [("cold", 100 + i, i, t0 + dt.timedelta(minutes=i)) for i in range(3)]
    df = spark.createDataFrame(data, "session_id string, event_id long, page_id long, action_time timestamp_ntz")
    want = _pandas_prev(df)
    for bucket, block in ((60, 4), (1, 1), (3600, 100)):
        got = {r.event_id: r.prev_page_id for r in fun.page_pairs(df, bucket, block).collect()}
        pages = {r.event_id: r.page_id for r in df.collect()}
        moves = Counter((p, pages[e]) for e, p in got.items())
        assert Counter(map(tuple, fun.page_transitions(df, bucket, block).collect())) == moves
        assert got == want, (bucket, block)


def _brute_sample(sessions_pdf, size, seed):
    s = sessions_pdf.copy()
    s["d"] = s.start_time.dt.date
    s["hr"] = s.start_time.dt.hour
    c = s.groupby(["d", "hr"]).size().rename("c").reset_index()
    n_days = c.d.nunique()
    c["day_total"] = c.groupby("d").c.transform("sum")
    c["quota"] = [min(x, (x * (size // n_days)) // t) for x, t in zip(c.c, c.day_total)]
    s["h"] = [hashlib.md5((sid + seed).encode()).hexdigest() for sid in s.session_id]
    s = s.sort_values(["d", "hr", "h", "session_id"])
    s["rn"] = s.groupby(["d", "hr"]).cumcount() + 1
    s = s.merge(c[["d", "hr", "quota"]], on=["d", "hr"])
    return sorted(s[s.rn <= s.quota].session_id)


def test_sample_equals_brute_force(spark):
    sessions = ses.session_aggregates(V.user_visit_action(spark, SF_SMALL))
    pdf = sessions.select("session_id", "start_time").toPandas()
    for size, prefix in ((300, 3), (300, 1), (40, 2), (0, 3)):
        got = sorted(r.session_id for r in smp.random_extract(sessions, size, "7", prefix).collect())
        assert got == _brute_sample(pdf, size, "7"), (size, prefix)


def test_sample_quota_capped_and_one_day(spark):
    df = spark.createDataFrame([("a", _t(0)), ("b", _t(10)), ("c", _t(3600))], "session_id string, start_time "
                                                                                "timestamp_ntz")
    # one day, quota 100 > hour counts: everything is taken (capped at the hour's count)
    assert sorted(r.session_id for r in smp.random_extract(df, 100, "1").collect()) == ["a", "b", "c"]
    # quota floors: 1 per day over 2 + 1 sessions -> hour 0 gets 2*1 div 3 = 0, hour 1 gets 0
    assert smp.random_extract(df, 1, "1").count() == 0


def test_sampled_sessions_equal_sampling_all_aggregates(spark):
    """Sampling on (session, start) and aggregating only the sampled sessions
    gives the rows of sampling the full session aggregates."""
    a = V.user_visit_action(spark, SF_SMALL)
    cols = ["session_id", "start_time", "search_keywords", "click_category_ids", "visit_length", "step_length"]
    full = smp.random_extract(ses.session_aggregates(a), 300, "7").select(*cols)
    fast = smp.sampled_sessions(a, 300, "7").select(*cols)
    got, want = sorted(map(tuple, fast.collect())), sorted(map(tuple, full.collect()))
    assert got == want and len(got) > 0


def test_transitions_shuffle_the_rows_once_and_join_nothing(spark):
    a = V.user_visit_action(spark, SF_SMALL)
    df = fun.page_transitions(a)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert "ReusedExchange" in plan  # the row shuffle serves the pairs inside runs and the ends of runs
