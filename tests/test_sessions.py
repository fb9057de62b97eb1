import datetime as dt

from pyspark.sql import functions as F

from clickflow.operators import sessions as ses
from clickflow.operators.predicates import session_filter
from clickflow.sources.task_params import TaskParams

ACTION_SCHEMA = ("event_id long, session_id string, user_id long, action_time timestamp_ntz, "
                 "search_keyword string, click_category_id long")


def _t(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def test_visit_and_step_buckets_edges(spark):
    visits = [0, 1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60, 179, 180, 599, 600, 1799, 1800]
    steps = [1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60]
    df = spark.createDataFrame([(v, steps[i % len(steps)]) for i, v in enumerate(visits)],
                               "visit_length long, step_length long")
    h = ses.visit_length_histogram(df).first().asDict()
    assert h["session_count"] == 18
    assert [h[f"visit_{n}"] for n, *_ in ses.VISIT_BUCKETS] == [2, 2, 2, 2, 2, 2, 2, 2, 1]  # 0 is in no bucket
    sdf = spark.createDataFrame([(0, s) for s in steps], "visit_length long, step_length long")
    s = ses.step_length_histogram(sdf).first().asDict()
    assert [s[f"step_{n}"] for n, *_ in ses.STEP_BUCKETS] == [2, 2, 2, 2, 2, 1]
    # unit 60: lengths in minutes
    m = ses.visit_length_histogram(spark.createDataFrame([(60,), (200,), (3600 * 2,)], "visit_length long"),
                                   60).first().asDict()
    assert (m["visit_1s_3s"], m["visit_1m_3m"]) == (2, 1)


def test_statistics_ratios_and_empty(spark):
    df = spark.createDataFrame([(1, 1), (2, 4), (5, 10)], "visit_length long, step_length long")
    r = ses.session_statistics(df).first().asDict()
    assert r["session_count"] == 3 and r["visit_1s_3s_ratio"] == 0.67 and r["visit_4s_6s_ratio"] == 0.33
    assert r["step_10_30_ratio"] == 0.33
    empty = ses.session_statistics(df.where("false")).first().asDict()
    assert empty["session_count"] == 0 and empty["visit_1s_3s_ratio"] is None


def test_session_aggregate(spark):
    a = spark.createDataFrame([
        (1, "s1", 7, _t(0), "ab", None),
        (2, "s1", 7, _t(0), "a", 12),       # equal times
        (3, "s1", 7, _t(65), "a", 1),       # category 1 after 12, keyword a after ab
        (4, "s2", 8, _t(5), None, None),    # one row
    ], ACTION_SCHEMA)
    got = {r.session_id: r for r in ses.session_aggregates(a).collect()}
    s1 = got["s1"]
    assert (s1.user_id, s1.search_keywords, s1.click_category_ids, s1.visit_length, s1.step_length) == \
        (7, ["a", "ab"], [1, 12], 65, 3)
    assert (got["s2"].visit_length, got["s2"].step_length, got["s2"].search_keywords) == (0, 1, [])


def test_user_join_drops_unknown_users(spark):
    a = spark.createDataFrame([(1, "s1", 7, _t(0), None, None), (2, "s9", 99, _t(0), None, None)], ACTION_SCHEMA)
    u = spark.createDataFrame([(7, 30, "p", "c", "male")], "user_id long, age int, professional string, "
                              "city string, sex string")
    assert [r.session_id for r in ses.full_session_aggregates(a, u).collect()] == ["s1"]


def test_filter_rules(spark):
    full = spark.createDataFrame([
        ("s1", 30, "p1", "c1", "male", ["kw1", "kw2"], [1, 2]),
        ("s2", 70, "p2", "c2", "female", None, [3]),
        ("s3", None, "p1", "c1", "male", [], []),
    ], "session_id string, age int, professional string, city string, sex string, "
       "search_keywords array<string>, click_category_ids array<bigint>")

    def ids(p):
        c = session_filter(p)
        return sorted(r.session_id for r in (full if c is None else full.where(c)).collect())

    assert ids(TaskParams()) == ["s1", "s2", "s3"]                       # parameter missing
    assert ids(TaskParams(start_age=20)) == ["s1", "s2", "s3"]            # one bound missing
    assert ids(TaskParams(start_age=20, end_age=40)) == ["s1"]            # null age fails
    assert ids(TaskParams(keywords=["kw2", "kw9"])) == ["s1"]             # several tokens, null list fails
    assert ids(TaskParams(keywords=["zz"])) == []                         # no common token
    assert ids(TaskParams(category_ids=["3"], sex=["female"])) == ["s2"]
    assert ids(TaskParams(professionals=["p1"], cities=["c1"])) == ["s1", "s3"]


def test_session_detail_semi_join(spark):
    a = spark.createDataFrame([(1, "s1", 7, _t(0), None, None), (2, "s2", 8, _t(0), None, None),
                               (3, "s1", 7, _t(9), None, None)], ACTION_SCHEMA)
    s = spark.createDataFrame([("s1",)], "session_id string")
    assert sorted(r.event_id for r in ses.session_detail(a, s).collect()) == [1, 3]


def test_filter_with_hit_columns_equals_filter_on_sets(spark):
    """The bool_or hit columns give the same sessions as the overlap tests on
    the collected sets, including sessions with no keyword or category."""
    from clickflow.sources import views as V
    from clickflow.plans import params as P
    from click_util import SF_SMALL, rows

    a = V.user_visit_action(spark, SF_SMALL)
    u = V.user_info(spark, SF_SMALL)
    for p in (P.session_task_params(), TaskParams(keywords=["kw1"]), TaskParams(category_ids=["3", "40"])):
        via_sets = ses.filter_sessions(ses.full_session_aggregates(a, u), p)
        via_hits = ses.filter_sessions(ses.full_session_aggregates(a, u, p), p)
        assert via_hits.columns == via_sets.columns
        assert rows(via_hits.select("session_id")) == rows(via_sets.select("session_id"))
    # statistics over the hit path no longer build the sets
    p = P.session_task_params()
    stat = ses.session_statistics(ses.filter_sessions(ses.full_session_aggregates(a, u, p), p))
    plan = stat._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan
