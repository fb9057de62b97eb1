import datetime as dt
import re

from click_util import SF_SMALL, rows
from clickflow.operators import sessions as ses
from clickflow.plans import params as P
from clickflow.session import scratch_dir
from clickflow.sources import native as N
from clickflow.sources import views as V
from pyspark.sql import functions as F


def _formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_range_is_pushed_on_the_text_column(spark):
    root = scratch_dir(spark, "t-range")
    N.rendered_actions(V.user_visit_action(spark, SF_SMALL)).write.parquet(f"{root}/user_visit_action")
    got = N.user_visit_action(spark, root, "2024-01-05", "2024-01-20")
    plan = _formatted(got)
    assert "GreaterThanOrEqual(date,2024-01-05)" in plan and "LessThanOrEqual(date,2024-01-20)" in plan
    want = V.user_visit_action(spark, SF_SMALL).where("date between date'2024-01-05' and date'2024-01-20'")
    assert rows(got.drop("event_id")) == rows(want.drop("event_id"))


def test_malformed_dates_drop_out_of_a_range(spark):
    root = scratch_dir(spark, "t-bad")
    row = N.rendered_actions(V.user_visit_action(spark, SF_SMALL)).limit(1)
    bad = row.select(F.explode(F.array(*[F.lit(x) for x in ("2024-01-06", "2024-01-06x", "2024-01-1", "x", None)])).alias("date"), *[c for c in N.ACTION_COLUMNS if c != "date"])
    bad.write.parquet(f"{root}/user_visit_action")
    assert N.user_visit_action(spark, root).count() == 5
    assert [r.date for r in N.user_visit_action(spark, root, "2024-01-05", "2024-01-20").collect()] == [dt.date(2024, 1, 6)]
    assert N.user_visit_action(spark, root, start="2024-01-05").where("date is null").count() == 0


def test_stored_actions_hold_every_day(spark, tmp_path):
    """The query reads the whole table back: days outside the range of the other queries and actions without a time too."""
    from __spark_entry__ import oracle_sql, queries

    import duckdb

    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    days = [dt.datetime(2023, 12, 31, 23), dt.datetime(2024, 1, 7, 1), dt.datetime(2031, 5, 1, 2), None]
    spark.createDataFrame([(i, t, i, "click", 1.0, '{"k": 5}') for i, t in enumerate(days)], schema).write.parquet(f"{tmp_path}/events.parquet")
    got = queries()["stored_actions"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    rel = con.sql(oracle_sql()["stored_actions"])
    at = rel.columns.index("date")
    assert sorted(str(r["date"]) for r in got.collect()) == sorted(str(r[at]) for r in rel.fetchall()) == ["2023-12-31", "2024-01-07", "2031-05-01", "None"]


def test_a_table_by_date_lists_only_its_days(spark):
    root = scratch_dir(spark, "t-days")
    actions = V.user_visit_action(spark, SF_SMALL)
    N.store_actions(actions, f"{root}/user_visit_action")
    got = N.user_visit_action(spark, root, "2024-01-05", "2024-01-07")
    plan = _formatted(got)
    assert re.search(r"PartitionFilters: \[.*date.* >= 2024-01-05.*date.* <= 2024-01-07", plan), plan
    assert rows(got.drop("event_id")) == rows(actions.where("date between date'2024-01-05' and date'2024-01-07'").drop("event_id"))
    scan = got._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert got.count() and scan.nodeName().startswith("Scan")
    folders = {f.split("date=")[1][:10] for f in got.select(F.input_file_name().alias("f")).distinct().rdd.map(lambda r: r.f).collect()}
    assert folders == {"2024-01-05", "2024-01-06", "2024-01-07"}


def test_session_joins_on_the_bucketed_table_need_no_shuffle(spark):
    """J1 and J2 on a table dealt by session: nothing is exchanged but the broadcast of the users."""
    root = scratch_dir(spark, "t-buckets")
    actions = V.user_visit_action(spark, SF_SMALL)
    N.store_actions(actions, f"{root}/user_visit_action", "default.user_visit_action", session_buckets=4)
    try:
        stored = N.user_visit_action(spark, "default", P.START_DATE, P.END_DATE)
        p = P.session_task_params()
        users = F.broadcast(V.user_info(spark, SF_SMALL))
        sessions = ses.filter_sessions(ses.full_session_aggregates(stored, users, p), p).select("session_id", "start_time", "visit_length", "step_length")
        detail = ses.session_detail(stored, sessions.hint("merge"))
        plan = detail._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(session_id" not in plan and "Exchange hashpartitioning" not in plan, plan
        scoped = actions.where(F.col("date").between(F.lit(P.START_DATE).cast("date"), F.lit(P.END_DATE).cast("date")))
        want = ses.session_detail(scoped, ses.filter_sessions(ses.full_session_aggregates(scoped, V.user_info(spark, SF_SMALL), p), p))
        assert rows(detail.drop("event_id")) == rows(want.drop("event_id"))
    finally:
        spark.sql("DROP TABLE default.user_visit_action")
