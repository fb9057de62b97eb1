"""The task entry points write every output table, and their rows agree with the registered queries."""

from clickflow.plans import params as P
from clickflow.plans import tasks
from clickflow.session import scratch_dir
from clickflow.sources import views as V
from clickflow.sources.task_params import TaskParams
from click_util import SF_SMALL


def test_session_page_product_tasks(spark):
    out = scratch_dir(spark, "t-tasks")
    actions = V.user_visit_action(spark, SF_SMALL)
    p = P.session_task_params()
    p.target_page_flow = P.PAGE_FLOW
    tasks.run_session_task(actions, V.user_info(spark, SF_SMALL), p, 7, out, sample_size=100)
    tasks.run_page_task(actions, p, 7, out)
    tasks.run_product_task(actions, V.city_info(spark, SF_SMALL), V.product_info(spark, SF_SMALL), p, 7, out)
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    stat = read("session_aggr_stat").first()
    assert stat.task_id == 7 and stat.session_count > 0
    assert read("top10_category").count() <= 10
    assert read("top10_category_session").where("task_id <> 7").count() == 0
    rate = read("page_split_convert_rate").first().convert_rate
    assert rate.count("|") == len(P.PAGE_FLOW) - 2 and rate.startswith("1_2=")
    assert read("area_top3_product").count() > 0
    # sample rows are actions of sampled sessions only
    sampled = {r.session_id for r in read("session_random_extract").collect()}
    assert {r.session_id for r in read("session_detail").collect()} <= sampled


def test_task_without_filters_keeps_all_sessions(spark):
    actions = V.user_visit_action(spark, SF_SMALL)
    outs = tasks.session_task_outputs(actions, V.user_info(spark, SF_SMALL), TaskParams(), 1)
    n = outs["session_aggr_stat"].first().session_count
    users = {r.user_id for r in V.user_info(spark, SF_SMALL).select("user_id").collect()}
    expected = actions.where(actions.user_id.isin(list(users))).select("session_id").distinct().count()
    assert n == expected


def test_task_table_lookup_drives_a_task(spark):
    """S9 end to end: a task row of the derived table is looked up, its JSON
    parameters configure the session filter, and unset names stay unset."""
    from clickflow.operators import sessions as ses
    from clickflow.sources.task_params import lookup_task

    tasks_df = V.task_table(spark, SF_SMALL, P.START_DATE, P.END_DATE, P.PAGE_FLOW)
    actions = V.user_visit_action(spark, SF_SMALL)
    # a user with actions and neither keywords nor categories in its task
    odd = actions.where("user_id % 6 = 3 and user_id % 10 <> 3").agg({"user_id": "min"}).first()[0]
    p = lookup_task(tasks_df, odd)
    assert p.keywords is None and p.category_ids is None
    assert p.start_date == P.START_DATE and p.target_page_flow == P.PAGE_FLOW
    user = V.user_info(spark, SF_SMALL).where(f"user_id = {odd}").first()
    assert p.cities == [user.city] and p.sex == [user.sex] and p.end_age == user.age + 5
    kept = ses.filter_sessions(ses.full_session_aggregates(actions, V.user_info(spark, SF_SMALL)), p)
    assert kept.count() > 0
    assert kept.where((kept.city != user.city) | (kept.sex != user.sex) | (kept.age > user.age + 5)).count() == 0


def test_session_task_equals_registered_queries(spark):
    """T1's rankings (from the checkpointed per-(category, session) counts) and
    statistics equal the registered per-operator queries (from detail rows);
    its detail outputs are the actions of the selected sessions."""
    from clickflow.plans.registry import QUERIES
    from clickflow.plans.present import present
    from click_util import rows

    actions = V.user_visit_action(spark, SF_SMALL)
    p = P.session_task_params()
    outs = tasks.session_task_outputs(actions, V.user_info(spark, SF_SMALL), p, 3, sample_size=P.SAMPLE_SIZE,
                                      seed=P.SAMPLE_SEED, unit_seconds=P.VISIT_UNIT_SECONDS,
                                      top_sessions=P.TOP_SESSIONS, step_buckets=P.STEP_BUCKETS)
    for name, key in (("top10_category", "top10_category"), ("top10_category_session", "top10_session"),
                      ("session_aggr_stat", "session_aggr_stat")):
        assert rows(present(outs[name]).drop("task_id")) == rows(QUERIES[key](spark, SF_SMALL)), name
    detail = outs["top10_session_detail"]
    tops = {(r.category_id, r.session_id) for r in outs["top10_category_session"].collect()}
    assert {(r.category_id, r.session_id) for r in detail.select("category_id", "session_id").distinct().collect()} \
        == tops
    sampled = {r.session_id for r in outs["session_random_extract"].collect()}
    n_rows = actions.where(actions.session_id.isin(list(sampled))).where(
        actions.date.between(p.start_date, p.end_date)).count()
    assert outs["session_detail"].count() == n_rows > 0


def test_submit_runs_a_task_from_the_task_table(spark):
    """The command-line entry point looks the task up and appends its outputs."""
    from clickflow.plans import submit

    root = scratch_dir(spark, "t-submit")
    V.task_table(spark, SF_SMALL, P.START_DATE, P.END_DATE, P.PAGE_FLOW).write.parquet(f"{root}/tasks")
    uid = V.user_visit_action(spark, SF_SMALL).agg({"user_id": "min"}).first()[0]
    for job in ("session", "page", "product"):
        args = submit._parser().parse_args([job, "--input", SF_SMALL, "--tasks", f"{root}/tasks",
                                            "--task-id", str(uid), "--out", f"{root}/out"])
        assert submit.run(spark, args) is None
    rate = spark.read.parquet(f"{root}/out/page_split_convert_rate").first()
    assert rate.task_id == uid and rate.convert_rate.startswith("1_2=")
    assert spark.read.parquet(f"{root}/out/session_aggr_stat").first().task_id == uid
    assert spark.read.parquet(f"{root}/out/area_top3_product").count() > 0


def test_submit_ads_job_reads_topics_through_the_bus_source(spark):
    """With --topics the ads job builds the message-bus source (here it
    reports the missing connector before any query starts)."""
    import pytest
    from clickflow.plans import submit

    root = scratch_dir(spark, "t-submit-ads")
    args = submit._parser().parse_args(["ads", "--bootstrap-servers", "localhost:9092", "--topics", "ad_log",
                                        "--out", root])
    with pytest.raises(RuntimeError, match="Kafka connector"):
        submit.run(spark, args)


def test_submit_runs_on_stored_tables(spark):
    """The three batch jobs on tables with text dates, times and lists give what they give on typed ones; area levels are a parameter."""
    from clickflow.plans import submit
    from clickflow.sources import native

    root = scratch_dir(spark, "t-stored")
    native.rendered_actions(V.user_visit_action(spark, SF_SMALL)).write.parquet(f"{root}/in/user_visit_action")
    for name in ("user_info", "product_info", "city_info"):
        getattr(V, name)(spark, SF_SMALL).write.parquet(f"{root}/in/{name}")
    V.task_table(spark, SF_SMALL, P.START_DATE, P.END_DATE, P.PAGE_FLOW).write.parquet(f"{root}/tasks")
    uid = V.user_info(spark, SF_SMALL).join(V.user_visit_action(spark, SF_SMALL), "user_id").agg({"user_id": "min"}).first()[0]
    for kind, folder in (("stored", f"{root}/in"), ("derived", SF_SMALL)):
        for job in ("session", "page", "product"):
            submit.run(spark, submit._parser().parse_args([job, "--input", folder, "--tables", kind, "--tasks", f"{root}/tasks", "--task-id", str(uid),
                                                           "--out", f"{root}/{kind}", "--levels", '{"ASIA": "Z"}']))
    for name in ("session_aggr_stat", "top10_category", "top10_category_session", "area_top3_product"):
        got, want = (sorted(map(tuple, spark.read.parquet(f"{root}/{k}/{name}").collect()), key=str) for k in ("stored", "derived"))
        assert got == want, name
    assert {r.area_level for r in spark.read.parquet(f"{root}/stored/area_top3_product").collect()} == {"Z", "D"}


def test_all_tasks_in_one_pass_equal_each_task_alone(spark):
    """Missing terms, several tokens, empty and odd values, null profiles: as the filter of each task by itself."""
    import json

    from pyspark.sql import functions as F

    from clickflow.operators.sessions import filter_sessions, filter_sessions_of_tasks
    from clickflow.sources.task_params import lookup_task, param_values

    full = spark.createDataFrame(
        [(f"s{i}", i, [None, "p1", "p2"][i % 3], ["c1", "c2", "*", None][i % 4], ["male", "female"][i % 2], None if i % 11 == 0 else 20 + i % 30,
          [f"kw{i % 5}"] if i % 4 else [], [i % 7, i % 3] if i % 5 else []) for i in range(120)],
        "session_id string, user_id long, professional string, city string, sex string, age int, search_keywords array<string>, click_category_ids array<long>")
    params = [{}, {"startAge": ["25"], "endAge": ["40"]}, {"startAge": ["25"]}, {"professionals": ["p1,p1,,p2"], "sex": ["male"]},
              {"cities": ["c1,*"], "keywords": ["kw1,kw2"]}, {"cities": [""], "categoryIds": ["1,x,2"]}, {"categoryIds": ["x"]},
              {"professionals": ["p2"], "cities": ["c2"], "sex": ["female"], "keywords": ["kw3"], "startAge": ["0"], "endAge": ["99"]}, {"sex": ["none"]}]
    tasks = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(params)], "task_id long, task_param string")
    got = filter_sessions_of_tasks(full, param_values(tasks))
    assert "Cartesian" not in got._jdf.queryExecution().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()
    got = sorted((r["task_id"], r["session_id"]) for r in got.collect())
    want = sorted((i, r["session_id"]) for i in range(len(params)) for r in filter_sessions(full, lookup_task(tasks, i)).collect())
    assert got == want and len(set(got)) == len(got) > 200
    assert filter_sessions_of_tasks(full, param_values(tasks.where(F.lit(False)))).count() == 0
