"""Registered queries: name -> callable(spark, base_dir) -> DataFrame.

Each query reads the whole driver tables under ``base_dir`` through the
adapter views and runs one operator (or a task composition) with the
parameters of ``clickflow.plans.params``. Outputs go through ``present``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators import products as prod
from clickflow.plans import params as P
from clickflow.plans.present import present
from clickflow.session import ensure_session_defaults
from clickflow.session import scratch_dir
from clickflow.sources import native
from clickflow.sources import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


# nullable integer columns of action rows
ACTION_TEXT = ("click_category_id", "click_product_id")


def register(name: str, as_text: tuple[str, ...] = ()):
    def deco(fn):
        def run(spark: SparkSession, base_dir: str) -> DataFrame:
            ensure_session_defaults(spark)
            return present(fn(spark, base_dir), as_text)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ---------------------------------------------------------------- products
@register("clicks_by_date")
def _clicks_by_date(spark, d):
    """Click scan with date range and not-null product."""
    return prod.click_scan(V.user_visit_action(spark, d), P.START_DATE, P.END_DATE)


@register("click_product_basic")
def _click_product_basic(spark, d):
    """Clicks joined with the city dimension."""
    clicks = prod.click_scan(V.user_visit_action(spark, d), P.START_DATE, P.END_DATE)
    return prod.clicks_with_city(clicks, V.city_info(spark, d))


@register("area_product_count")
def _area_product_count(spark, d):
    """C6 + D1 + D3: count and distinct city list per (area, product)."""
    return prod.area_product_counts(_click_product_basic(spark, d))


@register("area_product_full")
def _area_product_full(spark, d):
    """J7 + P7: add product name and status."""
    return prod.with_product(_area_product_count(spark, d), V.product_info(spark, d)).select(
        "area", "product_id", "click_count", "city_infos", "product_name", "product_status")


@register("area_top3_product")
def _area_top3_product(spark, d):
    """Top-3 products per area (flagship)."""
    return prod.area_top3_products(V.user_visit_action(spark, d), V.city_info(spark, d),
                                   V.product_info(spark, d), P.START_DATE, P.END_DATE)


@register("product_status")
def _product_status(spark, d):
    """Product status from the JSON extend_info."""
    p = V.product_info(spark, d)
    return p.select("product_id", prod.product_status("extend_info").alias("product_status"))


# ---------------------------------------------------------------- sessions
from clickflow.operators import categories as cat  # noqa: E402
from clickflow.operators import sessions as ses  # noqa: E402
from clickflow.operators.predicates import equals  # noqa: E402


def _actions_in_range(spark, d):
    a = V.user_visit_action(spark, d)
    return a.where(F.col("date").between(F.lit(P.START_DATE).cast("date"), F.lit(P.END_DATE).cast("date")))


def _full_sessions(spark, d):
    return ses.full_session_aggregates(_actions_in_range(spark, d), V.user_info(spark, d))


def _filtered_sessions(spark, d):
    p = P.session_task_params()
    return ses.filter_sessions(ses.full_session_aggregates(_actions_in_range(spark, d), V.user_info(spark, d), p), p)


def _detail(spark, d):
    return ses.session_detail(_actions_in_range(spark, d), _filtered_sessions(spark, d))


@register("actions_by_date", ACTION_TEXT)
def _actions_by_date(spark, d):
    """All action columns in the date range."""
    return _actions_in_range(spark, d)


@register("session_agg")
def _session_agg(spark, d):
    """G1: per-session aggregate over all actions."""
    return ses.session_aggregates(V.user_visit_action(spark, d))


@register("session_full_agg")
def _session_full_agg(spark, d):
    """G1 + J1 over the date range."""
    return _full_sessions(spark, d)


@register("session_filter")
def _session_filter(spark, d):
    """P1 + P2 + P4: sessions passing the task's filter."""
    return _filtered_sessions(spark, d)


@register("session_filter_all_tasks")
def _session_filter_all_tasks(spark, d):
    """S9 + P4: the sessions of every task in one pass over the actions."""
    from clickflow.sources.task_params import param_values
    tasks = param_values(V.task_table(spark, d, P.START_DATE, P.END_DATE, P.PAGE_FLOW))
    tasks = tasks.where((F.col("start_date") == P.START_DATE) & (F.col("end_date") == P.END_DATE))
    return ses.filter_sessions_of_tasks(_full_sessions(spark, d), tasks).select("task_id", "session_id", "visit_length", "step_length")


@register("session_filter_equal")
def _session_filter_equal(spark, d):
    """Equality predicate (sex = female)."""
    return _full_sessions(spark, d).where(equals("sex", "female")).select("session_id", "sex")


@register("visit_length_hist")
def _visit_length_hist(spark, d):
    """Visit-length histogram (unit 60 s) over all sessions."""
    return ses.visit_length_histogram(ses.session_aggregates(V.user_visit_action(spark, d)), P.VISIT_UNIT_SECONDS)


@register("step_length_hist")
def _step_length_hist(spark, d):
    """Step-length histogram over all sessions."""
    return ses.step_length_histogram(ses.session_aggregates(V.user_visit_action(spark, d)), P.STEP_BUCKETS)


@register("session_aggr_stat")
def _session_aggr_stat(spark, d):
    """Session count and 15 ratios over the filtered sessions."""
    return ses.session_statistics(_filtered_sessions(spark, d), P.VISIT_UNIT_SECONDS, P.STEP_BUCKETS)


@register("session_detail", ACTION_TEXT)
def _session_detail(spark, d):
    """Actions of the filtered sessions."""
    return _detail(spark, d)


# ---------------------------------------------------------------- categories
@register("category_clicks")
def _category_clicks(spark, d):
    """C1."""
    return cat.category_clicks(_detail(spark, d))


@register("category_orders")
def _category_orders(spark, d):
    """C2 + F11."""
    return cat.category_orders(_detail(spark, d))


@register("category_pays")
def _category_pays(spark, d):
    """C3 + F11."""
    return cat.category_pays(_detail(spark, d))


@register("visited_categories")
def _visited_categories(spark, d):
    """C4 + U1 + U2."""
    return cat.visited_categories(_detail(spark, d))


@register("category_counts")
def _category_counts(spark, d):
    """J3, single pass."""
    return cat.category_counts(_detail(spark, d))


@register("category_counts_join")
def _category_counts_join(spark, d):
    """J3, the reference's three left outer joins."""
    return cat.category_counts_by_join(_detail(spark, d))


@register("top10_category")
def _top10_category(spark, d):
    """W4."""
    return cat.top_categories(cat.category_counts(_detail(spark, d)), 10)


@register("session_category_clicks")
def _session_category_clicks(spark, d):
    """C5."""
    return cat.session_category_clicks(_detail(spark, d))


@register("top10_session")
def _top10_session(spark, d):
    """J4 + W3: both rankings from one table of counts per (category, session)."""
    counts = cat.category_session_counts(_detail(spark, d))
    top = cat.top_categories(cat.counts_from_session_counts(counts), 10)
    return cat.rank_sessions(cat.clicks_from_session_counts(counts), top, P.TOP_SESSIONS)


@register("top10_session_detail", ACTION_TEXT)
def _top10_session_detail(spark, d):
    """Detail rows of the top sessions, with category_id."""
    return cat.top_session_detail(_top10_session(spark, d), _actions_in_range(spark, d))


# ---------------------------------------------------------------- funnel
from clickflow.operators import funnel as fun  # noqa: E402
from clickflow.operators import sampling as smp  # noqa: E402


def _rates(spark, d):
    return fun.conversion_rates(fun.page_transitions(_actions_in_range(spark, d)), P.PAGE_FLOW)


@register("page_pair_counts")
def _page_pair_counts(spark, d):
    """W7 + W8 + C8: flow pair counts in time order per session."""
    return fun.page_pair_counts(fun.page_transitions(_actions_in_range(spark, d)), P.PAGE_FLOW)


@register("page_convert_rate")
def _page_convert_rate(spark, d):
    """C9 + W9: step conversion rates."""
    return _rates(spark, d)


@register("page_convert_rate_string")
def _page_convert_rate_string(spark, d):
    """The rate string of the page task."""
    return fun.rate_string(_rates(spark, d))


# ---------------------------------------------------------------- sampling
def _sampled(spark, d):
    sessions = ses.session_aggregates(V.user_visit_action(spark, d))
    return smp.random_extract(sessions, P.SAMPLE_SIZE, P.SAMPLE_SEED)


@register("sessions_per_hour")
def _sessions_per_hour(spark, d):
    """C7."""
    return smp.sessions_per_hour(ses.session_aggregates(V.user_visit_action(spark, d)))


@register("session_random_extract")
def _session_random_extract(spark, d):
    """Time-proportional seeded sample of sessions; the keyword and
    category sets are aggregated for the sampled sessions only."""
    return smp.sampled_sessions(V.user_visit_action(spark, d), P.SAMPLE_SIZE, P.SAMPLE_SEED).select(
        "session_id", "start_time", "search_keywords", "click_category_ids")


@register("sample_detail", ACTION_TEXT)
def _sample_detail(spark, d):
    """Action rows of the sampled sessions."""
    return smp.sample_detail(_sampled(spark, d), V.user_visit_action(spark, d))


# ---------------------------------------------------------------- traffic
from clickflow.functions import dates as fd  # noqa: E402
from clickflow.functions import strings as fs  # noqa: E402
from clickflow.functions import udfs as fu  # noqa: E402
from clickflow.operators import ads  # noqa: E402
from clickflow.operators import traffic as tr  # noqa: E402
from clickflow.sources.tables import table  # noqa: E402


@register("pv_uv_hourly")
def _pv_uv_hourly(spark, d):
    """S8 + C10 + F6: PV and UV per site, date and unpadded hour."""
    return tr.pv_uv(tr.parse_pv_lines(V.pv_lines(spark, d)))


@register("global_sort_top1")
def _global_sort_top1(spark, d):
    """First row of a descending global sort."""
    return tr.global_top1(table(spark, d, "events"), "value")


@register("global_sort_rank")
def _global_sort_rank(spark, d):
    """The place of every row in a descending global sort."""
    return tr.global_ranks(table(spark, d, "events").select("event_id", "value"), "value", "event_id")


@register("pv_uv_rollup")
def _pv_uv_rollup(spark, d):
    """C10 from stored sketches per site and hour, rolled up to the day, beside the exact count: whether it lies within the stated error."""
    pv = tr.parse_pv_lines(V.pv_lines(spark, d))
    path = scratch_dir(spark, "pv-sketches")
    tr.pv_sketches(pv).write.mode("overwrite").parquet(path)
    rolled = tr.rolled_up(spark.read.parquet(path), ["site", "date"])
    exact = pv.groupBy("site", "date").agg(F.count_distinct("user").alias("uv"))
    same = rolled["site"].eqNullSafe(exact["site"]) & rolled["date"].eqNullSafe(exact["date"])
    return rolled.join(exact, same).select(rolled["site"], rolled["date"], "pv", "uv",
                                           (F.abs(F.col("uv_estimate") - F.col("uv")) <= F.ceil(F.col("uv") * tr.SKETCH_ERROR)).alias("within_error"))


@register("catalog_scan")
def _catalog_scan(spark, d):
    """A stored table of the session catalog, read by database and name."""
    path = f"{scratch_dir(spark, 'catalog')}/city_info"
    V.city_info(spark, d).write.parquet(path)
    db = spark.catalog.currentDatabase()
    name = f"clickflow_city_info_{uuid.uuid4().hex[:8]}"  # an external table: nothing is left in the warehouse
    spark.catalog.createTable(f"{db}.{name}", path, "parquet")
    return tr.catalog_scan(spark, db, name)


@register("stored_actions", ACTION_TEXT)
def _stored_actions(spark, d):
    """S1 + F11: action rows stored as the jobs store them (dates, times and id lists as text), all of them read with types."""
    root = scratch_dir(spark, "stored")
    native.rendered_actions(V.user_visit_action(spark, d)).write.parquet(f"{root}/user_visit_action")
    return native.user_visit_action(spark, root).drop("event_id")


@register("stored_actions_by_day", ACTION_TEXT)
def _stored_actions_by_day(spark, d):
    """S1 on a table laid out by date: the range lists only its days' folders."""
    root = scratch_dir(spark, "stored-days")
    native.store_actions(V.user_visit_action(spark, d), f"{root}/user_visit_action")
    return native.user_visit_action(spark, root, P.START_DATE, P.END_DATE).drop("event_id")


# ---------------------------------------------------------------- functions
REF_TIME = "2024-01-15 12:00:00"


@register("task_params")
def _task_params(spark, d):
    """Every task's JSON parameters parsed, element 0 of each name."""
    from clickflow.sources.task_params import param_columns
    tasks = V.task_table(spark, d, P.START_DATE, P.END_DATE, P.PAGE_FLOW)
    return param_columns(tasks).join(tasks.select("task_id", "task_name"), "task_id")


@register("date_functions")
def _date_functions(spark, d):
    """Formats, parsing, comparisons, differences."""
    e = table(spark, d, "events")
    t = fd.format_time("ts")
    return e.select(
        "event_id",
        fd.date_hour("ts").alias("date_hour"),
        fd.format_date("ts").alias("date"),
        fd.format_datekey("ts").alias("datekey"),
        fd.format_minute("ts").alias("minute_key"),
        fd.format_time(fd.parse_time(t)).alias("parsed_time"),
        fd.format_date(fd.parse_datekey(fd.format_datekey("ts"))).alias("parsed_datekey"),
        fd.time_before(t, F.lit(REF_TIME)).alias("before_ref"),
        fd.time_after(t, F.lit(REF_TIME)).alias("after_ref"),
        fd.time_minus_seconds(t, F.concat(fd.format_date("ts"), F.lit(" 00:00:00"))).alias("seconds_of_day"),
        fd.hour_part("ts").alias("hour_unpadded"),
    )


@register("kv_functions")
def _kv_functions(spark, d):
    """key=value records: get (empty = missing) and set."""
    s = ses.session_aggregates(V.user_visit_action(spark, d))
    info = F.concat(
        F.lit("sessionid="), F.col("session_id"),
        F.lit("|searchKeywords="), fs.join_ids("search_keywords"),
        F.lit("|clickCategoryIds="), fs.join_ids("click_category_ids"),
        F.lit("|visitLength="), F.col("visit_length").cast("string"),
        F.lit("|stepLength="), F.col("step_length").cast("string"),
        # repeated names, an empty value, an empty part and empty pieces at the end
        F.lit("|visitLength=0|stepLength=7|note=|tail="), F.col("visit_length").cast("string"), F.lit("=||"),
    )
    k = s.select("session_id", info.alias("info"))
    return k.select(
        "session_id",
        fs.kv_get("info", "searchKeywords").alias("search_keywords"),
        fs.kv_get("info", "visitLength").alias("visit_length"),
        fs.kv_get("info", "tail").alias("tail"),
        fs.kv_get("info", "note").alias("note"),
        fs.kv_set("info", "stepLength", "0").alias("reset_info"),
    )


@register("string_functions")
def _string_functions(spark, d):
    """F10 + F11: trim commas, pad to 2, emptiness, list split."""
    a = V.user_visit_action(spark, d)
    trimmed = fs.trim_comma(F.concat(F.lit(","), F.coalesce(fs.join_ids("order_category_ids"), F.lit("")), F.lit(",")))
    t = a.select("event_id", "page_id", "action_time", "search_keyword", trimmed.alias("trimmed"))
    return t.select(
        "event_id", "trimmed",
        fs.pad2(F.hour("action_time").cast("string")).alias("hour2"),
        fs.pad2(F.col("page_id").cast("string")).alias("page2"),
        fs.is_empty("search_keyword").alias("no_keyword"),
        F.size(fs.split_ids("trimmed")).alias("n_ids"),
        fs.join_ids(fs.split_ids("trimmed")).alias("ids"),
    )


@register("udf_concat_long_string")
def _udf_concat_long_string(spark, d):
    """D1 + D2 through the session SQL functions."""
    fu.register_sql_functions(spark)
    basic = _click_product_basic(spark, d).join(V.product_info(spark, d), "product_id")
    basic.createOrReplaceTempView("clickflow_clicks_city")
    return spark.sql("""SELECT product_id, concat_long_string(city_id, city_name, ':') AS city_info,
        json_field(extend_info, 'product_status') AS status_field FROM clickflow_clicks_city""")


@register("udaf_group_concat_distinct")
def _udaf_group_concat_distinct(spark, d):
    """D3: distinct sorted city names per product."""
    return _click_product_basic(spark, d).groupBy("product_id").agg(
        fu.group_concat_distinct("city_name").alias("city_names"))


# ---------------------------------------------------------------- ads (batch)
def _blacklist(spark, d):
    return ads.users_over_threshold(ads.user_ad_counts(V.ad_log(spark, d)), P.CLICK_THRESHOLD)


@register("ad_log_parse")
def _ad_log_parse(spark, d):
    """S7 + F7: parse the text log."""
    return ads.parse_ad_log(V.ad_log_lines(spark, d))


@register("ad_user_clicks")
def _ad_user_clicks(spark, d):
    """C11."""
    return ads.user_ad_counts(V.ad_log(spark, d))


@register("ad_blacklist_batch")
def _ad_blacklist_batch(spark, d):
    """P9 + C14."""
    return _blacklist(spark, d)


@register("blacklist_filter")
def _blacklist_filter(spark, d):
    """Clicks of users not on the list."""
    return ads.remove_blacklisted(V.ad_log(spark, d), _blacklist(spark, d)).select(
        "event_id", "ts", "province", "city", "user_id", "ad_id")


@register("ad_stat")
def _ad_stat(spark, d):
    """C12."""
    return ads.ad_stat(V.ad_log(spark, d))


@register("ad_province_clicks")
def _ad_province_clicks(spark, d):
    """C13."""
    return ads.province_counts(ads.ad_stat(V.ad_log(spark, d)))


@register("ad_province_top3")
def _ad_province_top3(spark, d):
    """W2."""
    return ads.province_top3(ads.province_counts(ads.ad_stat(V.ad_log(spark, d))))


@register("ad_click_trend")
def _ad_click_trend(spark, d):
    """A6 (batch form): clicks per minute and ad."""
    return ads.click_trend(V.ad_log(spark, d))


@register("ad_sliding_hour")
def _ad_sliding_hour(spark, d):
    """60 min windows every 10 min."""
    return ads.sliding_counts(V.ad_log(spark, d), P.WINDOW_MINUTES, P.SLIDE_MINUTES)


@register("ad_sliding_hour_10s")
def _ad_sliding_hour_10s(spark, d):
    """A7 in the reference's configuration: 60 min windows every 10 s."""
    return ads.sliding_counts(V.ad_log(spark, d), P.WINDOW_MINUTES, slide_seconds=P.SLIDE_SECONDS_REFERENCE)


# ---------------------------------------------------------------- sinks
from clickflow.sinks import batch_log as sk  # noqa: E402
from clickflow.streaming import ad_stream as ast  # noqa: E402
from clickflow.streaming import replay as rp  # noqa: E402

SINK_BATCHES = 3  # batch b of the sink queries: clicks with hour(ts) div 8 <= b (cumulative) or = b (delta)


def _sink_batch(log):
    return F.floor(F.hour("ts") / (24 // SINK_BATCHES))


@register("sink_append")
def _sink_append(spark, d):
    """K1: append three batches of clicks, read back."""
    path = scratch_dir(spark, "sink-append")
    log = V.ad_log(spark, d)
    for b in range(SINK_BATCHES):
        sk.append(log.where(_sink_batch(log) == b), path)
    return spark.read.schema(log.schema).parquet(path)


@register("sink_upsert_increment")
def _sink_upsert_increment(spark, d):
    """K3: per-batch (date, user, ad) deltas, read as sums."""
    store = sk.BatchLog(spark, scratch_dir(spark, "sink-incr"), ast.USER_CLICK_SCHEMA, ("date",))
    log = V.ad_log(spark, d)
    for b in range(SINK_BATCHES):
        delta = ads.user_ad_counts(log.where(_sink_batch(log) == b))
        store.write(delta.select("user_id", "ad_id", "click_count", "date"), b)
    store.write(ads.user_ad_counts(log.where(_sink_batch(log) == 0))
                .select("user_id", "ad_id", "click_count", "date"), 0)  # a replayed batch changes nothing
    return store.increments(ast.USER_KEYS, "click_count")


@register("sink_lookup")
def _sink_lookup(spark, d):
    """K5: the cumulative counts of the keys that the last batch touched."""
    store = sk.BatchLog(spark, scratch_dir(spark, "sink-lookup"), ast.USER_CLICK_SCHEMA, ("date",))
    log = V.ad_log(spark, d)
    for b in range(SINK_BATCHES):
        store.write(ads.user_ad_counts(log.where(_sink_batch(log) == b)).select("user_id", "ad_id", "click_count", "date"), b)
    return store.lookup(ads.user_ad_counts(log.where(_sink_batch(log) == SINK_BATCHES - 1)).select(*ast.USER_KEYS), ast.USER_KEYS, "click_count")


@register("sink_upsert_latest")
def _sink_upsert_latest(spark, d):
    """K2: per-batch running totals per (date, province, city, ad), read as latest."""
    store = sk.BatchLog(spark, scratch_dir(spark, "sink-latest"), ast.STAT_SCHEMA, ("date",))
    log = V.ad_log(spark, d)
    for b in range(SINK_BATCHES):
        running = ads.ad_stat(log.where(_sink_batch(log) <= b))
        store.write(running.select("province", "city", "ad_id", "click_count", "date"), b)
    return store.latest(ast.STAT_KEYS, "click_count")


@register("sink_replace_group")
def _sink_replace_group(spark, d):
    """K4: per-batch province top-3 of the running totals, read with group replacement."""
    store = sk.BatchLog(spark, scratch_dir(spark, "sink-replace"), ast.TOP_SCHEMA)
    log = V.ad_log(spark, d)
    for b in range(SINK_BATCHES):
        top = ads.province_top3(ads.province_counts(ads.ad_stat(log.where(_sink_batch(log) <= b))))
        store.write(top.select("province", "ad_id", "click_count", "date"), b)
    return store.replace_group(ast.GROUP_KEYS)


# ---------------------------------------------------------------- stream (T4)
DAYS_PER_BATCH = 5
_STREAM_RUNS: dict = {}
_STAGED: dict = {}


LATE_EVERY = 17  # of the replay with late clicks: each 17th arrives five days late


def staged_replay(spark, d, late_every=None) -> tuple[str, int]:
    """The ad log lines staged once per session and input folder, partitioned
    by producer batch (5 days each); returns (staging folder, batch count)."""
    key = (spark.sparkContext.applicationId, d, DAYS_PER_BATCH, late_every)
    if key not in _STAGED:
        inp = rp.ad_log_replay_lines(spark, d, DAYS_PER_BATCH, late_every)
        staging = f"{scratch_dir(spark, 'ad-replay')}/staging"
        rp.stage(inp.lines, staging)
        _STAGED[key] = (staging, inp.n_batches)
    return _STAGED[key]


def _replay(spark, d, root: str, runners, late_every=None) -> None:
    """Play the staged batches into ``root/source``; every runner (stream,
    checkpoint name) takes them one micro-batch each."""
    staging, n = staged_replay(spark, d, late_every)

    def query(r, c):
        return lambda files: r(ast.text_source(spark, f"{root}/source/*", files), f"{root}/{c}")

    rp.replay_in_one_run(spark, staging, f"{root}/source", n, [query(r, c) for r, c in runners])


def run_ad_stream(spark, d) -> ast.AdClickStats:
    """One full replay of the ad log through the ad task, in a fresh folder."""
    root = scratch_dir(spark, "ad-stream")
    stats = ast.AdClickStats(spark, f"{root}/out", P.CLICK_THRESHOLD)
    _replay(spark, d, root, [(stats.run_available, "checkpoint")])
    return stats


def _stream_run(spark, d) -> ast.AdClickStats:
    """The replay, run once per session and input folder; the stream queries
    read its stores."""
    key = (spark.sparkContext.applicationId, d, DAYS_PER_BATCH, P.CLICK_THRESHOLD)
    if key not in _STREAM_RUNS:
        _STREAM_RUNS[key] = run_ad_stream(spark, d)
    return _STREAM_RUNS[key]


_FILTER_RUNS: dict = {}


@register("ad_stream_filtered")
def _ad_stream_filtered(spark, d):
    """The replayed stream minus a list read from storage in every batch
    (the list: users over the threshold in the whole log, written once)."""
    key = (spark.sparkContext.applicationId, d, DAYS_PER_BATCH, P.CLICK_THRESHOLD)
    if key not in _FILTER_RUNS:
        root = scratch_dir(spark, "ad-filtered")
        _blacklist(spark, d).write.parquet(f"{root}/list")
        flt = ast.FilteredClicks(spark, f"{root}/list", f"{root}/out")
        _replay(spark, d, root, [(flt.run_available, "checkpoint")])
        _FILTER_RUNS[key] = flt
    return _FILTER_RUNS[key].view().select("ts", "date", "province", "city", "user_id", "ad_id")


@register("ad_stream_user_clicks")
def _ad_stream_user_clicks(spark, d):
    """A2 + K3: cumulative (date, user, ad) clicks after the replay."""
    return _stream_run(spark, d).user_click_view()


@register("ad_stream_blacklist")
def _ad_stream_blacklist(spark, d):
    """A3: users listed by the dynamic blacklist."""
    return _stream_run(spark, d).blacklist_view()


@register("ad_stream_stat")
def _ad_stream_stat(spark, d):
    """A4: running clicks per (date, province, city, ad) of non-listed clicks."""
    return _stream_run(spark, d).stat_view()


@register("ad_stream_province_top3")
def _ad_stream_province_top3(spark, d):
    """A5 + K4: top-3 ads per (date, province) on the running totals."""
    return _stream_run(spark, d).province_top_view()


@register("ad_stream_trend")
def _ad_stream_trend(spark, d):
    """Clicks per event minute and ad."""
    t = _stream_run(spark, d).trend_view()
    return t.select(
        F.date_format("minute", "yyyy-MM-dd").alias("date"),
        F.date_format("minute", "HH").alias("hour"),
        F.date_format("minute", "mm").alias("minute"),
        "ad_id", "click_count",
    )


@register("ad_stream_trend_last_hour")
def _ad_stream_trend_last_hour(spark, d):
    """A6 as the reference keeps it: the last minutes (ending at the newest
    minute seen) with their clicks per ad."""
    t = _stream_run(spark, d).trend_view(last_minutes=P.LAST_MINUTES)
    return t.select(
        F.date_format("minute", "yyyy-MM-dd").alias("date"),
        F.date_format("minute", "HH").alias("hour"),
        F.date_format("minute", "mm").alias("minute"),
        "ad_id", "click_count",
    )


# ---------------------------------------------------------------- stream, state store (A4 / A6 without blacklist)
_STATEFUL_RUNS: dict = {}


def run_stateful(spark, d) -> tuple[sk.BatchLog, sk.BatchLog, sk.BatchLog]:
    """Replay the ad log, with late clicks, through the state-store aggregations
    (update mode); each micro-batch's updated rows go to an upsert log (K2)."""
    root = scratch_dir(spark, "ad-stateful")
    stat_log = sk.BatchLog(spark, f"{root}/stat", "date date, province string, city string, ad_id bigint, "
                                                  "click_count bigint")
    trend_log = sk.BatchLog(spark, f"{root}/trend", ast.TREND_SCHEMA)
    pane_log = sk.BatchLog(spark, f"{root}/panes", ads.SLOTS_SCHEMA, ("date",), lambda lg, df: lg.latest(["date", "slot", "ad_id"], "click_count", df), 720)

    def panes(parsed):
        return ast.pane_counts(parsed, P.SLIDE_SECONDS_REFERENCE)

    def run(query, log):
        def go(lines, ckpt):
            with ast.rocksdb_state(spark):
                (query(ads.parse_ad_log(lines)).writeStream.outputMode("update")
                 .foreachBatch(lambda df, b: log.write(df, b))
                 .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())
        return go

    _replay(spark, d, root, [(run(ast.stateful_ad_stat, stat_log), "ckpt-stat"),
                             (run(ast.windowed_trend, trend_log), "ckpt-trend"),
                             (run(panes, pane_log), "ckpt-panes")], LATE_EVERY)
    return stat_log, trend_log, pane_log


def _stateful_run(spark, d):
    """``run_stateful``, once per session and input folder; the queries read its stores."""
    key = (spark.sparkContext.applicationId, d, DAYS_PER_BATCH)
    if key not in _STATEFUL_RUNS:
        _STATEFUL_RUNS[key] = run_stateful(spark, d)
    return _STATEFUL_RUNS[key]


@register("ad_stream_stateful_stat")
def _ad_stream_stateful_stat(spark, d):
    """A4 on the state store: running clicks per (date, province, city, ad)."""
    stat_log = _stateful_run(spark, d)[0]
    return stat_log.latest(ast.STAT_KEYS, "click_count").select("date", "province", "city", "ad_id", "click_count")


@register("ad_stream_window_trend")
def _ad_stream_window_trend(spark, d):
    """A6 on event-time windows, late clicks included: clicks per minute and ad."""
    t = _stateful_run(spark, d)[1].latest(["minute", "ad_id"], "click_count")
    return t.select(F.date_format("minute", "yyyy-MM-dd").alias("date"), F.date_format("minute", "HH").alias("hour"),
                    F.date_format("minute", "mm").alias("minute"), "ad_id", "click_count")


def _stream_windows(spark, d, slide_seconds):
    panes = _stateful_run(spark, d)[2].latest(["date", "slot", "ad_id"], "click_count")
    return ads.windows_of_panes(panes, P.SLIDE_SECONDS_REFERENCE, P.WINDOW_MINUTES, slide_seconds)


@register("ad_stream_sliding_hour")
def _ad_stream_sliding_hour(spark, d):
    """A7 as a stream: 60 min windows every 10 min, late clicks included, from 10 s panes."""
    return _stream_windows(spark, d, P.SLIDE_MINUTES * 60)


@register("ad_stream_sliding_hour_10s")
def _ad_stream_sliding_hour_10s(spark, d):
    """A7 as a stream in the reference's configuration: 60 min windows every 10 s, from the same panes."""
    return _stream_windows(spark, d, P.SLIDE_SECONDS_REFERENCE)


@register("date_today")
def _date_today(spark, d):
    """today / yesterday against the events' dates (days since each event)."""
    e = table(spark, d, "events")
    return e.select("event_id", fd.today_date().alias("today"), fd.yesterday_date().alias("yesterday"),
                    F.datediff(F.current_date(), F.col("ts").cast("date")).alias("days_ago"))
