"""The reference's jobs as task entry points.

Each task takes its inputs as DataFrames plus ``TaskParams`` (see
``clickflow.sources.task_params.lookup_task``), builds one lazy plan per
output table and writes them with the append sink.

The session task reuses two intermediate tables across its outputs. Both are
cut from their lineage with a reliable ``checkpoint()`` into the shared
folder named by ``spark.checkpoint.dir``, so an executor lost later costs a
re-read of those files, not a new pass over the actions:
  * the filtered sessions (one row per session): statistics, sample, and the
    key set of every detail join;
  * click/order/pay counts per (category, session), built in one pass over
    the surviving sessions' actions: the category ranking and the session
    ranking.
The action rows themselves are never held: the two row-level outputs are
semi-joins of the actions with bounded key sets (the sample, at most
``sample_size`` sessions; the top sessions, at most n * k).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.operators import categories as cat
from clickflow.operators import funnel as fun
from clickflow.operators import products as prod
from clickflow.operators import sampling as smp
from clickflow.operators import sessions as ses
from clickflow.session import checkpoint_root
from clickflow.sinks.batch_log import append
from clickflow.sources.task_params import TaskParams


def _in_range(actions: DataFrame, p: TaskParams) -> DataFrame:
    if p.start_date is None or p.end_date is None:
        return actions
    return actions.where(F.col("date").between(F.lit(p.start_date).cast("date"), F.lit(p.end_date).cast("date")))


def session_task_outputs(actions: DataFrame, users: DataFrame, p: TaskParams, task_id: int,
                         sample_size: int = 100, seed: str = "42", unit_seconds: int = 1,
                         top_categories: int = 10, top_sessions: int = 10,
                         step_buckets: list[tuple] = ses.STEP_BUCKETS) -> dict[str, DataFrame]:
    """session_aggr_stat, session_random_extract, session_detail (of the
    sample), top10_category, top10_category_session, and the detail rows of
    the top sessions. Runs two jobs (the checkpoints); the outputs are lazy."""
    checkpoint_root(actions.sparkSession)  # the shared folder (set only where unset, as in tests)
    scoped = _in_range(actions, p)
    # ids, times and lengths only: without the keyword and category sets in the output none is collected
    sessions = ses.filter_sessions(ses.full_session_aggregates(scoped, users, p), p).select(
        "session_id", "start_time", "visit_length", "step_length").checkpoint()
    cs = cat.category_session_counts(ses.session_detail(scoped, sessions)).checkpoint()
    tid = F.lit(int(task_id)).alias("task_id")
    stat = ses.session_statistics(sessions, unit_seconds, step_buckets).select(tid, "*")
    sampled = smp.random_extract(sessions, sample_size, seed)
    sample_rows = smp.sample_detail(sampled, scoped)
    top = cat.top_categories(cat.counts_from_session_counts(cs), top_categories)
    tops = cat.rank_sessions(cat.clicks_from_session_counts(cs), top, top_sessions)
    return {
        "session_aggr_stat": stat,
        "session_random_extract": ses.session_aggregates(sample_rows).select(tid, "session_id", "start_time", "search_keywords",
                                                                             "click_category_ids"),
        "session_detail": sample_rows.select(tid, "*"),
        "top10_category": top.select(tid, "*"),
        "top10_category_session": tops.select(tid, "*"),
        "top10_session_detail": cat.top_session_detail(tops, scoped).select(tid, "*"),
    }


def page_task_output(actions: DataFrame, p: TaskParams, task_id: int) -> DataFrame:
    """The ``a_b=rate|...`` string of the task's page flow."""
    rates = fun.conversion_rates(fun.page_transitions(_in_range(actions, p)), p.target_page_flow)
    return fun.rate_string(rates).select(F.lit(int(task_id)).alias("task_id"), "convert_rate")


def product_task_output(actions: DataFrame, cities: DataFrame, products: DataFrame, p: TaskParams,
                        task_id: int, levels: dict | None = None) -> DataFrame:
    """Top-3 products per area."""
    top = prod.area_top3_products(actions, cities, products, p.start_date, p.end_date, levels=levels)
    return top.select(F.lit(int(task_id)).alias("task_id"), "*")


def run_session_task(actions, users, p: TaskParams, task_id: int, out_root: str, **kw) -> None:
    for name, df in session_task_outputs(actions, users, p, task_id, **kw).items():
        append(df, f"{out_root.rstrip('/')}/{name}")


def run_page_task(actions, p: TaskParams, task_id: int, out_root: str) -> None:
    append(page_task_output(actions, p, task_id), f"{out_root.rstrip('/')}/page_split_convert_rate")


def run_product_task(actions, cities, products, p: TaskParams, task_id: int, out_root: str,
                     levels: dict | None = None) -> None:
    append(product_task_output(actions, cities, products, p, task_id, levels), f"{out_root.rstrip('/')}/area_top3_product")
