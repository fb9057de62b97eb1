"""Task parameters.

A task row carries ``task_param``: a JSON object whose values are arrays of
one string; multi-values are comma-joined inside that string, e.g.
``{"startAge": ["10"], "cities": ["city1,city2"]}``. Parameter names are the
reference's (fixed values): startDate, endDate, startAge, endAge,
professionals, cities, sex, keywords, categoryIds, targetPageFlow.

The lookup itself is a filter on the task table plus ``from_json``; only the
one selected row's parameters reach the driver (they configure the plan).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARAM_NAMES = ("startDate", "endDate", "startAge", "endAge", "professionals", "cities", "sex",
               "keywords", "categoryIds", "targetPageFlow")

PARAM_TYPE = "map<string, array<string>>"


@dataclass
class TaskParams:
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: list[str] | None = None
    cities: list[str] | None = None
    sex: list[str] | None = None
    keywords: list[str] | None = None
    category_ids: list[str] | None = None
    target_page_flow: list[int] = field(default_factory=list)

    @staticmethod
    def from_map(m: dict) -> "TaskParams":
        def first(name):
            v = (m or {}).get(name)
            if not v:
                return None
            s = v[0]
            return None if s is None or s == "" else s

        def lst(name):
            s = first(name)
            if s is None:
                return None
            toks = [t for t in s.split(",") if t != ""]
            return toks or None

        def num(name):
            s = first(name)
            return None if s is None else int(s)

        flow = lst("targetPageFlow") or []
        return TaskParams(
            start_date=first("startDate"), end_date=first("endDate"),
            start_age=num("startAge"), end_age=num("endAge"),
            professionals=lst("professionals"), cities=lst("cities"), sex=lst("sex"),
            keywords=lst("keywords"), category_ids=lst("categoryIds"),
            target_page_flow=[int(x) for x in flow],
        )


def parse_task_params(tasks: DataFrame) -> DataFrame:
    """Add ``params`` (map<string, array<string>>) parsed from ``task_param``."""
    return tasks.withColumn("params", F.from_json("task_param", PARAM_TYPE))


def param_columns(tasks: DataFrame) -> DataFrame:
    """One column per parameter name: element 0 of its array (null if absent)."""
    p = parse_task_params(tasks)
    return p.select("task_id", *[F.try_element_at(F.col("params")[n], F.lit(1)).alias(n) for n in PARAM_NAMES])


def param_values(tasks: DataFrame) -> DataFrame:
    """Typed parameters of every task, one row each: task_id, start_date, end_date, start_age, end_age and the lists
    professionals, cities, sex, keywords (text) and category_ids; null where a task doesn't set one, as in ``TaskParams``."""
    def tokens(name):
        found = F.array_distinct(F.filter(F.split(F.col(name), ","), lambda t: t != ""))
        return F.when(F.size(found) > 0, found)

    def given(name):
        return F.nullif(F.col(name), F.lit(""))

    return param_columns(tasks).select(
        "task_id", given("startDate").alias("start_date"), given("endDate").alias("end_date"),
        given("startAge").cast("int").alias("start_age"), given("endAge").cast("int").alias("end_age"),
        tokens("professionals").alias("professionals"), tokens("cities").alias("cities"), tokens("sex").alias("sex"), tokens("keywords").alias("keywords"),
        F.transform(tokens("categoryIds"), lambda t: t.try_cast("bigint")).alias("category_ids"))


def lookup_task(tasks: DataFrame, task_id: int) -> TaskParams:
    """Parameters of one task; raises when the task does not exist or its id stands for different ones."""
    rows = parse_task_params(tasks.where(F.col("task_id") == task_id)).select("params").limit(2).collect()
    if len(rows) != 1:
        raise LookupError(f"{'several tasks' if rows else 'no task'} with id {task_id}")
    return TaskParams.from_map(rows[0]["params"])
