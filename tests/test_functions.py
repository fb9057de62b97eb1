import datetime as dt

from pyspark.sql import functions as F

from clickflow.functions import dates as fd
from clickflow.functions import strings as fs
from clickflow.functions import udfs as fu
from clickflow.functions.numbers import ratio2
from clickflow.sources.task_params import TaskParams, lookup_task, param_columns


def test_ratio2_half_up_in_integers(spark):
    df = spark.createDataFrame([(0, 1), (1, 3), (2, 3), (57, 200), (1, 8), (5, 0)], "n long, d long")
    got = dict(((r.n, r.d), r.r) for r in df.select("n", "d", ratio2("n", "d").alias("r")).collect())
    assert got == {(0, 1): 0.0, (1, 3): 0.33, (2, 3): 0.67, (57, 200): 0.29, (1, 8): 0.13, (5, 0): None}
    # the Column form gives the same values
    got2 = [r.r for r in df.select(ratio2(F.col("n"), F.col("d")).alias("r")).collect()]
    assert got2 == [0.0, 0.33, 0.67, 0.29, 0.13, None]


def test_kv_get_and_set(spark):
    df = spark.createDataFrame([("a=1|b=|c=3|a=9",), ("x=1",), (None,), ("c=1=|c=2|a=1=2|a=7==||",)], "s string")
    out = df.select(fs.kv_get("s", "a").alias("a"), fs.kv_get("s", "b").alias("b"),
                    fs.kv_get("s", "c").alias("c"), fs.kv_set("s", "c", "7").alias("set")).collect()
    assert (out[0].a, out[0].b, out[0].c, out[0].set) == ("1", None, "3", "a=1|b=|c=7|a=9")
    assert (out[1].a, out[1].set) == (None, "x=1")
    assert out[2].a is None
    assert (out[3].a, out[3].c, out[3].set) == ("7", "1", "c=7|c=2|a=1=2|a=7==")


def test_string_helpers(spark):
    df = spark.createDataFrame([(",1,2,", "5", None), ("1,,12", "12", ""), ("", "123", "kw")],
                               "s string, h string, k string")
    out = df.select(fs.trim_comma("s").alias("t"), fs.pad2("h").alias("p"), fs.is_empty("k").alias("e"),
                    fs.split_ids("s").alias("ids")).collect()
    assert [r.t for r in out] == ["1,2", "1,,12", ""]
    assert [r.p for r in out] == ["05", "12", "0123"]
    assert [r.e for r in out] == [True, True, False]
    assert [r.ids for r in out] == [[1, 2], [1, 12], []]


def test_date_functions(spark):
    df = spark.createDataFrame([("2024-01-05 07:08:09", "20240105"), ("bad", "2024-01-05")], "t string, k string")
    out = df.select(
        fd.date_hour(fd.parse_time("t")).alias("dh"), fd.format_minute(fd.parse_time("t")).alias("m"),
        fd.parse_datekey("k").alias("d"), fd.time_before("t", F.lit("2024-01-06 00:00:00")).alias("b"),
        fd.time_after("t", F.lit("2024-01-06 00:00:00")).alias("a"),
        fd.time_minus_seconds("t", F.lit("2024-01-05 07:00:00")).alias("diff"),
        fd.hour_part(fd.parse_time("t")).alias("h"),
    ).collect()
    assert (out[0].dh, out[0].m, out[0].d, out[0].b, out[0].a, out[0].diff, out[0].h) == \
        ("2024-01-05_07", "202401050708", dt.date(2024, 1, 5), True, False, 489, "7")
    assert (out[1].dh, out[1].d, out[1].b, out[1].a, out[1].diff) == (None, None, False, False, 0)


def test_udf_equivalents_and_sql_registration(spark):
    df = spark.createDataFrame([(1, "a", '{"product_status": 0}'), (None, None, "not json"), (1, "a", "{}")],
                               "id long, name string, js string")
    out = df.select(fu.concat_long_string("id", "name", ":").alias("c"), fu.json_field("js", "product_status")
                    .alias("s")).collect()
    assert [r.c for r in out] == ["1:a", "null:null", "1:a"]
    assert [r.s for r in out] == ["0", None, None]
    g = df.agg(fu.group_concat_distinct("name").alias("g")).first().g
    assert g == "a"
    fu.register_sql_functions(spark)
    r = spark.sql("SELECT concat_long_string(12, 'x', ':') AS c, json_field('{\"a\": 1}', 'a') AS j").first()
    assert (r.c, r.j) == ("12:x", "1")


def test_group_concat_distinct_is_true_distinct(spark):
    # substring-based dedupe would lose "1" after "12"
    df = spark.createDataFrame([("12",), ("1",), ("12",), ("2",)], "x string")
    assert df.agg(fu.group_concat_distinct("x").alias("g")).first().g == "1,12,2"


def test_task_params(spark):
    tasks = spark.createDataFrame([
        (1, '{"startAge": ["10"], "endAge": ["50"], "cities": ["c1,c2"], "targetPageFlow": ["1,2,5"],'
            ' "keywords": [""]}'),
        (2, "{}"),
    ], "task_id long, task_param string")
    p = lookup_task(tasks, 1)
    assert p == TaskParams(start_age=10, end_age=50, cities=["c1", "c2"], target_page_flow=[1, 2, 5])
    assert lookup_task(tasks, 2) == TaskParams()
    cols = param_columns(tasks).where("task_id = 1").first()
    assert cols.startAge == "10" and cols.professionals is None
    try:
        lookup_task(tasks, 3)
        raise AssertionError("expected LookupError")
    except LookupError:
        pass
