"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly over the raw tables (``events``, ``customer``, ``nation``,
``region``, ``part``); the adapter views are CTEs with the same mapping as
``clickflow.sources.views``. Output types follow ``clickflow.plans.present``:
dates and timestamps as strings, lists as comma-joined strings, counts BIGINT.
"""

from __future__ import annotations

from clickflow.plans import params as P

BASE = """
e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
uva AS (SELECT
  event_id,
  CAST(ts AS DATE) AS date,
  user_id,
  concat(CAST(user_id AS VARCHAR), '_', strftime(ts, '%Y%m%d')) AS session_id,
  k % 10 AS page_id,
  CAST(date_trunc('second', ts) AS TIMESTAMP) AS action_time,
  CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 10 AS VARCHAR)) END AS search_keyword,
  CASE WHEN event_type = 'click' THEN k END AS click_category_id,
  CASE WHEN event_type = 'click' THEN event_id % 200 END AS click_product_id,
  CASE WHEN event_type = 'purchase' THEN list_value(k, (k + 1) % 100) END AS order_category_ids,
  CASE WHEN event_type = 'purchase' THEN list_value(event_id % 200, (event_id + 1) % 200) END AS order_product_ids,
  CASE WHEN event_type = 'signup' THEN list_value(k) END AS pay_category_ids,
  CASE WHEN event_type = 'signup' THEN list_value(event_id % 200) END AS pay_product_ids,
  user_id % 25 AS city_id
FROM e),
user_info AS (SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
  CAST(c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional, n_name AS city,
  CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 10 <> 3),
product_info AS (SELECT p_partkey AS product_id, p_name AS product_name,
  concat('{"product_status": ', CAST(p_partkey % 2 AS VARCHAR), '}') AS extend_info FROM part
  WHERE p_partkey % 7 <> 5),
city_info AS (SELECT n_nationkey AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 24),
ad_log AS (SELECT e.event_id, e.ts, r_name AS province, n_name AS city, e.user_id, e.k % 10 AS ad_id
  FROM e JOIN nation ON e.user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE e.event_type = 'click' AND n_nationkey <> 24)
"""


def q(*ctes_and_body: str) -> str:
    """``WITH <BASE>, <extra CTEs> <body>``."""
    *ctes, body = ctes_and_body
    extra = "".join(",\n" + c for c in ctes)
    return f"WITH {BASE}{extra}\n{body}"


def _list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def _d(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d')"


def _ratio(n: str, d: str) -> str:
    return f"CASE WHEN ({d}) <> 0 THEN ((200 * ({n}) + ({d})) // (2 * ({d}))) / 100.0 END"


# ---------------------------------------------------------------- products
def _area_level_sql(col: str) -> str:
    from clickflow.operators.products import DEFAULT_AREA_LEVELS, OTHER_LEVEL
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in DEFAULT_AREA_LEVELS.items())
    return f"CASE {whens} ELSE '{OTHER_LEVEL}' END"


_PRODUCT_CTES = (
    f"""clicks AS (SELECT city_id, click_product_id AS product_id FROM uva
      WHERE click_product_id IS NOT NULL AND date BETWEEN DATE '{P.START_DATE}' AND DATE '{P.END_DATE}')""",
    """basic AS (SELECT k.city_id, c.city_name, c.area, k.product_id FROM clicks k JOIN city_info c ON k.city_id = c.city_id)""",
    """g AS (SELECT area, product_id, CAST(count(*) AS BIGINT) AS click_count,
        string_agg(DISTINCT concat(CAST(city_id AS VARCHAR), ':', city_name), ','
                   ORDER BY concat(CAST(city_id AS VARCHAR), ':', city_name)) AS city_infos
      FROM basic GROUP BY area, product_id)""",
    """f AS (SELECT g.*, p.product_name,
        CASE WHEN json_extract_string(p.extend_info, '$.product_status') = '0' THEN 'Self' ELSE 'Third Party' END
          AS product_status
      FROM g JOIN product_info p ON g.product_id = p.product_id)""",
)

SQL = {}

SQL["clicks_by_date"] = q(_PRODUCT_CTES[0], "SELECT city_id, product_id FROM clicks")
SQL["click_product_basic"] = q(*_PRODUCT_CTES[:2], "SELECT city_id, city_name, area, product_id FROM basic")
SQL["area_product_count"] = q(*_PRODUCT_CTES[:3], "SELECT area, product_id, click_count, city_infos FROM g")
SQL["area_product_full"] = q(*_PRODUCT_CTES,
                             "SELECT area, product_id, click_count, city_infos, product_name, product_status FROM f")
SQL["area_top3_product"] = q(
    *_PRODUCT_CTES,
    "r AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rn FROM f)",
    f"""SELECT area, {_area_level_sql('area')} AS area_level, product_id, click_count, city_infos,
        product_name, product_status FROM r WHERE rn <= 3""",
)
SQL["product_status"] = q(
    """SELECT product_id,
       CASE WHEN json_extract_string(extend_info, '$.product_status') = '0' THEN 'Self' ELSE 'Third Party' END
         AS product_status FROM product_info""")


# ---------------------------------------------------------------- sessions
def _sess_cte(name: str, src: str) -> str:
    return f"""{name} AS (SELECT session_id, min(user_id) AS user_id,
        list_sort(list_distinct(list(search_keyword))) AS search_keywords,
        list_sort(list_distinct(list(click_category_id))) AS click_category_ids,
        min(action_time) AS start_time, max(action_time) AS end_time,
        date_diff('second', min(action_time), max(action_time)) AS visit_length,
        count(*) AS step_length
      FROM {src} GROUP BY session_id)"""


_RANGE = f"date BETWEEN DATE '{P.START_DATE}' AND DATE '{P.END_DATE}'"
_ACTIONS_R = f"ar AS (SELECT * FROM uva WHERE {_RANGE})"
_SESS_COLS = ("session_id, user_id, array_to_string(search_keywords, ',') AS search_keywords, "
              "array_to_string(click_category_ids, ',') AS click_category_ids, "
              f"{_ts('start_time')} AS start_time, {_ts('end_time')} AS end_time, visit_length, step_length")
_FULL_CTE = """full_s AS (SELECT s.*, u.age, u.professional, u.city, u.sex
      FROM sr s JOIN user_info u ON s.user_id = u.user_id)"""
_FILTER_CTE = f"""fs AS (SELECT * FROM full_s WHERE age BETWEEN {P.START_AGE} AND {P.END_AGE}
      AND professional IN ({_list(P.PROFESSIONALS)}) AND city IN ({_list(P.CITIES)})
      AND sex IN ({_list(P.SEXES)})
      AND list_has_any(search_keywords, [{_list(P.KEYWORDS)}])
      AND list_has_any(click_category_ids, [{_list(P.CATEGORY_IDS)}]::BIGINT[]))"""
_DETAIL_CTE = "detail AS (SELECT * FROM ar WHERE session_id IN (SELECT session_id FROM fs))"
_T1 = (_ACTIONS_R, _sess_cte("sr", "ar"), _FULL_CTE, _FILTER_CTE, _DETAIL_CTE)

_ACTION_COLS = ("event_id, " + _d("date") + " AS date, user_id, session_id, page_id, "
                + _ts("action_time") + " AS action_time, search_keyword, CAST(click_category_id AS VARCHAR) AS click_category_id, "
                "CAST(click_product_id AS VARCHAR) AS click_product_id, "
                "array_to_string(order_category_ids, ',') AS order_category_ids, "
                "array_to_string(order_product_ids, ',') AS order_product_ids, "
                "array_to_string(pay_category_ids, ',') AS pay_category_ids, "
                "array_to_string(pay_product_ids, ',') AS pay_product_ids, city_id")


def _bucket_sql(col: str, lo: int, hi, inc: bool) -> str:
    cond = f"{col} >= {lo}"
    if hi is not None:
        cond += f" AND {col} {'<=' if inc else '<'} {hi}"
    return f"CAST(count_if({cond}) AS BIGINT)"


def _hist_cols(kind: str) -> list[tuple[str, str]]:
    from clickflow.operators.sessions import VISIT_BUCKETS
    if kind == "visit":
        v = f"(visit_length // {P.VISIT_UNIT_SECONDS})"
        return [(f"visit_{n}", _bucket_sql(v, lo, hi, inc)) for n, lo, hi, inc in VISIT_BUCKETS]
    return [(f"step_{n}", _bucket_sql("step_length", lo, hi, inc)) for n, lo, hi, inc in P.STEP_BUCKETS]


SQL["actions_by_date"] = q(_ACTIONS_R, f"SELECT {_ACTION_COLS} FROM ar")
SQL["stored_actions"] = q(f"SELECT {_ACTION_COLS.replace('event_id, ', '', 1)} FROM uva")
SQL["stored_actions_by_day"] = q(_ACTIONS_R, f"SELECT {_ACTION_COLS.replace('event_id, ', '', 1)} FROM ar")
SQL["session_agg"] = q(_sess_cte("s", "uva"), f"SELECT {_SESS_COLS} FROM s")
SQL["session_full_agg"] = q(*_T1[:3], f"SELECT {_SESS_COLS}, age, professional, city, sex FROM full_s")
SQL["session_filter"] = q(*_T1[:4], f"SELECT {_SESS_COLS}, age, professional, city, sex FROM fs")
SQL["session_filter_equal"] = q(*_T1[:3], "SELECT session_id, sex FROM full_s WHERE sex = 'female'")
SQL["session_filter_all_tasks"] = q(*_T1[:3], """SELECT t.user_id AS task_id, s.session_id, s.visit_length, s.step_length
    FROM user_info t JOIN full_s s ON s.age BETWEEN greatest(t.age - 5, 0) AND t.age + 5
      AND s.professional = t.professional AND s.city = t.city AND s.sex = t.sex
    WHERE (t.user_id % 2 <> 0 OR list_has_any(s.search_keywords,
             [concat('kw', CAST(t.user_id % 10 AS VARCHAR)), concat('kw', CAST((t.user_id + 1) % 10 AS VARCHAR))]))
      AND (t.user_id % 3 = 0 OR list_has_any(s.click_category_ids, [t.user_id % 100, (t.user_id + 7) % 100]))""")
SQL["visit_length_hist"] = q(_sess_cte("s", "uva"), "SELECT count(*) AS session_count, "
                             + ", ".join(f"{e} AS {n}" for n, e in _hist_cols("visit")) + " FROM s")
SQL["step_length_hist"] = q(_sess_cte("s", "uva"), "SELECT count(*) AS session_count, "
                            + ", ".join(f"{e} AS {n}" for n, e in _hist_cols("step")) + " FROM s")
SQL["session_aggr_stat"] = q(*_T1[:4], "SELECT count(*) AS session_count, "
                             + ", ".join(f"{_ratio(e, 'count(*)')} AS {n}_ratio"
                                         for n, e in _hist_cols("visit") + _hist_cols("step")) + " FROM fs")
SQL["session_detail"] = q(*_T1, f"SELECT {_ACTION_COLS} FROM detail")


# ---------------------------------------------------------------- categories
_KINDS_CTE = """kinds AS (
      SELECT click_category_id AS category_id, 'click' AS kind FROM detail WHERE click_category_id IS NOT NULL
      UNION ALL SELECT unnest(order_category_ids), 'order' FROM detail WHERE order_category_ids IS NOT NULL
      UNION ALL SELECT unnest(pay_category_ids), 'pay' FROM detail WHERE pay_category_ids IS NOT NULL)"""
_COUNTS_CTE = """cc AS (SELECT category_id, CAST(count_if(kind = 'click') AS BIGINT) AS click_count,
      CAST(count_if(kind = 'order') AS BIGINT) AS order_count, CAST(count_if(kind = 'pay') AS BIGINT) AS pay_count
      FROM kinds WHERE category_id IS NOT NULL GROUP BY category_id)"""
_TOP10_CTE = """top10 AS (SELECT * FROM cc ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id
      LIMIT 10)"""
_SCC_CTE = """scc AS (SELECT click_category_id AS category_id, session_id, count(*) AS click_count
      FROM detail WHERE click_category_id IS NOT NULL GROUP BY 1, 2)"""
_TOPS_CTE = f"""tops AS (SELECT category_id, session_id, click_count FROM (
      SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn
      FROM scc WHERE category_id IN (SELECT category_id FROM top10)) WHERE rn <= {P.TOP_SESSIONS})"""

SQL["category_clicks"] = q(*_T1, """SELECT click_category_id AS category_id, count(*) AS click_count
    FROM detail WHERE click_category_id IS NOT NULL GROUP BY 1""")
SQL["category_orders"] = q(*_T1, _KINDS_CTE, """SELECT category_id, count(*) AS order_count
    FROM kinds WHERE kind = 'order' AND category_id IS NOT NULL GROUP BY 1""")
SQL["category_pays"] = q(*_T1, _KINDS_CTE, """SELECT category_id, count(*) AS pay_count
    FROM kinds WHERE kind = 'pay' AND category_id IS NOT NULL GROUP BY 1""")
SQL["visited_categories"] = q(*_T1, _KINDS_CTE,
                              "SELECT DISTINCT category_id FROM kinds WHERE category_id IS NOT NULL")
SQL["category_counts"] = q(*_T1, _KINDS_CTE, _COUNTS_CTE, "SELECT * FROM cc")
SQL["category_counts_join"] = SQL["category_counts"]
SQL["top10_category"] = q(*_T1, _KINDS_CTE, _COUNTS_CTE, _TOP10_CTE, "SELECT * FROM top10")
SQL["session_category_clicks"] = q(*_T1, _SCC_CTE, "SELECT * FROM scc")
SQL["top10_session"] = q(*_T1, _KINDS_CTE, _COUNTS_CTE, _TOP10_CTE, _SCC_CTE, _TOPS_CTE, "SELECT * FROM tops")
SQL["top10_session_detail"] = q(
    *_T1, _KINDS_CTE, _COUNTS_CTE, _TOP10_CTE, _SCC_CTE, _TOPS_CTE,
    "SELECT t.category_id, " + ", ".join(
        f"d.{c.strip()}" if " AS " not in c else c.replace("(", "(d.", 1)
        for c in []) + _ACTION_COLS.replace("event_id,", "d.event_id,", 1).replace(
        "session_id, page_id", "d.session_id, page_id", 1)
    + " FROM tops t JOIN detail d ON t.session_id = d.session_id")


# ---------------------------------------------------------------- funnel
def _funnel_ctes() -> tuple[str, ...]:
    f = P.PAGE_FLOW
    lagged = """lagged AS (SELECT *, lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id)
      AS prev FROM ar)"""
    parts = [f"SELECT 0 AS step, count(*) AS pv FROM lagged WHERE page_id = {f[0]}"]
    for i in range(1, len(f)):
        parts.append(f"SELECT {i}, count(*) FROM lagged WHERE prev = {f[i - 1]} AND page_id = {f[i]}")
    m = "m AS (" + " UNION ALL ".join(parts) + ")"
    names = " ".join(f"WHEN {i} THEN '{f[i - 1]}_{f[i]}'" for i in range(1, len(f)))
    t = f"""t AS (SELECT step, CASE step {names} END AS page_pair, pv AS pair_count,
      lag(pv) OVER (ORDER BY step) AS prev_count FROM m)"""
    r = f"""r AS (SELECT step, page_pair, pair_count, prev_count,
      {_ratio('pair_count', 'prev_count')} AS convert_rate FROM t WHERE step > 0)"""
    return (_ACTIONS_R, lagged, m, t, r)


SQL["page_pair_counts"] = q(*_funnel_ctes(), "SELECT step, page_pair, pair_count FROM r")
SQL["page_convert_rate"] = q(*_funnel_ctes(), "SELECT * FROM r")
SQL["page_convert_rate_string"] = q(*_funnel_ctes(), """SELECT string_agg(concat(page_pair, '=',
    coalesce(CAST(convert_rate AS VARCHAR), 'null')), '|' ORDER BY step) AS convert_rate FROM r""")


# ---------------------------------------------------------------- sampling
_SAMPLE_CTES = (
    _sess_cte("se", "uva"),
    "h AS (SELECT CAST(start_time AS DATE) AS d, hour(start_time) AS hr, count(*) AS c FROM se GROUP BY 1, 2)",
    "nd AS (SELECT count(DISTINCT d) AS n FROM h)",
    f"""qt AS (SELECT d, hr, least(c, (c * ({P.SAMPLE_SIZE} // n)) // (sum(c) OVER (PARTITION BY d))) AS quota
      FROM h, nd)""",
    f"""k AS (SELECT se.*, CAST(start_time AS DATE) AS d, hour(start_time) AS hr,
      row_number() OVER (PARTITION BY CAST(start_time AS DATE), hour(start_time)
                         ORDER BY md5(concat(session_id, '{P.SAMPLE_SEED}')), session_id) AS rn FROM se)""",
    "picked AS (SELECT k.* FROM k JOIN qt ON k.d = qt.d AND k.hr = qt.hr WHERE rn <= quota)",
)
SQL["sessions_per_hour"] = q(_sess_cte("se", "uva"), """SELECT strftime(start_time, '%Y-%m-%d_%H') AS date_hour,
    count(*) AS session_count FROM se GROUP BY 1""")
SQL["session_random_extract"] = q(*_SAMPLE_CTES, f"""SELECT session_id, {_ts('start_time')} AS start_time,
    array_to_string(search_keywords, ',') AS search_keywords,
    array_to_string(click_category_ids, ',') AS click_category_ids FROM picked""")
SQL["sample_detail"] = q(*_SAMPLE_CTES, f"""SELECT {_ACTION_COLS} FROM uva
    WHERE session_id IN (SELECT session_id FROM picked)""")


# ---------------------------------------------------------------- traffic
SQL["pv_uv_hourly"] = q("""SELECT event_type AS site, strftime(ts, '%Y-%m-%d') AS date,
    CAST(hour(ts) AS VARCHAR) AS hour, count(user_id) AS pv, count(DISTINCT user_id) AS uv
    FROM events GROUP BY 1, 2, 3""")
SQL["global_sort_top1"] = q("SELECT value FROM events ORDER BY value DESC LIMIT 1")
SQL["catalog_scan"] = q("SELECT city_id, city_name, area FROM city_info")


# ---------------------------------------------------------------- functions
_REF_TIME = "2024-01-15 12:00:00"
SQL["date_functions"] = q(f"""SELECT event_id,
    strftime(ts, '%Y-%m-%d_%H') AS date_hour,
    strftime(ts, '%Y-%m-%d') AS date,
    strftime(ts, '%Y%m%d') AS datekey,
    strftime(ts, '%Y%m%d%H%M') AS minute_key,
    strftime(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed_time,
    strftime(CAST(strptime(strftime(ts, '%Y%m%d'), '%Y%m%d') AS DATE), '%Y-%m-%d') AS parsed_datekey,
    date_trunc('second', ts) < TIMESTAMP '{_REF_TIME}' AS before_ref,
    date_trunc('second', ts) > TIMESTAMP '{_REF_TIME}' AS after_ref,
    date_diff('second', CAST(CAST(ts AS DATE) AS TIMESTAMP), date_trunc('second', ts)) AS seconds_of_day,
    CAST(hour(ts) AS VARCHAR) AS hour_unpadded
    FROM events""")
_KV = """kv AS (SELECT session_id, concat('sessionid=', session_id, '|searchKeywords=',
      array_to_string(search_keywords, ','), '|clickCategoryIds=', array_to_string(click_category_ids, ','),
      '|visitLength=', CAST(visit_length AS VARCHAR), '|stepLength=', CAST(step_length AS VARCHAR),
      '|visitLength=0|stepLength=7|note=|tail=', CAST(visit_length AS VARCHAR), '=||') AS info FROM s)"""


def _kv_get_sql(s: str, field: str) -> str:
    # a split drops empty parts at the end, and the first piece of two parts with this name is it
    return (f"list_filter(list_transform(string_split(rtrim({s}, '|'), '|'), lambda x: string_split(rtrim(x, '='), '=')), "
            f"lambda a: len(a) = 2 AND a[1] = '{field}')[1][2]")


SQL["task_params"] = q(f"""SELECT user_id AS task_id, username AS task_name,
    '{P.START_DATE}' AS startDate, '{P.END_DATE}' AS endDate,
    CAST(greatest(age - 5, 0) AS VARCHAR) AS startAge, CAST(age + 5 AS VARCHAR) AS endAge,
    professional AS professionals, city AS cities, sex,
    CASE WHEN user_id % 2 = 0 THEN concat('kw', CAST(user_id % 10 AS VARCHAR), ',kw',
        CAST((user_id + 1) % 10 AS VARCHAR)) END AS keywords,
    CASE WHEN user_id % 3 <> 0 THEN concat(CAST(user_id % 100 AS VARCHAR), ',',
        CAST((user_id + 7) % 100 AS VARCHAR)) END AS categoryIds,
    '{",".join(str(p) for p in P.PAGE_FLOW)}' AS targetPageFlow
    FROM user_info""")
_KV_SET = """kp AS (SELECT *, string_split(rtrim(info, '|'), '|') AS pieces FROM kv),
ki AS (SELECT *, list_position(list_transform(pieces, lambda x: string_split(rtrim(x, '='), '=')[1]), 'stepLength') AS hit
  FROM kp)"""
SQL["kv_functions"] = q(_sess_cte("s", "uva"), _KV, _KV_SET, f"""SELECT session_id,
    {_kv_get_sql('info', 'searchKeywords')} AS search_keywords,
    {_kv_get_sql('info', 'visitLength')} AS visit_length,
    {_kv_get_sql('info', 'tail')} AS tail,
    {_kv_get_sql('info', 'note')} AS note,
    array_to_string(list_concat(list_concat(pieces[1:hit - 1], ['stepLength=0']), pieces[hit + 1:]), '|') AS reset_info
    FROM ki""")
SQL["string_functions"] = q("""t AS (SELECT event_id, page_id, action_time, search_keyword,
      regexp_replace(regexp_replace(concat(',', coalesce(array_to_string(order_category_ids, ','), ''), ','),
        '^,', ''), ',$', '') AS trimmed FROM uva)""", """SELECT event_id, trimmed,
    CASE WHEN length(CAST(hour(action_time) AS VARCHAR)) = 2 THEN CAST(hour(action_time) AS VARCHAR)
         ELSE concat('0', CAST(hour(action_time) AS VARCHAR)) END AS hour2,
    CASE WHEN length(CAST(page_id AS VARCHAR)) = 2 THEN CAST(page_id AS VARCHAR)
         ELSE concat('0', CAST(page_id AS VARCHAR)) END AS page2,
    coalesce(search_keyword, '') = '' AS no_keyword,
    CAST(len(list_filter(string_split(trimmed, ','), lambda x: x <> '')) AS INTEGER) AS n_ids,
    array_to_string(list_filter(string_split(trimmed, ','), lambda x: x <> ''), ',') AS ids
    FROM t""")
SQL["udf_concat_long_string"] = q(*_PRODUCT_CTES[:2], """SELECT product_id,
    concat(CAST(city_id AS VARCHAR), ':', city_name) AS city_info,
    json_extract_string(p.extend_info, '$.product_status') AS status_field
    FROM basic JOIN product_info p USING (product_id)""")
SQL["udaf_group_concat_distinct"] = q(*_PRODUCT_CTES[:2], """SELECT product_id,
    string_agg(DISTINCT city_name, ',' ORDER BY city_name) AS city_names FROM basic GROUP BY product_id""")


# ---------------------------------------------------------------- ads (batch)
_UAC = "uac AS (SELECT CAST(ts AS DATE) AS date, user_id, ad_id, count(*) AS click_count FROM ad_log GROUP BY 1, 2, 3)"
_BL = f"bl AS (SELECT DISTINCT user_id FROM uac WHERE click_count >= {P.CLICK_THRESHOLD})"
_STAT = """stat AS (SELECT CAST(ts AS DATE) AS date, province, city, ad_id, count(*) AS click_count
      FROM ad_log GROUP BY 1, 2, 3, 4)"""
_PROV = """prov AS (SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
      FROM stat GROUP BY 1, 2, 3)"""

SQL["ad_log_parse"] = q(f"""SELECT {_ts('ts')} AS ts, {_d('ts')} AS date, replace(province, ' ', '-') AS province,
    city, user_id, ad_id FROM ad_log""")
SQL["ad_user_clicks"] = q(_UAC, f"SELECT {_d('date')} AS date, user_id, ad_id, click_count FROM uac")
SQL["ad_blacklist_batch"] = q(_UAC, _BL, "SELECT user_id FROM bl")
SQL["blacklist_filter"] = q(_UAC, _BL, f"""SELECT event_id, {_ts('ts')} AS ts, province, city, user_id, ad_id
    FROM ad_log WHERE user_id NOT IN (SELECT user_id FROM bl)""")
SQL["ad_stat"] = q(_STAT, f"SELECT {_d('date')} AS date, province, city, ad_id, click_count FROM stat")
SQL["ad_province_clicks"] = q(_STAT, _PROV, f"SELECT {_d('date')} AS date, province, ad_id, click_count FROM prov")
SQL["ad_province_top3"] = q(_STAT, _PROV, f"""SELECT {_d('date')} AS date, province, ad_id, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rn FROM prov)
    WHERE rn <= 3""")
SQL["ad_click_trend"] = q("""SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,
    strftime(ts, '%M') AS minute, ad_id, count(*) AS click_count FROM ad_log
    GROUP BY date_trunc('minute', ts), 1, 2, 3, ad_id""")
_SLIDE_S = P.SLIDE_MINUTES * 60
_COPIES = P.WINDOW_MINUTES // P.SLIDE_MINUTES
SQL["ad_sliding_hour"] = q(
    f"sl AS (SELECT CAST(floor(epoch(ts) / {_SLIDE_S}) AS BIGINT) AS slot, ad_id FROM ad_log)",
    f"wn AS (SELECT slot - i AS w, ad_id FROM sl, range(0, {_COPIES}) t(i))",
    f"""SELECT strftime(TIMESTAMP '1970-01-01' + to_seconds(w * {_SLIDE_S}), '%Y-%m-%d %H:%M:%S') AS window_start,
    strftime(TIMESTAMP '1970-01-01' + to_seconds(w * {_SLIDE_S}) + INTERVAL {P.WINDOW_MINUTES} MINUTE,
             '%Y-%m-%d %H:%M:%S') AS window_end, ad_id, count(*) AS click_count FROM wn GROUP BY w, ad_id""")


_SLIDE_REF = P.SLIDE_SECONDS_REFERENCE
SQL["ad_sliding_hour_10s"] = q(
    f"sl AS (SELECT CAST(floor(epoch(ts) / {_SLIDE_REF}) AS BIGINT) AS slot, ad_id FROM ad_log)",
    f"wn AS (SELECT slot - i AS w, ad_id FROM sl, range(0, {P.WINDOW_MINUTES * 60 // _SLIDE_REF}) t(i))",
    f"""SELECT strftime(TIMESTAMP '1970-01-01' + to_seconds(w * {_SLIDE_REF}), '%Y-%m-%d %H:%M:%S') AS window_start,
    strftime(TIMESTAMP '1970-01-01' + to_seconds(w * {_SLIDE_REF}) + INTERVAL {P.WINDOW_MINUTES} MINUTE,
             '%Y-%m-%d %H:%M:%S') AS window_end, ad_id, count(*) AS click_count FROM wn GROUP BY w, ad_id""")


# ---------------------------------------------------------------- sinks
SQL["sink_append"] = q(f"SELECT event_id, {_ts('ts')} AS ts, province, city, user_id, ad_id FROM ad_log")
SQL["sink_upsert_increment"] = q(_UAC, f"SELECT {_d('date')} AS date, user_id, ad_id, click_count FROM uac")
SQL["sink_lookup"] = q(_UAC, """touched AS (SELECT DISTINCT CAST(ts AS DATE) AS date, user_id, ad_id FROM ad_log WHERE hour(ts) // 8 = 2)""",
                       f"SELECT {_d('date')} AS date, user_id, ad_id, click_count FROM uac JOIN touched USING (date, user_id, ad_id)")
SQL["sink_upsert_latest"] = q(_STAT, f"SELECT {_d('date')} AS date, province, city, ad_id, click_count FROM stat")
SQL["sink_replace_group"] = SQL["ad_province_top3"]


# ---------------------------------------------------------------- stream (T4)
# Replay: batches of 5 consecutive days from the first day; a user reaching the
# threshold (daily count per ad) in batch b is filtered from batch b + 1 on.
_DAYS_PER_BATCH = 5
_STREAM = (
    f"""al AS (SELECT event_id, ts, replace(province, ' ', '-') AS province, city, user_id, ad_id,
      CAST(ts AS DATE) AS date,
      (CAST(ts AS DATE) - (SELECT min(CAST(ts AS DATE)) FROM ad_log)) // {_DAYS_PER_BATCH} AS b FROM ad_log)""",
    "dc AS (SELECT date, user_id, ad_id, b, count(*) AS c FROM al GROUP BY ALL)",
    f"blb AS (SELECT user_id, min(b) AS bl_b FROM dc WHERE c >= {P.CLICK_THRESHOLD} GROUP BY user_id)",
    "kept AS (SELECT al.* FROM al LEFT JOIN blb USING (user_id) WHERE blb.bl_b IS NULL OR al.b <= blb.bl_b)",
    """kstat AS (SELECT date, province, city, ad_id, count(*) AS click_count FROM kept GROUP BY ALL)""",
    """kprov AS (SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
      FROM kstat GROUP BY ALL)""",
)
SQL["ad_stream_filtered"] = q(_UAC, _BL, f"""SELECT {_ts('ts')} AS ts, {_d('ts')} AS date,
    replace(province, ' ', '-') AS province, city, user_id, ad_id
    FROM ad_log WHERE user_id NOT IN (SELECT user_id FROM bl)""")
SQL["ad_stream_user_clicks"] = q(*_STREAM, f"""SELECT {_d('date')} AS date, user_id, ad_id,
    count(*) AS click_count FROM kept GROUP BY date, user_id, ad_id""")
SQL["ad_stream_blacklist"] = q(*_STREAM, "SELECT user_id FROM blb")
SQL["ad_stream_stat"] = q(*_STREAM, f"SELECT {_d('date')} AS date, province, city, ad_id, click_count FROM kstat")
SQL["ad_stream_province_top3"] = q(*_STREAM, f"""SELECT {_d('date')} AS date, province, ad_id, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rn FROM kprov)
    WHERE rn <= 3""")
SQL["ad_stream_trend"] = q(*_STREAM, """SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,
    strftime(ts, '%M') AS minute, ad_id, count(*) AS click_count FROM kept
    GROUP BY date_trunc('minute', ts), 1, 2, 3, ad_id""")
SQL["ad_stream_trend_last_hour"] = q(*_STREAM, f"""SELECT strftime(m, '%Y-%m-%d') AS date, strftime(m, '%H') AS hour,
    strftime(m, '%M') AS minute, ad_id, count(*) AS click_count
    FROM (SELECT date_trunc('minute', ts) AS m, ad_id FROM kept)
    WHERE m > (SELECT max(date_trunc('minute', ts)) FROM kept) - INTERVAL {P.LAST_MINUTES} MINUTE
    GROUP BY m, ad_id""")
SQL["ad_stream_stateful_stat"] = q(f"""SELECT {_d('ts')} AS date, replace(province, ' ', '-') AS province, city,
    ad_id, count(*) AS click_count FROM ad_log GROUP BY ALL""")
SQL["ad_stream_window_trend"] = SQL["ad_click_trend"]
SQL["ad_stream_sliding_hour"], SQL["ad_stream_sliding_hour_10s"] = SQL["ad_sliding_hour"], SQL["ad_sliding_hour_10s"]
SQL["global_sort_rank"] = "SELECT event_id, value, row_number() OVER (ORDER BY value DESC NULLS LAST, event_id) AS rank FROM events"
SQL["pv_uv_rollup"] = """SELECT event_type AS site, strftime(ts, '%Y-%m-%d') AS date, count(user_id) AS pv, count(DISTINCT user_id) AS uv, TRUE AS within_error
FROM events GROUP BY 1, 2"""
SQL["date_today"] = q("""SELECT event_id, strftime(current_date, '%Y-%m-%d') AS today,
    strftime(current_date - INTERVAL 1 DAY, '%Y-%m-%d') AS yesterday,
    CAST(current_date - CAST(ts AS DATE) AS INTEGER) AS days_ago FROM events""")
