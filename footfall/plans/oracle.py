"""SQL equivalents of the catalog's queries for DuckDB, written from the definitions.

They share nothing with the Spark code but the parameters.
"""

from __future__ import annotations

START, END = "2024-01-05", "2024-01-25"
SAMPLE, LARGE_SAMPLE = 100, 3000
THRESHOLD = 3
FLOW = ["1", "2", "3", "4", "5", "6", "7"]

VISIT = """
visit_action AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
         CAST(k % 10 AS VARCHAR) AS page_id, date_trunc('second', ts) AS action_time, event_id,
         CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) ELSE '' END AS search_keyword,
         CASE WHEN event_type = 'click' THEN CAST(k % 20 AS VARCHAR) ELSE '' END AS click_category_id,
         CASE WHEN event_type = 'click' THEN CAST(event_id % 50 AS VARCHAR) ELSE '' END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST(k % 20 AS VARCHAR) ELSE '' END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 50 AS VARCHAR) ELSE '' END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 20 AS VARCHAR) ELSE '' END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 50 AS VARCHAR) ELSE '' END AS pay_product_ids,
         CAST(user_id % 25 AS INTEGER) AS city_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

USERS = """
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name, CAST(18 + c_custkey % 50 AS INTEGER) AS age,
         c_mktsegment AS professional, CAST(c_nationkey AS VARCHAR) AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer)"""

PRODUCTS = """
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_size % 2 AS VARCHAR) AS extend_info FROM part)"""

CITIES = """
city_info AS (
  SELECT n_nationkey AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON r_regionkey = n_regionkey)"""

SESSIONS = """
session AS (
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_time, max(action_time) AS end_time,
         count(*) AS step_length,
         CAST(date_diff('second', min(action_time), max(action_time)) AS BIGINT) AS visit_length,
         coalesce(string_agg(DISTINCT search_keyword, '|' ORDER BY search_keyword)
                  FILTER (WHERE search_keyword <> ''), '') AS search_keywords,
         coalesce(string_agg(DISTINCT click_category_id, '|' ORDER BY click_category_id)
                  FILTER (WHERE click_category_id <> ''), '') AS click_category_ids,
         bool_or(search_keyword IN ('kw1', 'kw2', 'kw3', 'kw4')) AS keyword_hit,
         bool_or(click_category_id IN ('1', '2', '3', '4', '5', '6', '7', '8')) AS category_hit
  FROM visit_action GROUP BY session_id)"""

KEPT = "kept AS (SELECT s.* FROM session s WHERE s.user_id IN (SELECT user_id FROM user_info))"
KEPT_ACTION = """kept_action AS (
  SELECT * FROM visit_action WHERE session_id IN (SELECT session_id FROM kept))"""

FILTERED_SESSION = """
filtered_session AS (
  SELECT s.* FROM session s JOIN user_info u ON u.user_id = s.user_id
  WHERE u.age BETWEEN 20 AND 60 AND u.professional IN ('HOUSEHOLD', 'MACHINERY', 'BUILDING')
    AND u.sex IN ('male', 'female') AND CAST(u.city AS INTEGER) BETWEEN 0 AND 19
    AND s.keyword_hit AND s.category_hit)"""

HOURLY = """
hourly AS (
  SELECT strftime(start_time, '%Y-%m-%d') AS date, strftime(start_time, '%H') AS hour_of_day,
         count(*) AS session_count
  FROM kept GROUP BY 1, 2),
shared AS (
  SELECT *, CAST(sum(session_count) OVER (PARTITION BY date) AS BIGINT) AS day_count FROM hourly)"""


def _quota(extra: int, size: int = SAMPLE) -> str:
    return f"""
quota AS (
  SELECT date, hour_of_day, session_count,
         least(session_count,
               CAST(floor((CAST(session_count AS DOUBLE) / day_count)
                          * ({size} // (SELECT count(DISTINCT date) FROM hourly))) AS BIGINT) + {extra}) AS quota
  FROM shared),
drawn AS (
  SELECT *, strftime(start_time, '%Y-%m-%d') AS date, strftime(start_time, '%H') AS hour_of_day,
         row_number() OVER (PARTITION BY strftime(start_time, '%Y-%m-%d %H')
                            ORDER BY md5(session_id), session_id) AS nth
  FROM kept),
sampled AS (
  SELECT d.* FROM drawn d JOIN quota q ON q.date = d.date AND q.hour_of_day = d.hour_of_day
  WHERE d.nth <= q.quota)"""


CATEGORY = """
category_action AS (
  SELECT CASE WHEN click_category_id <> '' THEN click_category_id
              WHEN pay_category_ids <> '' THEN pay_category_ids ELSE order_category_ids END AS category_id,
         CASE WHEN click_category_id <> '' THEN 'click'
              WHEN pay_category_ids <> '' THEN 'pay' ELSE 'order' END AS action,
         page_id
  FROM kept_action
  WHERE click_category_id <> '' OR pay_category_ids <> '' OR order_category_ids <> '')"""

PIVOT = """
pivoted AS (
  SELECT category_id, count(*) FILTER (WHERE action = 'click') AS click_count,
         count(*) FILTER (WHERE action = 'order') AS order_count,
         count(*) FILTER (WHERE action = 'pay') AS pay_count
  FROM category_action GROUP BY category_id)"""

PIVOT_EXPLODED = PIVOT.replace("FROM category_action", """FROM (
    SELECT category_id, action FROM category_action
    UNION ALL SELECT 'c' || page_id, action FROM category_action WHERE action <> 'click')""")

TOP10 = "ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10"

PAIRS = """
pair AS (
  SELECT session_id, page_id AS from_page,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS to_page
  FROM visit_action)"""

_steps = ", ".join(f"({i + 1}, '{a}', '{b}')" for i, (a, b) in enumerate(zip(FLOW, FLOW[1:])))
FLOW_COUNTS = f"""
step AS (SELECT * FROM (VALUES {_steps}) AS t(step, a, b)),
flow_count AS (
  SELECT step, a || '_' || b AS page_pair,
         (SELECT count(*) FROM pair WHERE from_page = a AND to_page = b) AS pair_count
  FROM step),
flow AS (
  SELECT step, page_pair, pair_count,
         coalesce(lag(pair_count) OVER (ORDER BY step),
                  (SELECT count(*) FROM visit_action WHERE page_id = '{FLOW[0]}')) AS previous_count
  FROM flow_count)"""

CITY_PRODUCT = """
city_product AS (
  SELECT city_id, CAST(click_product_id AS BIGINT) AS product_id, count(*) AS click_count
  FROM visit_action WHERE click_product_id <> '' GROUP BY 1, 2)"""

AREA_PRODUCT = """
area_product AS (
  SELECT area, c.product_id, CAST(sum(click_count) AS BIGINT) AS click_count,
         '|' || string_agg(DISTINCT city_name || ':' || click_count, '|' ORDER BY city_name || ':' || click_count)
           AS city_counts
  FROM city_product c JOIN product_info p ON p.product_id = c.product_id
  JOIN city_info i ON i.city_id = c.city_id GROUP BY 1, 2)"""

SCORE = """
score AS (
  SELECT o_orderkey AS name, o_orderpriority AS class, CAST(round(o_totalprice * 100) AS BIGINT) AS score
  FROM orders),
best AS (SELECT class, max(score) AS max_score FROM score GROUP BY class)"""

CLICKS = """
all_click AS (
  SELECT ts, strftime(ts, '%Y-%m-%d') AS date, n_regionkey AS province, CAST(user_id % 25 AS INTEGER) AS city,
         user_id AS userid, CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS adid, event_id
  FROM events JOIN nation ON n_nationkey = user_id % 25)"""

FILTERED = f"""
cutoff AS (
  SELECT userid, min(ts) AS cutoff FROM (
    SELECT userid, ts, row_number() OVER (PARTITION BY date, userid, adid ORDER BY ts) AS nth FROM all_click)
  WHERE nth = {THRESHOLD} GROUP BY userid),
click AS (
  SELECT c.* FROM all_click c LEFT JOIN cutoff o ON o.userid = c.userid
  WHERE o.cutoff IS NULL OR c.ts <= o.cutoff)"""

STAT = "SELECT date, province, city, adid, count(*) AS click_count FROM {} GROUP BY 1, 2, 3, 4"
USER_COUNT = "SELECT date, userid, adid, count(*) AS click_count FROM {} GROUP BY 1, 2, 3"
MINUTE = ("SELECT date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, adid, count(*) AS click_count "
          "FROM {} GROUP BY 1, 2, 3, 4").replace("AS hour", 'AS "hour"').replace("AS minute", 'AS "minute"')
PROVINCE = "SELECT date, province, adid, count(*) AS click_count FROM {} GROUP BY 1, 2, 3"
TOP3 = ("SELECT date, province, adid, click_count FROM (SELECT *, rank() OVER (PARTITION BY date, province "
        "ORDER BY click_count DESC) AS r FROM (" + PROVINCE + ")) WHERE r <= 3")
TREND = ("SELECT * FROM (" + MINUTE.replace(" FROM {}", " FROM (SELECT * FROM {0} WHERE ts >= "
         "(SELECT date_trunc('minute', max(ts)) - INTERVAL 59 MINUTES FROM {0}))") + ")")
CLICK_ROWS = "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS clicked_at, province, city, userid, adid FROM click"
SLIDING = """
SELECT strftime(make_timestamp(window_end * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end, adid,
       count(*) AS click_count
FROM (SELECT adid, unnest(generate_series(s + 30, s + 3600, 30)) AS window_end
      FROM (SELECT adid, CAST(floor(epoch(ts) / 30) AS BIGINT) * 30 AS s FROM click))
GROUP BY 1, 2"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + select.strip()


_sessions = (VISIT, USERS, SESSIONS, KEPT)
_kept_actions = (*_sessions, KEPT_ACTION)
_ads = (CLICKS, FILTERED)

_VISIT_BUCKETS = [("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30), ("30s_60s", 31, 60),
                  ("1m_3m", 61, 180), ("3m_10m", 181, 600), ("10m_30m", 601, 1800), ("30m", 1801, 10**9)]
_STEP_BUCKETS = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60),
                 ("60", 61, 10**9)]


def _bucket(column: str, low: int, high: int) -> str:
    return f"count(*) FILTER (WHERE {column} BETWEEN {low} AND {high})"


def _share(n: str, d: str) -> str:
    """Half-up rounding to two decimals in whole numbers."""
    return f"CASE WHEN {d} > 0 THEN CAST((200 * {n} + {d}) // (2 * {d}) AS DOUBLE) / 100 END"


_visit_counts = ", ".join(f"{_bucket('visit_length', lo, hi)} AS visit_{n}_count" for n, lo, hi in _VISIT_BUCKETS)
_step_counts = ", ".join(f"{_bucket('step_length', lo, hi)} AS step_{n}_count" for n, lo, hi in _STEP_BUCKETS)
_ratios = ", ".join(
    [f"{_share(f'visit_{n}_count', 'session_count')} AS visit_length_{n}_ratio" for n, *_ in _VISIT_BUCKETS]
    + [f"{_share(f'step_{n}_count', 'session_count')} AS step_length_{n}_ratio" for n, *_ in _STEP_BUCKETS])

_RANDOM_EXTRACT = """
SELECT session_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time, search_keywords, click_category_ids
FROM sampled"""

ORACLE: dict[str, str] = {
    "actions_date_range": _with(VISIT, select=f"""
        SELECT * REPLACE (strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time) FROM visit_action
        WHERE date BETWEEN '{START}' AND '{END}'"""),
    "actions_clicks_pruned": _with(VISIT, select=f"""
        SELECT city_id, click_product_id FROM visit_action
        WHERE date BETWEEN '{START}' AND '{END}' AND click_product_id <> ''"""),
    "user_scan": _with(USERS, select="SELECT * FROM user_info"),
    "product_scan": _with(PRODUCTS, select="SELECT * FROM product_info"),
    "city_scan": _with(CITIES, select="SELECT * FROM city_info"),
    "sessions_filtered": _with(VISIT, USERS, SESSIONS, FILTERED_SESSION, select="""
        SELECT session_id, user_id, visit_length, step_length FROM filtered_session"""),
    "kept_actions": _with(VISIT, USERS, SESSIONS, FILTERED_SESSION, select="""
        SELECT event_id, session_id, user_id FROM visit_action
        WHERE session_id IN (SELECT session_id FROM filtered_session)"""),
    "session_rollup": _with(VISIT, SESSIONS, select="""
        SELECT session_id, user_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
               strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, step_length, search_keywords,
               click_category_ids, visit_length FROM session"""),
    "session_user_join": _with(VISIT, USERS, SESSIONS, select="""
        SELECT s.session_id, s.user_id, step_length, visit_length, age, professional, city, sex
        FROM session s JOIN user_info u ON u.user_id = s.user_id
        WHERE age BETWEEN 20 AND 50 AND sex = 'male'"""),
    "session_visit_buckets": _with(*_sessions, select=f"""
        SELECT count(*) AS session_count, {_bucket('visit_length', 0, 0)} AS visit_0s_count, {_visit_counts}
        FROM kept"""),
    "session_step_buckets": _with(*_sessions, select=f"""
        SELECT count(*) AS session_count, {_step_counts} FROM kept"""),
    "session_aggr_stat": _with(*_sessions, select=f"""
        SELECT session_count, {_ratios}
        FROM (SELECT count(*) AS session_count, {_visit_counts}, {_step_counts} FROM kept)"""),
    "sessions_per_hour": _with(*_sessions, HOURLY, select="""
        SELECT date, hour_of_day AS "hour", session_count FROM hourly"""),
    "hour_share_of_day": _with(*_sessions, HOURLY, select="""
        SELECT date, hour_of_day AS "hour", session_count, day_count,
               session_count / CAST(day_count AS DOUBLE) AS share FROM shared"""),
    "hour_quota": _with(*_sessions, HOURLY, _quota(1), select="""
        SELECT date, hour_of_day AS "hour", session_count, quota FROM quota"""),
    "session_random_extract": _with(*_sessions, HOURLY, _quota(1), select=_RANDOM_EXTRACT),
    "session_random_extract_exact": _with(*_sessions, HOURLY, _quota(0, LARGE_SAMPLE), select=_RANDOM_EXTRACT),
    "session_detail": _with(*_sessions, HOURLY, _quota(1), select="""
        SELECT user_id, session_id, page_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time,
               search_keyword, click_category_id, click_product_id, order_category_ids, order_product_ids,
               pay_category_ids, pay_product_ids
        FROM visit_action WHERE session_id IN (SELECT session_id FROM sampled)"""),
    "category_action_counts": _with(*_kept_actions, CATEGORY, select="""
        SELECT category_id, action, count(*) AS action_count FROM category_action GROUP BY 1, 2"""),
    "category_pivot": _with(*_kept_actions, CATEGORY, PIVOT, select="SELECT * FROM pivoted"),
    "top10_category": _with(*_kept_actions, CATEGORY, PIVOT, select=f"SELECT * FROM pivoted {TOP10}"),
    "top10_category_exploded": _with(*_kept_actions, CATEGORY, PIVOT_EXPLODED,
                                     select=f"SELECT * FROM pivoted {TOP10}"),
    "session_category_clicks": _with(*_kept_actions, select="""
        SELECT click_category_id AS category_id, session_id, count(*) AS click_count FROM kept_action
        WHERE click_category_id <> '' GROUP BY 1, 2"""),
    "top10_session": _with(*_kept_actions, CATEGORY, PIVOT, select=f"""
        SELECT category_id, session_id, click_count FROM (
          SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS nth
          FROM (SELECT click_category_id AS category_id, session_id, count(*) AS click_count FROM kept_action
                WHERE click_category_id IN (SELECT category_id FROM pivoted {TOP10}) GROUP BY 1, 2))
        WHERE nth <= 10"""),
    "start_page_pv": _with(VISIT, select="SELECT count(*) AS start_pv FROM visit_action WHERE page_id = '1'"),
    "session_page_pairs": _with(VISIT, PAIRS, select="""
        SELECT from_page, to_page, count(*) AS pair_count FROM pair WHERE to_page IS NOT NULL GROUP BY 1, 2"""),
    "page_pair_counts": _with(VISIT, PAIRS, FLOW_COUNTS, select="SELECT * FROM flow"),
    "page_convert_rate": _with(VISIT, PAIRS, FLOW_COUNTS, select=f"""
        SELECT step, page_pair, {_share('pair_count', 'previous_count')} AS rate FROM flow"""),
    "city_product_clicks": _with(VISIT, CITY_PRODUCT, select="SELECT * FROM city_product"),
    "area_product_citycounts": _with(VISIT, PRODUCTS, CITIES, CITY_PRODUCT, AREA_PRODUCT,
                                     select="SELECT * FROM area_product"),
    "area_top3_product": _with(VISIT, PRODUCTS, CITIES, CITY_PRODUCT, AREA_PRODUCT, select="""
        SELECT area, product_id, click_count, city_counts FROM (
          SELECT *, rank() OVER (PARTITION BY area ORDER BY click_count DESC) AS r FROM area_product)
        WHERE r <= 3"""),
    "rank_per_group": _with(SCORE, select="""
        SELECT name, class, score, rank() OVER (PARTITION BY class ORDER BY score DESC) AS rank FROM score"""),
    "row_number_per_group": _with(SCORE, select="""
        SELECT name, class, score, row_number() OVER (PARTITION BY class ORDER BY score DESC, name) AS rank
        FROM score"""),
    "lag_lead_per_group": _with(SCORE, select="""
        SELECT name, class, score, lag(score, 3, -1::BIGINT) OVER by_row AS lag_score,
               lead(score, 3, -1::BIGINT) OVER by_row AS lead_score
        FROM score WINDOW by_row AS (PARTITION BY class ORDER BY score DESC, name)"""),
    "top1_per_group": _with(SCORE, select="""
        SELECT name, class, score, 1::BIGINT AS rank FROM score s
        WHERE score = (SELECT max(score) FROM score t WHERE t.class = s.class)"""),
    "max_per_group": _with(SCORE, select="SELECT class, max_score FROM best"),
    "max_join_back": _with(SCORE, select="""
        SELECT name, s.class, max_score FROM score s JOIN best b ON b.class = s.class AND b.max_score = s.score"""),
    "max_join_back_loose": _with(SCORE, select="""
        SELECT name, b.class, max_score FROM score s, best b WHERE s.score = b.max_score"""),
    "window_agg_suite": _with(SCORE, select="""
        SELECT class, name, score, rank() OVER by_score AS rank, dense_rank() OVER by_score AS dense_rank,
               row_number() OVER by_row AS row_number, count(*) OVER by_row AS running_count,
               CAST(sum(score) OVER by_row AS BIGINT) AS running_sum, min(score) OVER by_row AS running_min,
               max(score) OVER by_row AS running_max,
               CAST(sum(score) OVER by_row AS DOUBLE) / count(*) OVER by_row AS running_avg,
               first_value(name) OVER by_row AS first_value, last_value(name) OVER by_row AS last_value,
               lag(score, 1, 0) OVER by_row AS lag_score, lead(score, 1, 0) OVER by_row AS lead_score
        FROM score
        WINDOW by_row AS (PARTITION BY class ORDER BY score DESC, name),
               by_score AS (PARTITION BY class ORDER BY score DESC)"""),
    "group_totals": _with(SCORE, select="""
        SELECT class, name, score, count(*) OVER w AS group_count, CAST(sum(score) OVER w AS BIGINT) AS group_sum,
               min(score) OVER w AS group_min, max(score) OVER w AS group_max,
               CAST(sum(score) OVER w AS DOUBLE) / count(*) OVER w AS group_avg, count(*) OVER () AS all_count
        FROM score WINDOW w AS (PARTITION BY class)"""),
    "ad_click_records": _with(CLICKS, select="SELECT epoch_us(ts) // 1000 AS ts, province, city, userid, adid FROM all_click"),
    "ad_user_click_count": _with(*_ads, select=USER_COUNT.format("click")),
    "ad_blacklist": _with(*_ads, select="SELECT userid FROM cutoff"),
    "ad_filtered_clicks": _with(*_ads, select=CLICK_ROWS),
    "ad_stat": _with(*_ads, select=STAT.format("click")),
    "ad_stat_unfiltered": _with(CLICKS, select=STAT.format("all_click")),
    "ad_province_counts": _with(*_ads, select=PROVINCE.format("click")),
    "ad_province_top3": _with(*_ads, select=TOP3.format("click")),
    "ad_province_top3_rownum": _with(*_ads, select=f"""
        SELECT date, province, adid, click_count FROM (
          SELECT *, row_number() OVER (PARTITION BY province ORDER BY click_count DESC, date, adid) AS nth
          FROM ({PROVINCE.format("click")}))
        WHERE nth <= 3"""),
    "ad_minute_clicks": _with(*_ads, select=MINUTE.format("click")),
    "ad_click_trend": _with(*_ads, select=TREND.format("click")),
    "ad_click_trend_unfiltered": _with(CLICKS, select=TREND.format("all_click")),
    "ad_click_sliding": _with(*_ads, select=SLIDING),
    "stream_ad_stat": _with(CLICKS, select=STAT.format("all_click")),
    "stream_ad_province_top3": _with(*_ads, select=TOP3.format("click")),
    "stream_ad_minute_clicks": _with(CLICKS, select=MINUTE.format("all_click")),
    "stream_ad_user_click_count": _with(*_ads, select=USER_COUNT.format("click")),
    "stream_ad_blacklist": _with(*_ads, select="SELECT userid FROM cutoff"),
    "stream_ad_filtered_clicks": _with(*_ads, select=CLICK_ROWS),
    "stream_ad_job_stat": _with(*_ads, select=STAT.format("click")),
    "stream_ad_job_user_click_count": _with(*_ads, select=USER_COUNT.format("click")),
    "stream_ad_job_province_top3": _with(*_ads, select=TOP3.format("click")),
    "stream_ad_job_trend_unfiltered": _with(CLICKS, select=TREND.format("all_click")),
    "stream_compacted_stat": _with(CLICKS, select=STAT.format("all_click")),
    "stream_ad_stat_watermark": _with(CLICKS, select=STAT.format("all_click")),
    "stream_ad_late_minutes": _with(CLICKS, select=MINUTE.format("all_click")),
    "stream_ad_sliding": _with(*_ads, select=SLIDING),
    "sink_append": "",
    "sink_upsert_add": _with(CLICKS, select=USER_COUNT.format("all_click")),
    "sink_upsert_set": _with(CLICKS, select=STAT.format("all_click")),
    "sink_replace_by_key": _with(CLICKS, select=TOP3.format("all_click")),
    "sink_insert_new": _with(CLICKS, select="SELECT DISTINCT userid FROM all_click"),
    "time_functions": """
        SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text,
               strftime(ts, '%Y%m%d') AS date_key, strftime(ts, '%Y%m%d%H%M') AS minute_key,
               strftime(ts, '%Y-%m-%d_%H') AS date_hour, strftime(ts, '%Y-%m-%d_%H') AS date_hour_of_text,
               strftime(ts, '%Y-%m-%d') AS day_of_millis, strftime(ts, '%Y-%m-%d %H:%M') AS minute_of_millis,
               true AS is_before, false AS is_after, 90::BIGINT AS seconds, -90::BIGINT AS minus,
               strftime(ts, '%Y-%m-%d') AS key_parsed, strftime(ts, '%H') AS hour_text,
               strftime(ts, '%M') AS minute_text,
               CASE WHEN event_id % 120 < 10 THEN '0' ELSE '' END || CAST(event_id % 120 AS VARCHAR) AS padded
        FROM events""",
    "round_half_up": f"""
        SELECT user_id, clicks, events, {_share('clicks', 'events')} AS click_share
        FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) AS events
              FROM events GROUP BY user_id)""",
}
# The two halves are split at the middle of the time span, inside a minute that then has two rows.
ORACLE["sink_append"] = _with(CLICKS, """
half AS (SELECT *, ts >= (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM all_click) AS late FROM all_click)""",
    select='SELECT * EXCLUDE (late) FROM (' + MINUTE.format("half").replace(
        "SELECT date,", "SELECT late, date,").replace("GROUP BY 1, 2, 3, 4", "GROUP BY 1, 2, 3, 4, 5") + ')')

# By batch: a user listed in the first half of the time counts in it to its end, and not after.
_HALVES = """
half AS (SELECT *, ts >= (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM all_click) AS late FROM all_click)"""
_LISTED = "SELECT DISTINCT userid FROM {} GROUP BY date, userid, adid HAVING count(*) >= " + str(THRESHOLD)
ORACLE["stream_ad_job_stat_by_batch"] = _with(CLICKS, _HALVES, f"""
kept_click AS (
  SELECT * FROM half WHERE NOT late OR userid NOT IN ({_LISTED.format("half WHERE NOT late")}))""",
    select=STAT.format("kept_click"))
ORACLE["stream_ad_blacklist_by_batch"] = _with(CLICKS, select=_LISTED.format("all_click"))
ORACLE["sink_replace_table"] = _with(CLICKS, select=USER_COUNT.format("all_click"))
ORACLE["session_aggr_stat_task"] = f"SELECT 'run-1' AS task_id, * FROM ({ORACLE['session_aggr_stat']})"
_LITERAL = """
city_info AS (
  SELECT CAST(i AS INTEGER) AS city_id, 'city' || lpad(CAST(i AS VARCHAR), 2, '0') AS city_name, 'area' || (i % 7) AS area
  FROM range(25) r(i))"""
ORACLE["area_top3_literal_cities"] = f"SELECT 'run-1' AS task_id, * FROM ({ORACLE['area_top3_product'].replace(CITIES, _LITERAL)})"

ORACLE["stream_log_stat"] = _with(CLICKS, select=STAT.format("all_click"))
ORACLE["stream_log_clamped"] = _with(CLICKS, _HALVES, select=STAT.format("half WHERE late"))
ORACLE["stream_log_ranges"] = _with(CLICKS, _HALVES, """
sizes AS (SELECT CAST(late AS BIGINT) AS batch_id, userid % 4 AS log_partition, count(*) AS n FROM half GROUP BY 1, 2)""", select="""
    SELECT batch_id, log_partition, CAST(end_ - n AS BIGINT) AS from_offset, CAST(end_ AS BIGINT) AS until_offset
    FROM (SELECT *, sum(n) OVER (PARTITION BY log_partition ORDER BY batch_id) AS end_ FROM sizes)""")
