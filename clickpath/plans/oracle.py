"""Independent SQL specifications (DuckDB dialect) of the catalog queries.

Each string runs on the raw driver tables (views ``events``, ``nation``,
``region``, ``documents``); the fixture adapters are inlined as CTEs, so the
oracle shares no code with the Spark side. Parameters match ``catalog.PARAMS``.
"""

from __future__ import annotations

from clickpath.plans.params import PARAMS

_K = "try_cast(json_extract_string(props, '$.k') AS BIGINT)"


def _jsplit(e: str, d: str) -> str:
    """Java ``String.split`` by a one-char literal: trailing empties dropped."""
    return (f"(CASE WHEN {e} IS NULL THEN NULL WHEN {e} = '' THEN [''] "
            f"WHEN rtrim({e}, '{d}') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({e}, '{d}'), '{d}') END)")


VISITS = f"""visits AS (
  SELECT event_id,
         strftime(ts, '%Y-%m-%d') AS date,
         user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
         k % 10 + 1 AS page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 6 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k + 1 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST(k % 20 + 1 AS VARCHAR) || ',' ||
              CAST((k + 7) % 20 + 1 AS VARCHAR) || ',' || CAST((k + 13) % 20 + 1 AS VARCHAR)
         END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k + 1 AS VARCHAR) || ',' ||
              CAST((k + 7) % 100 + 1 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 20 + 1 AS VARCHAR) || ',' ||
              CAST((k + 3) % 20 + 1 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k + 1 AS VARCHAR) || ',' ||
              CAST((k + 3) % 100 + 1 AS VARCHAR) END AS pay_product_ids,
         user_id % 26 + 1 AS city_id
  FROM (SELECT *, {_K} AS k FROM events) e)"""


def _ad_clicks(area: str = "r.r_name", city: str = "n.n_name") -> str:
    return f"""ad_clicks AS (
  SELECT e.event_id, e.user_id, e.ts_ms,
         strftime(make_timestamp(e.ts_ms * 1000), '%Y-%m-%d') AS date,
         {area} AS area, {city} AS city,
         e.k % 6 + 1 AS ad_id,
         e.ts_ms // 5000 AS batch
  FROM (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ts_ms, {_K} AS k FROM events) e
  JOIN nation n ON n.n_nationkey = e.user_id % 25
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""


AD_CLICKS = _ad_clicks()
# Stream inputs travel as log lines, where spaces in names become '-'.
AD_CLICKS_LINES = _ad_clicks("replace(r.r_name, ' ', '-')", "replace(n.n_name, ' ', '-')")

FLOW = PARAMS["flow"]
FLOW_LIST = ", ".join(str(p) for p in FLOW)
FLOW_VALUES = ", ".join(f"({a}, {b})" for a, b in dict.fromkeys(zip(FLOW, FLOW[1:])))
D0, D1 = PARAMS["date_range"]
FD0, FD1 = PARAMS["flow_date_range"]
THRESHOLD = PARAMS["threshold"]

KINDS = """kinds AS (
  SELECT event_id, session_id, click_category_id, order_category_ids, pay_category_ids,
         CASE WHEN coalesce(click_category_id, -1) <> -1 THEN 'click'
              WHEN order_category_ids IS NOT NULL THEN 'order'
              WHEN pay_category_ids IS NOT NULL THEN 'pay' END AS kind
  FROM visits)"""

IDS = f"""ids AS (
  SELECT kind, CAST(click_category_id AS VARCHAR) AS category_id FROM kinds WHERE kind = 'click'
  UNION ALL SELECT kind, unnest({_jsplit('order_category_ids', ',')}) FROM kinds WHERE kind = 'order'
  UNION ALL SELECT kind, unnest({_jsplit('pay_category_ids', ',')}) FROM kinds WHERE kind = 'pay')"""

METRICS = """metrics AS (
  SELECT category_id,
         count(CASE WHEN kind = 'click' THEN 1 END) AS click_count,
         count(CASE WHEN kind = 'order' THEN 1 END) AS order_count,
         count(CASE WHEN kind = 'pay' THEN 1 END) AS pay_count
  FROM ids GROUP BY category_id)"""

TOP10 = """top10 AS (
  SELECT * FROM metrics
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)"""

CLICKS_TOP10 = """clicks_top10 AS (
  SELECT event_id, CAST(click_category_id AS VARCHAR) AS category_id, session_id FROM visits
  WHERE coalesce(click_category_id, -1) <> -1
    AND CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top10))"""

T_MS = "(epoch_us(strptime({c}, '%Y-%m-%d %H:%M:%S')) // 1000)"


T_TRY = "epoch_us(try_strptime({c}, '%Y-%m-%d %H:%M:%S'))"

# Adjacent steps of visits with damaged times, in order of the time string (null first).
BAD_STEPS = """steps AS (SELECT * FROM (
    SELECT event_id, page_id AS page_from, action_time AS t_from, lead(page_id) OVER w AS page_to,
           lead(action_time) OVER w AS t_to, lead(1) OVER w AS has_next
    FROM (SELECT * REPLACE (CASE WHEN event_id % 5 = 0 THEN substr(action_time, 1, 18) || 'x'
                                 WHEN event_id % 7 = 0 THEN NULL ELSE action_time END AS action_time) FROM visits)
    WINDOW w AS (PARTITION BY session_id ORDER BY action_time NULLS FIRST, event_id))
  WHERE has_next IS NOT NULL)"""


def _steps(src: str = "visits") -> str:
    t = T_MS.format(c="action_time")
    return f"""steps AS (
  SELECT * FROM (
    SELECT event_id, page_id AS page_from,
           lead(page_id) OVER w AS page_to,
           {t} AS t_from_ms,
           lead({t}) OVER w AS t_to_ms,
           lead(1) OVER w AS has_next
    FROM {src} WINDOW w AS (PARTITION BY session_id ORDER BY action_time, event_id))
  WHERE has_next IS NOT NULL)"""


def _flow_conversion(src: str) -> str:
    return f"""flow AS (SELECT * FROM (VALUES {FLOW_VALUES}) AS t(page_from, page_to)),
views AS (SELECT page_id, count(*) AS views FROM {src} WHERE page_id IN ({FLOW_LIST}) GROUP BY page_id),
{_steps(src)},
hops AS (SELECT s.page_from, s.page_to, count(*) AS transitions
         FROM steps s JOIN flow f ON s.page_from = f.page_from AND s.page_to = f.page_to
         GROUP BY s.page_from, s.page_to)
SELECT h.page_from, h.page_to, h.transitions, coalesce(v.views, 1) AS views,
       CAST(h.transitions AS DOUBLE) / coalesce(v.views, 1) AS rate
FROM hops h LEFT JOIN views v ON h.page_from = v.page_id"""


AREA_CITY = """acd AS (SELECT date, area, city, ad_id, count(*) AS n FROM ad_clicks
            GROUP BY date, area, city, ad_id)"""
AREA_AD = """aad AS (SELECT date, area, ad_id, CAST(sum(n) AS BIGINT) AS n FROM acd
           GROUP BY date, area, ad_id)"""
TOP3 = """top3 AS (SELECT * FROM (
  SELECT date, area, ad_id, n,
         CAST(row_number() OVER (PARTITION BY date, area ORDER BY n DESC, ad_id) AS BIGINT) AS rk
  FROM aad) WHERE rk <= 3)"""
TOP3_JSON = """SELECT date, area,
       '{' || string_agg('"' || CAST(ad_id AS VARCHAR) || '":' || CAST(n AS VARCHAR), ',' ORDER BY rk) || '}' AS top3
FROM top3 GROUP BY date, area"""


def _blacklist(batch_expr: str = "batch", clicks: str = "ad_clicks", threshold: int = THRESHOLD) -> str:
    return f"""per_batch AS (SELECT date, ad_id, user_id, batch, count(*) AS c
              FROM (SELECT date, ad_id, user_id, {batch_expr} AS batch FROM {clicks})
              GROUP BY date, ad_id, user_id, batch),
running AS (SELECT user_id, batch,
                   sum(c) OVER (PARTITION BY date, ad_id, user_id ORDER BY batch
                                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
            FROM per_batch),
blacklist AS (SELECT user_id, CAST(min(batch) AS BIGINT) AS first_batch FROM running
              WHERE running >= {threshold} GROUP BY user_id)"""


TREND = """SELECT b * 10 + 10 * i AS window_end, b * 10 AS bucket, count(*) AS n
FROM (SELECT ts_ms // 10000 AS b, unnest([1, 2, 3, 4, 5, 6]) AS i FROM ad_clicks)
GROUP BY ALL"""

WORDS = """SELECT word, count(*) AS n FROM (
  SELECT unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
GROUP BY word"""

LINES = """lines AS (
  SELECT event_id, concat_ws(' ', CAST(ts_ms AS VARCHAR), area, city, CAST(user_id AS VARCHAR),
                             CAST(ad_id AS VARCHAR)) AS line
  FROM ad_clicks)"""

PARSED = f"""SELECT try_cast(f[1] AS BIGINT) AS ts_ms, f[2] AS area, f[3] AS city,
       try_cast(f[4] AS BIGINT) AS user_id, try_cast(f[5] AS BIGINT) AS ad_id,
       strftime(make_timestamp(try_cast(f[1] AS BIGINT) * 1000), '%Y-%m-%d') AS date
FROM (SELECT {_jsplit('line', ' ')} AS f FROM lines)
WHERE len(f) >= 5 AND try_cast(f[1] AS BIGINT) IS NOT NULL
  AND try_cast(f[4] AS BIGINT) IS NOT NULL AND try_cast(f[5] AS BIGINT) IS NOT NULL"""

# One staged file per span of STREAM_FILE_MS; the micro-batch id is the file's rank.
STREAM_FILE_MS = PARAMS["stream_file_ms"]
STREAM_BATCH = f"(dense_rank() OVER (ORDER BY ts_ms // {STREAM_FILE_MS}) - 1)"


# The clicks of users who had not been listed by an earlier micro-batch.
STREAM_KEPT = f"""kept AS (
  SELECT c.* FROM (SELECT *, {STREAM_BATCH} AS stream_batch FROM ad_clicks) c LEFT JOIN blacklist b ON c.user_id = b.user_id
  WHERE b.user_id IS NULL OR c.stream_batch <= b.first_batch)"""


def oracle_sql() -> dict[str, str]:
    v = f"WITH {VISITS}"
    a = f"WITH {AD_CLICKS}"
    al = f"WITH {AD_CLICKS_LINES}"
    q = {
        "visit_scan": f"{v} SELECT * FROM visits",
        "visit_preview": f"{v} SELECT * FROM visits ORDER BY event_id LIMIT 100",
        "visit_date_range": f"{v} SELECT event_id, date FROM visits "
                            f"WHERE date >= '{D0}' AND date <= '{D1}'",
        "str_is_not_empty": r"""SELECT NOT regexp_matches(line, '^[\x00-\x20]*$') AS not_empty,
                   count(*) AS n
            FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
            GROUP BY 1""",
        "click_rows": f"{v} SELECT event_id, session_id, click_category_id FROM visits "
                      "WHERE coalesce(click_category_id, -1) <> -1",
        "action_kind_counts": f"{v}, {KINDS} SELECT coalesce(kind, 'none') AS kind, count(*) AS n "
                              "FROM kinds GROUP BY 1",
        "category_metric_counts": f"{v}, {KINDS}, {IDS} SELECT category_id, kind, count(*) AS n "
                                  "FROM ids GROUP BY category_id, kind",
        "category_metrics": f"{v}, {KINDS}, {IDS}, {METRICS} SELECT * FROM metrics",
        "category_top10": f"{v}, {KINDS}, {IDS}, {METRICS}, {TOP10} SELECT * FROM top10",
        "category_session_clicks": f"""{v} SELECT CAST(click_category_id AS VARCHAR) AS category_id,
                   session_id, count(*) AS click_count FROM visits
            WHERE coalesce(click_category_id, -1) <> -1 GROUP BY 1, 2""",
        "clicks_in_top10": f"{v}, {KINDS}, {IDS}, {METRICS}, {TOP10}, {CLICKS_TOP10} "
                           "SELECT * FROM clicks_top10",
        "category_top10_sessions": f"""{v}, {KINDS}, {IDS}, {METRICS}, {TOP10}, {CLICKS_TOP10},
            c AS (SELECT category_id, session_id, count(*) AS click_count FROM clicks_top10
                  GROUP BY category_id, session_id)
            SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category_id
                                ORDER BY click_count DESC, session_id) AS BIGINT) AS rn FROM c)
            WHERE rn <= 10""",
        "page_view_counts": f"{v} SELECT page_id, count(*) AS views FROM visits "
                            f"WHERE page_id IN ({FLOW_LIST}) GROUP BY page_id",
        "page_transition_counts": f"{v}, {_steps()} SELECT page_from, page_to, count(*) AS n "
                                  "FROM steps GROUP BY page_from, page_to",
        "page_flow_conversion": f"{v}, {_flow_conversion('visits')}",
        "page_flow_conversion_split": f"{v}, {_flow_conversion('visits')}",
        "page_flow_conversion_dated":
            f"{v}, dated AS (SELECT * FROM visits WHERE date >= '{FD0}' AND date <= '{FD1}'), "
            f"{_flow_conversion('dated')}",
        "page_dwell_rows": f"{v}, {_steps()} SELECT event_id, page_from AS page_id, "
                           "t_to_ms - t_from_ms AS dwell_ms FROM steps",
        "page_avg_dwell": f"""{v}, {_steps()} SELECT page_from AS page_id,
                   CAST(sum(t_to_ms - t_from_ms) // count(t_to_ms - t_from_ms) AS BIGINT) AS avg_dwell_ms
            FROM steps WHERE t_to_ms IS NOT NULL AND t_from_ms IS NOT NULL GROUP BY page_from""",
        "flow_pairs": f"""{v} SELECT event_id, i - 1 AS pos, ids[i] AS first, ids[i + 1] AS second
            FROM (SELECT event_id, ids, unnest(range(1, len(ids))) AS i FROM
                  (SELECT event_id, {_jsplit('order_category_ids', ',')} AS ids FROM visits
                   WHERE order_category_ids IS NOT NULL))""",
        "fn_split_explode": f"""{v} SELECT event_id, unnest(range(len(ids))) AS pos,
                   unnest(ids) AS category_id
            FROM (SELECT event_id, {_jsplit('order_category_ids', ',')} AS ids FROM visits
                  WHERE order_category_ids IS NOT NULL)""",
        "fn_format_time": f"""{a} SELECT event_id,
                   strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S') AS time_str,
                   strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS date_str FROM ad_clicks""",
        "fn_parse_time": f"{v} SELECT event_id, {T_MS.format(c='action_time')} AS action_ms "
                         "FROM visits",
        "fn_floor_10s": f"""{a} SELECT event_id,
                   substr(strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S'), 1, 18) || '0'
                     AS bucket_time,
                   ts_ms // 10000 * 10 AS bucket_s FROM ad_clicks""",
        "fn_substring": f"{v} SELECT event_id, substr(action_time, 1, 10) AS day, "
                        "substr(action_time, 12, 2) AS hour FROM visits",
        "fn_json_field": "SELECT event_id, json_extract_string(props, '$.k') AS k, "
                         "json_extract_string(props, '$.missing') AS missing FROM events",
        "ad_log_format": f"""{al} SELECT event_id, concat_ws(' ', CAST(ts_ms AS VARCHAR), area, city,
                   CAST(user_id AS VARCHAR), CAST(ad_id AS VARCHAR)) AS line FROM ad_clicks""",
        "ad_log_parse": f"{al}, {LINES} {PARSED}",
        "ad_log_publish_roundtrip": f"{al}, {LINES} {PARSED}",
        "area_city_ad_daily": f"{a}, {AREA_CITY} SELECT * FROM acd",
        "area_ad_daily": f"{a}, {AREA_CITY}, {AREA_AD} SELECT * FROM aad",
        "area_top3_ads": f"{a}, {AREA_CITY}, {AREA_AD}, {TOP3} SELECT * FROM top3",
        "area_top3_ads_json": f"{a}, {AREA_CITY}, {AREA_AD}, {TOP3} {TOP3_JSON}",
        "ad_user_daily": f"{a} SELECT date, ad_id, user_id, count(*) AS n FROM ad_clicks "
                         "GROUP BY date, ad_id, user_id",
        "ad_blacklist": f"{a}, {_blacklist()} SELECT * FROM blacklist",
        "ad_blacklist_default": f"""{a}, heavy AS (SELECT * REPLACE (CASE WHEN event_id % 100 < 45 THEN 0 ELSE user_id END AS user_id,
                   CASE WHEN event_id % 100 < 45 THEN 1 ELSE ad_id END AS ad_id) FROM ad_clicks),
            {_blacklist(clicks="heavy", threshold=100)} SELECT * FROM blacklist""",
        "page_transitions_bad_times": f"{v}, {BAD_STEPS} SELECT page_from, page_to, count(*) AS n FROM steps GROUP BY ALL",
        "page_transitions_bad_times_split": f"{v}, {BAD_STEPS} SELECT page_from, page_to, count(*) AS n FROM steps GROUP BY ALL",
        "page_dwell_dropped": f"""{v}, {BAD_STEPS} SELECT event_id, page_from AS page_id FROM steps
            WHERE {T_TRY.format(c='t_to')} - {T_TRY.format(c='t_from')} IS NULL""",
        "str_blank_lines": r"""SELECT NOT regexp_matches(line, '^[\x00-\x20]*$') AS not_empty, count(*) AS n
            FROM (SELECT unnest(string_split(text || chr(10) || ' ' || chr(9) || chr(10), chr(10))) AS line FROM documents)
            GROUP BY 1""",
        "fn_split_empty_ids": f"""{v} SELECT event_id, unnest(range(len(ids))) AS pos, unnest(ids) AS category_id
            FROM (SELECT event_id, {_jsplit('raw', ',')} AS ids FROM (SELECT event_id,
                  CASE WHEN event_id % 3 = 0 THEN ',,' ELSE ',,' || order_category_ids || ',,7,,' END AS raw
                  FROM visits WHERE order_category_ids IS NOT NULL))""",
        "stream_rejects": f"""{al}, {LINES} SELECT job, substr(line, 1, 15) AS value, count(*) AS n
            FROM lines, (SELECT unnest(['r5', 'r6', 'r7', 'a11']) AS job) WHERE event_id % 7 = 0 GROUP BY ALL""",
        "stream_trend_latest": f"""{a}, b AS (SELECT ts_ms // 10000 * 10 AS bucket, count(*) AS n FROM ad_clicks GROUP BY 1)
            SELECT row_number() OVER (ORDER BY bucket) AS pos, bucket, n FROM b
            WHERE bucket > (SELECT max(bucket) FROM b) - 60""",
        "stream_trend_arrival": f"""{a}, spans AS (SELECT span, (row_number() OVER (ORDER BY span) - 1) * {PARAMS['arrival_step_s']} // 10 AS slot
                FROM (SELECT DISTINCT ts_ms // {PARAMS['stream_file_ms']} AS span FROM ad_clicks)),
            c AS (SELECT slot, ts_ms // 10000 * 10 AS bucket, count(*) AS n FROM ad_clicks
                  JOIN spans ON span = ts_ms // {PARAMS['stream_file_ms']} GROUP BY ALL)
            SELECT (s.slot + 1) * 10 AS window_end, c.bucket, sum(c.n)::BIGINT AS n
            FROM (SELECT DISTINCT slot FROM spans) s JOIN c ON c.slot > s.slot - 6 AND c.slot <= s.slot GROUP BY ALL""",
        "fn_format_date": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events",
        "ad_clicks_kept": f"""{a}, {_blacklist()} SELECT c.event_id, c.user_id, c.batch
            FROM ad_clicks c LEFT JOIN blacklist b ON c.user_id = b.user_id
            WHERE b.user_id IS NULL OR c.batch <= b.first_batch""",
        "ad_clicks_kept_sketch": f"""{a}, {_blacklist()} SELECT c.event_id, c.user_id, c.batch
            FROM ad_clicks c LEFT JOIN blacklist b ON c.user_id = b.user_id
            WHERE b.user_id IS NULL OR c.batch <= b.first_batch""",
        "ad_key_counts": f"{a} SELECT concat_ws('_', date, area, city, ad_id) AS key, count(*) AS n FROM ad_clicks GROUP BY 1",
        "page_views_by_step": f"""{v} SELECT s.step, s.page_id, count(*) AS views FROM visits
            JOIN (SELECT unnest(range({len(FLOW)})) AS step, unnest([{FLOW_LIST}]) AS page_id) s USING (page_id) GROUP BY 1, 2""",
        "area_rollup": f"""{a} SELECT date, area, city, ad_id, grouping(city) = 1 AS all_cities, count(*) AS n
            FROM ad_clicks GROUP BY GROUPING SETS ((date, area, city, ad_id), (date, area, ad_id))""",
        "fn_parse_lenient": f"""{v}, t AS (SELECT event_id, strptime(action_time, '%Y-%m-%d %H:%M:%S') AS t FROM visits)
            SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN epoch_ms(t) ELSE
                epoch_ms(make_date(year(t) + (month(t) + 10) // 12, (month(t) + 10) % 12 + 1, 1)
                         + to_days((day(t) + 39)::INT) + to_hours(hour(t) + 30) + to_minutes(minute(t) + 70) + to_seconds(second(t) + 100))
                END AS action_ms FROM t""",
        "table_atomic_replace": f"""{v} SELECT 'before' AS reader, date, count(*) AS n FROM visits WHERE page_id <= 5 GROUP BY date
            UNION ALL SELECT 'after', date, count(*) FROM visits GROUP BY date""",
        "page_flow_bucketed": f"{v}, {_flow_conversion('visits')}",
        "ad_trend_10s": f"{a} {TREND}",
        "word_count": WORDS,
        # sinks: each must read back exactly what its source query computes
        "table_overwrite_roundtrip": f"{v} SELECT * FROM visits",
        "sink_set_add": f"{a}, {_blacklist()} SELECT user_id FROM blacklist",
        "sink_hash_increment": f"{a}, {AREA_CITY} SELECT * FROM acd",
        "sink_hash_set": f"{a}, {AREA_CITY}, {AREA_AD}, {TOP3} {TOP3_JSON}",
        # streaming: replayed through Structured Streaming, equal to the batch form
        "stream_area_city_ad_daily": f"{al}, {AREA_CITY} SELECT * FROM acd",
        "stream_ad_user_daily": f"{al} SELECT date, ad_id, user_id, count(*) AS n FROM ad_clicks "
                                "GROUP BY date, ad_id, user_id",
        "stream_area_top3_ads": f"{al}, {AREA_CITY}, {AREA_AD}, {TOP3} {TOP3_JSON}",
        "stream_ad_trend_10s": f"{al} {TREND}",
        "stream_ad_blacklist": f"{al}, {_blacklist(STREAM_BATCH)} SELECT * FROM blacklist",
        "stream_area_top3_listed": f"{al}, {_blacklist(STREAM_BATCH)}, {STREAM_KEPT}, "
                                   f"{AREA_CITY.replace('ad_clicks', 'kept')}, {AREA_AD}, {TOP3} {TOP3_JSON}",
        "stream_trend_listed": f"{al}, {_blacklist(STREAM_BATCH)}, {STREAM_KEPT} {TREND.replace('ad_clicks', 'kept')}",
        "stream_word_count": WORDS,
    }
    return q
