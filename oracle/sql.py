"""Independent DuckDB SQL for every registered query.

DuckDB sees only the raw testdata views, so each statement starts with the
fixture CTEs that derive the model's inputs (written separately from the
Spark code, in DuckDB's dialect). Ratios use integer arithmetic, lists are
sorted, counts are BIGINT and every column is aliased to the Spark name.
Per-session order uses a plain window over the session here; the Spark side
uses range partitioning, so the two are independent.
"""

from __future__ import annotations

# Fixed task values shared with the Spark registry (clicklens.plans.catalog).
START_DATE = "2024-01-01"
END_DATE = "2024-01-30"
TASK_ID = 1
START_AGE, END_AGE = 20, 50
FLOW = [1, 2, 3, 4]
SAMPLE_SIZE = 2000
SAMPLE_SEED = "clicklens"
BLACKLIST_THRESHOLD = 2
AD_OLD_LAST_DAY = "2024-01-15"
AD_NEW_FIRST_DAY = "2024-01-10"
AD_STREAM_ORIGIN = "2024-01-01"
AD_STREAM_DAYS_PER_BATCH = 5
AD_LATE_BATCHES, AD_WATERMARK_DAYS = 3, 7
STORED_START, STORED_END = "2024-01-08", "2024-01-14"

CTES = r"""
ev AS (
  SELECT event_id, user_id, event_type,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         strftime(ts, '%Y-%m-%d') AS session_date,
         (user_id % 24) * 3600 + CAST(floor(((epoch_us(ts) // 1000000) % 86400) / 40) AS BIGINT) AS sec,
         ts
  FROM events
),
uva AS (
  SELECT session_date, user_id,
         CAST(user_id AS VARCHAR) || '_' || session_date AS session_id,
         k % 10 AS page_id,
         session_date || ' ' || CAST(sec // 3600 AS VARCHAR) || ':' || lpad(CAST((sec % 3600) // 60 AS VARCHAR), 2, '0')
           || ':' || lpad(CAST(sec % 60 AS VARCHAR), 2, '0') AS action_time,
         CAST(session_date AS TIMESTAMP) + to_seconds(sec) AS action_ts,
         event_id AS tie,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST(k % 20 AS VARCHAR) || ',' || CAST((k + 7) % 20 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k % 100 AS VARCHAR) || ',' || CAST((k + 7) % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 20 AS VARCHAR) || ',' || CAST((k + 3) % 20 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 100 AS VARCHAR) || ',' || CAST((k + 3) % 100 AS VARCHAR) END AS pay_product_ids,
         user_id % 25 AS city_id
  FROM ev
),
users AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(18 + c_custkey % 43 AS INTEGER) AS age, c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
cities AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_size % 2 AS VARCHAR) AS product_status
  FROM part
),
acts AS (
  SELECT * FROM uva WHERE session_date BETWEEN '{start}' AND '{end}'
),
sess AS (
  SELECT session_id, min(user_id) AS user_id,
         array_to_string(list_sort(list_distinct(list(CASE WHEN search_keyword <> '' THEN search_keyword END))), ',') AS search_keywords,
         array_to_string(list_sort(list_distinct(list(click_category_id))), ',') AS click_category_ids,
         list_distinct(list(CASE WHEN search_keyword <> '' THEN search_keyword END)) AS keyword_list,
         list_distinct(list(click_category_id)) AS category_list,
         (epoch_ms(max(action_ts)) - epoch_ms(min(action_ts))) // 1000 AS visit_length,
         count(*) AS step_length,
         strftime(min(action_ts), '%Y-%m-%d %H:%M:%S') AS start_time,
         min(action_ts) AS start_ts
  FROM acts GROUP BY session_id
),
enriched AS (
  SELECT s.*, u.age, u.professional, u.city, u.sex FROM sess s JOIN users u ON s.user_id = u.user_id
),
kept AS (
  SELECT * FROM enriched WHERE age BETWEEN {start_age} AND {end_age}
),
detail AS (
  SELECT * FROM acts WHERE session_id IN (SELECT session_id FROM kept)
),
cev AS (
  SELECT session_id, click_category_id AS category_id, 1 AS clicks, 0 AS orders, 0 AS pays
  FROM acts WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT session_id, CAST(trim(x) AS BIGINT), 0, 1, 0
  FROM (SELECT session_id, unnest(string_split(order_category_ids, ',')) AS x FROM acts WHERE order_category_ids IS NOT NULL)
  UNION ALL
  SELECT session_id, CAST(trim(x) AS BIGINT), 0, 0, 1
  FROM (SELECT session_id, unnest(string_split(pay_category_ids, ',')) AS x FROM acts WHERE pay_category_ids IS NOT NULL)
),
kscc AS (
  SELECT session_id, category_id, CAST(sum(clicks) AS BIGINT) AS click_count,
         CAST(sum(orders) AS BIGINT) AS order_count, CAST(sum(pays) AS BIGINT) AS pay_count
  FROM cev WHERE session_id IN (SELECT session_id FROM kept)
  GROUP BY session_id, category_id
),
catc AS (
  SELECT category_id, CAST(sum(click_count) AS BIGINT) AS click_count, CAST(sum(order_count) AS BIGINT) AS order_count,
         CAST(sum(pay_count) AS BIGINT) AS pay_count
  FROM kscc GROUP BY category_id
  HAVING sum(click_count) > 0 OR sum(order_count) > 0 OR sum(pay_count) > 0
),
top10 AS (
  SELECT * FROM catc ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
),
topsess AS (
  SELECT category_id, session_id, click_count FROM (
    SELECT category_id, session_id, click_count,
           row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn
    FROM kscc WHERE click_count > 0 AND category_id IN (SELECT category_id FROM top10)
  ) WHERE rn <= 10
),
kdh AS (
  SELECT *, strftime(start_ts, '%Y-%m-%d') AS date, strftime(start_ts, '%H') AS hour FROM kept
),
ph AS (
  SELECT date, hour, count(*) AS hour_count FROM kdh GROUP BY date, hour
),
pd AS (
  SELECT date, CAST(sum(hour_count) AS BIGINT) AS day_total, count(*) OVER () AS num_days FROM ph GROUP BY date
),
quota AS (
  SELECT ph.date, ph.hour, ph.hour_count, pd.day_total,
         least(ph.hour_count, CAST(floor(CAST(ph.hour_count AS DOUBLE) / CAST(pd.day_total AS DOUBLE)
                                          * CAST({sample} // pd.num_days AS DOUBLE)) AS BIGINT)) AS quota
  FROM ph JOIN pd ON ph.date = pd.date
),
sampled AS (
  SELECT * FROM (
    SELECT k.*, q.quota,
           row_number() OVER (PARTITION BY k.date, k.hour ORDER BY md5('{seed}' || k.session_id), k.session_id) AS rn
    FROM kdh k JOIN quota q ON k.date = q.date AND k.hour = q.hour
  ) WHERE rn <= quota
),
trn AS (
  SELECT * FROM (
    SELECT session_id, page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_ts, tie) AS next_page_id
    FROM acts
  ) WHERE next_page_id IS NOT NULL
),
steps AS (
  SELECT * FROM (VALUES {steps}) t(step, from_page, to_page, page_split)
),
matched AS (
  SELECT t.session_id, s.page_split
  FROM trn t JOIN (SELECT DISTINCT from_page, to_page, page_split FROM steps) s
    ON t.page_id = s.from_page AND t.next_page_id = s.to_page
),
pv AS (
  SELECT page_split, count(*) AS split_pv FROM matched GROUP BY page_split
),
spv AS (
  SELECT count(*) AS start_page_pv FROM acts WHERE page_id = {first_page}
),
rates AS (
  SELECT step, page_split, split_pv,
         CAST((200 * split_pv + prev) // nullif(2 * prev, 0) AS DOUBLE) / 100.0 AS convert_rate
  FROM (
    SELECT s.step, s.page_split, coalesce(pv.split_pv, 0) AS split_pv,
           coalesce(lag(coalesce(pv.split_pv, 0)) OVER (ORDER BY s.step), (SELECT start_page_pv FROM spv)) AS prev
    FROM steps s LEFT JOIN pv ON s.page_split = pv.page_split
  )
),
aclicks AS (
  SELECT city_id, click_product_id AS product_id FROM uva
  WHERE click_product_id IS NOT NULL AND session_date BETWEEN '{start}' AND '{end}'
),
acj AS (
  SELECT a.city_id, a.product_id, c.city_name, c.area FROM aclicks a JOIN cities c ON a.city_id = c.city_id
),
apc AS (
  SELECT area, product_id, count(*) AS click_count,
         array_to_string(list_sort(list_distinct(list(CAST(city_id AS VARCHAR) || ':' || city_name))), ',') AS city_infos
  FROM acj GROUP BY area, product_id
),
top3 AS (
  SELECT area, product_id, click_count, city_infos FROM (
    SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rn FROM apc
  ) WHERE rn <= 3
),
ad AS (
  SELECT make_timestamp((epoch_us(e.ts) // 1000) * 1000) AS ts, epoch_us(e.ts) // 1000 AS epoch_ms,
         replace(c.area, ' ', '_') AS province, replace(c.city_name, ' ', '_') AS city,
         e.user_id, e.k % 10 AS ad_id
  FROM ev e JOIN cities c ON e.user_id % 25 = c.city_id
  WHERE e.event_type = 'click'
),
adk AS (
  SELECT *, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute FROM ad
),
aucc AS (
  SELECT date, user_id, ad_id, count(*) AS click_count FROM adk GROUP BY date, user_id, ad_id
),
abl AS (
  SELECT DISTINCT user_id FROM aucc WHERE click_count >= {threshold}
),
adf AS (
  SELECT * FROM adk WHERE user_id NOT IN (SELECT user_id FROM abl)
),
astat AS (
  SELECT date, province, city, ad_id, count(*) AS click_count FROM adf GROUP BY date, province, city, ad_id
),
adb AS (
  SELECT *, date_diff('day', DATE '{origin}', CAST(date AS DATE)) // {days_per_batch} AS grp FROM adk
),
bl_grp AS (
  SELECT a.user_id, min(a.grp) AS grp
  FROM (SELECT date, user_id, ad_id, min(grp) AS grp, count(*) AS click_count FROM adb GROUP BY date, user_id, ad_id) a
  WHERE a.click_count >= {threshold} GROUP BY a.user_id
),
sadf AS (
  SELECT a.* FROM adb a LEFT JOIN bl_grp b ON a.user_id = b.user_id WHERE b.grp IS NULL OR a.grp <= b.grp
),
bad AS (
  SELECT date_diff('day', DATE '{origin}', CAST(session_date AS DATE)) // {days_per_batch} AS grp,
         CASE k % 3
           WHEN 0 THEN ms || ' P C ' || user_id
           WHEN 1 THEN ms || ' P C u' || user_id || ' ' || k % 10
           ELSE ms || 'x P C ' || user_id || ' ' || k % 10 END AS value
  FROM (SELECT *, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ms FROM ev WHERE event_type = 'error')
),
late AS (
  SELECT *, grp + CASE WHEN epoch_ms % 5 = 0 THEN {late_batches} ELSE 0 END AS b FROM adb
),
marks AS (
  SELECT o.b, max(l.epoch_ms) - {watermark_days} * 86400000 AS mark
  FROM (SELECT DISTINCT b FROM late) o JOIN late l ON l.b <= o.b - 2 GROUP BY o.b
),
old_ad AS (SELECT * FROM adk WHERE date <= '{old_last}'),
new_ad AS (SELECT * FROM adk WHERE date >= '{new_first}')
"""


def with_fixtures(body: str, start: str = START_DATE, end: str = END_DATE) -> str:
    steps = ", ".join(f"({i}, {FLOW[i - 1]}, {FLOW[i]}, '{FLOW[i - 1]}_{FLOW[i]}')" for i in range(1, len(FLOW)))
    ctes = CTES.format(
        start=start, end=end, late_batches=AD_LATE_BATCHES, watermark_days=AD_WATERMARK_DAYS, start_age=START_AGE, end_age=END_AGE, sample=SAMPLE_SIZE, seed=SAMPLE_SEED,
        steps=steps, first_page=FLOW[0], threshold=BLACKLIST_THRESHOLD, old_last=AD_OLD_LAST_DAY,
        new_first=AD_NEW_FIRST_DAY, origin=AD_STREAM_ORIGIN, days_per_batch=AD_STREAM_DAYS_PER_BATCH,
    )
    body = body.strip()
    if body.upper().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    return "WITH " + ctes.strip() + "\n" + body


def _bands():
    from clicklens.operators.bands import STEP_BANDS, VISIT_BANDS

    return VISIT_BANDS, STEP_BANDS


def _band_expr(col: str, lo: int, hi: int | None) -> str:
    return f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"


def band_counts_select(source: str) -> str:
    visit, step = _bands()
    parts = ["CAST(count(*) AS BIGINT) AS session_count"]
    parts += [f"CAST(count(*) FILTER (WHERE {_band_expr('visit_length', lo, hi)}) AS BIGINT) AS visit_length_{n}" for n, lo, hi in visit]
    parts += [f"CAST(count(*) FILTER (WHERE {_band_expr('step_length', lo, hi)}) AS BIGINT) AS step_length_{n}" for n, lo, hi in step]
    return f"SELECT {', '.join(parts)} FROM {source}"


def band_ratios_select(counts: str) -> str:
    visit, step = _bands()
    names = [f"visit_length_{n}" for n, _, _ in visit] + [f"step_length_{n}" for n, _, _ in step]
    ratio = lambda c: f"CAST((200 * {c} + session_count) // nullif(2 * session_count, 0) AS DOUBLE) / 100.0 AS {c}_ratio"
    return f"SELECT CAST({TASK_ID} AS BIGINT) AS task_id, session_count, {', '.join(ratio(c) for c in names)} FROM {counts}"


SESSION_COLS = "session_id, user_id, search_keywords, click_category_ids, visit_length, step_length, start_time"
ACTION_COLS = ("user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id, "
               "order_category_ids, order_product_ids, pay_category_ids, pay_product_ids")
DETAIL_COLS = f"CAST({TASK_ID} AS BIGINT) AS task_id, {ACTION_COLS}"
AD_COLS = "epoch_ms, province, city, user_id, ad_id"


def _kind(kind: str) -> str:
    col = {"click": "clicks", "order": "orders", "pay": "pays"}[kind]
    return with_fixtures(
        f"SELECT category_id, count(*) AS {kind}_count FROM cev "
        f"WHERE {col} = 1 AND session_id IN (SELECT session_id FROM kept) GROUP BY category_id"
    )


def _province_top3(source: str) -> str:
    return f"""
      SELECT date, province, ad_id, click_count FROM (
        SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rn FROM (
          SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM ({source}) GROUP BY date, province, ad_id
        )
      ) WHERE rn <= 3"""


def _stat(src: str) -> str:
    return f"SELECT date, province, city, ad_id, count(*) AS click_count FROM {src} GROUP BY date, province, city, ad_id"


def _trend(src: str) -> str:
    return f"SELECT date, hour, minute, ad_id, count(*) AS click_count FROM {src} GROUP BY date, hour, minute, ad_id"


def _ucount(src: str) -> str:
    return f"SELECT date, user_id, ad_id, count(*) AS click_count FROM {src} GROUP BY date, user_id, ad_id"


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    W = with_fixtures

    # sources
    q["actions_by_date"] = W(
        "SELECT session_date, user_id, session_id, page_id, action_time, search_keyword, click_category_id, "
        "click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id FROM acts"
    )
    q["user_info"] = W("SELECT user_id, age, professional, city, sex FROM users")
    q["product_info"] = W("SELECT product_id, product_name, product_status FROM products")
    q["area_click_scan"] = W("SELECT city_id, product_id FROM aclicks")
    q["ad_click_lookup"] = W(
        """SELECT k.date, k.user_id, k.ad_id, coalesce(c.click_count, 0) AS click_count
           FROM (SELECT DISTINCT session_date AS date, user_id, k % 10 AS ad_id FROM ev WHERE event_type <> 'click') k
           LEFT JOIN aucc c ON k.date = c.date AND k.user_id = c.user_id AND k.ad_id = c.ad_id"""
    )

    # filters
    q["filter_age"] = W(f"SELECT {SESSION_COLS} FROM enriched WHERE age BETWEEN 20 AND 50")
    q["filter_professional"] = W(f"SELECT {SESSION_COLS} FROM enriched WHERE professional IN ('BUILDING', 'MACHINERY')")
    q["filter_city"] = W(f"SELECT {SESSION_COLS} FROM enriched WHERE city IN ('NATION_1', 'NATION_7', 'NATION_13')")
    q["filter_sex"] = W(f"SELECT {SESSION_COLS} FROM enriched WHERE sex = 'female'")
    q["filter_keywords"] = W(f"SELECT {SESSION_COLS} FROM enriched WHERE list_has_any(keyword_list, ['kw1', 'kw3'])")
    q["filter_categories"] = W(
        f"SELECT {SESSION_COLS} FROM enriched WHERE list_has_any(category_list, [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[])"
    )
    q["filter_equal"] = W(f"SELECT {SESSION_COLS} FROM enriched WHERE professional = 'AUTOMOBILE'")
    q["filter_all"] = W(
        f"SELECT {SESSION_COLS} FROM enriched WHERE age BETWEEN 20 AND 50 AND sex = 'male' "
        "AND list_has_any(category_list, [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[])"
    )
    q["clicks_only"] = W(f"SELECT {ACTION_COLS} FROM acts WHERE click_category_id IS NOT NULL")
    q["orders_only"] = W(f"SELECT {ACTION_COLS} FROM acts WHERE order_category_ids IS NOT NULL")
    q["pays_only"] = W(f"SELECT {ACTION_COLS} FROM acts WHERE pay_category_ids IS NOT NULL")
    q["start_page_only"] = W(f"SELECT {ACTION_COLS} FROM acts WHERE page_id = {FLOW[0]}")
    q["flow_match"] = W("SELECT session_id, page_split FROM matched")

    # joins
    q["session_user_join"] = W(f"SELECT {SESSION_COLS}, age, professional, city, sex FROM enriched")
    q["session_detail"] = W(f"SELECT {DETAIL_COLS} FROM detail")
    q["category_counts"] = W("SELECT category_id, click_count, order_count, pay_count FROM catc")
    q["top_category_session_join"] = W(
        "SELECT category_id, session_id, click_count FROM kscc "
        "WHERE click_count > 0 AND category_id IN (SELECT category_id FROM top10)"
    )
    q["top10_session_detail"] = W(
        f"SELECT {DETAIL_COLS} FROM acts WHERE session_id IN (SELECT session_id FROM topsess)"
    )
    q["sample_session_detail"] = W(
        f"SELECT {DETAIL_COLS} FROM acts WHERE session_id IN (SELECT session_id FROM sampled)"
    )
    q["sample_index_lookup"] = W(
        "SELECT k.session_id, k.date, k.hour, q.quota FROM kdh k JOIN quota q ON k.date = q.date AND k.hour = q.hour"
    )
    q["flow_broadcast"] = W(
        "SELECT t.session_id, t.page_id, t.next_page_id, s.step FROM trn t "
        "JOIN steps s ON t.page_id = s.from_page AND t.next_page_id = s.to_page"
    )
    q["area_city_join"] = W("SELECT city_id, product_id, city_name, area FROM acj")
    q["area_product_join"] = W(
        "SELECT t.area, t.product_id, t.click_count, t.city_infos, p.product_name, p.product_status "
        "FROM top3 t LEFT JOIN products p ON t.product_id = p.product_id"
    )
    q["ad_blacklist_filter"] = W(f"SELECT {AD_COLS} FROM adf")

    # aggregations
    q["session_aggregate"] = W(f"SELECT {SESSION_COLS} FROM sess")
    q["session_band_counts"] = W(band_counts_select("kept"))
    q["session_band_ratios"] = W(f"SELECT * FROM ({band_ratios_select('(' + band_counts_select('kept') + ') c')})")
    q["total_detail_count"] = W("SELECT count(*) AS detail_count FROM detail")
    q["visited_categories"] = W("SELECT DISTINCT category_id FROM catc")
    q["category_click_count"] = _kind("click")
    q["category_order_count"] = _kind("order")
    q["category_pay_count"] = _kind("pay")
    q["sessions_per_hour"] = W("SELECT date, hour, hour_count FROM ph")
    q["sessions_per_day"] = W("SELECT date, day_total, num_days FROM pd")
    q["category_session_clicks"] = W("SELECT category_id, session_id, click_count FROM kscc WHERE click_count > 0")
    q["page_split_pv"] = W("SELECT page_split, split_pv FROM pv")
    q["start_page_pv"] = W("SELECT start_page_pv FROM spv")
    q["area_product_clicks"] = W("SELECT area, product_id, click_count, city_infos FROM apc")
    q["ad_user_click_count"] = W("SELECT date, user_id, ad_id, click_count FROM aucc")
    q["ad_blacklist"] = W("SELECT user_id FROM abl")
    q["ad_stat"] = W("SELECT * FROM astat")
    q["ad_click_trend"] = W(_trend("adf"))
    q["ad_click_trend_window"] = W(
        """SELECT strftime(make_timestamp(ws * 60000000), '%Y-%m-%d %H:%M:%S') AS window_start,
                  strftime(make_timestamp((ws + 60) * 60000000), '%Y-%m-%d %H:%M:%S') AS window_end,
                  ad_id, count(*) AS click_count
           FROM (SELECT ad_id, epoch_ms // 60000 - t.k AS ws FROM adf, range(0, 60) t(k))
           GROUP BY ws, ad_id"""
    )

    # per-group operators
    q["top10_session"] = W(f"SELECT CAST({TASK_ID} AS BIGINT) AS task_id, category_id, session_id, click_count FROM topsess")
    q["sample_quota"] = W("SELECT date, hour, hour_count, day_total, quota FROM quota")
    q["sample_sessions"] = W(
        f"SELECT CAST({TASK_ID} AS BIGINT) AS task_id, session_id, start_time, search_keywords, click_category_ids FROM sampled"
    )
    q["page_splits"] = W("SELECT session_id, page_id, next_page_id FROM trn")
    q["page_convert_rate"] = W(
        f"SELECT CAST({TASK_ID} AS BIGINT) AS task_id, step, page_split, split_pv, convert_rate FROM rates"
    )
    q["area_top3_product"] = W(
        f"""SELECT CAST({TASK_ID} AS BIGINT) AS task_id, t.area, CAST(NULL AS VARCHAR) AS area_level, t.product_id,
                  t.city_infos, t.click_count, p.product_name, p.product_status
           FROM top3 t LEFT JOIN products p ON t.product_id = p.product_id"""
    )
    q["ad_province_top3"] = W(_province_top3("SELECT * FROM astat"))

    # sorts / top-k
    q["top10_category"] = W(
        f"SELECT CAST({TASK_ID} AS BIGINT) AS task_id, category_id, click_count, order_count, pay_count FROM top10"
    )
    q["session_time_sort"] = W(
        "SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY action_ts, tie) AS step_index, "
        "page_id, tie AS event_id FROM acts"
    )

    # write rules
    q["sink_page_split_convert_rate"] = W(
        f"""SELECT CAST({TASK_ID} AS BIGINT) AS task_id,
                  string_agg(page_split || '=' || coalesce(CAST(convert_rate AS VARCHAR), 'null'), '|' ORDER BY step) AS convert_rate
           FROM rates"""
    )
    q["sink_session_aggr_stat"] = q["session_band_ratios"]
    q["sink_session_random_extract"] = q["sample_sessions"]
    q["sink_session_detail"] = W(
        f"""SELECT {DETAIL_COLS} FROM acts WHERE session_id IN (SELECT session_id FROM sampled)
           UNION ALL
           SELECT {DETAIL_COLS} FROM acts WHERE session_id IN (SELECT session_id FROM topsess)"""
    )
    q["sink_top10_category"] = q["top10_category"]
    q["sink_top10_session"] = q["top10_session"]
    q["sink_area_top3_product"] = q["area_top3_product"]
    q["sink_ad_user_click_count"] = W(
        f"""SELECT date, user_id, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM (
              {_ucount('old_ad')} UNION ALL {_ucount('new_ad')}
           ) GROUP BY date, user_id, ad_id"""
    )
    q["sink_ad_stat"] = W(
        f"""WITH o AS ({_stat('old_ad')}), n AS ({_stat('new_ad')})
           SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.date = o.date AND n.province = o.province
                                             AND n.city = o.city AND n.ad_id = o.ad_id)
           UNION ALL SELECT * FROM n"""
    )
    q["sink_ad_click_trend"] = W(
        f"""WITH o AS ({_trend('old_ad')}), n AS ({_trend('new_ad')})
           SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.date = o.date AND n.hour = o.hour
                                             AND n.minute = o.minute AND n.ad_id = o.ad_id)
           UNION ALL SELECT * FROM n"""
    )
    q["sink_ad_province_top3"] = W(
        f"""WITH o AS ({_province_top3(_stat('old_ad'))}), n AS ({_province_top3(_stat('new_ad'))})
           SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.date = o.date AND n.province = o.province)
           UNION ALL SELECT * FROM n"""
    )
    q["sink_ad_blacklist"] = W(
        f"""SELECT DISTINCT user_id FROM (
              SELECT user_id FROM ({_ucount('old_ad')}) WHERE click_count >= {BLACKLIST_THRESHOLD}
              UNION ALL
              SELECT user_id FROM ({_ucount('new_ad')}) WHERE click_count >= {BLACKLIST_THRESHOLD}
           )"""
    )

    # streaming: micro-batches of consecutive days in time order, so a user's
    # clicks count up to and including the first batch in which one of their
    # counts reached the threshold, and are dropped after it
    q["parse_ad_log"] = W(f"SELECT {AD_COLS} FROM ad")
    q["ad_user_counts_stream"] = W(_ucount("sadf"))
    q["blacklist_update"] = W("SELECT user_id FROM bl_grp")
    q["blacklist_scan"] = W("SELECT DISTINCT user_id FROM bl_grp")
    q["ad_stat_stream"] = W(_stat("sadf"))
    q["ad_province_top3_stream"] = W(_province_top3(_stat("sadf")))
    q["ad_click_trend_stream"] = W(_trend("sadf"))
    # a late click is left out when its minute had ended at the watermark: the
    # newest time of the batches up to the last but one, less the delay
    q["ad_click_trend_late"] = W(_trend(
        "(SELECT late.* FROM late LEFT JOIN marks USING (b) "
        "WHERE mark IS NULL OR (epoch_ms // 60000 + 1) * 60000 > mark)"))
    q["ad_stream_batches"] = W(
        """SELECT grp AS batch, count(*) AS n_lines, count(*) FILTER (kind = 'click') AS n_clicks,
                  count(*) FILTER (kind = 'blocked') AS n_blocked, count(*) FILTER (kind = 'bad') AS n_bad
           FROM (SELECT a.grp, CASE WHEN b.grp < a.grp THEN 'blocked' ELSE 'click' END AS kind
                 FROM adb a LEFT JOIN bl_grp b ON a.user_id = b.user_id
                 UNION ALL SELECT grp, 'bad' FROM bad) GROUP BY grp""")
    q["ad_bad_lines"] = W("SELECT grp AS batch, value FROM bad")
    q["ad_line_counts"] = W(
        """SELECT (SELECT count(*) FROM ad) + (SELECT count(*) FROM bad) AS n_lines, (SELECT count(*) FROM ad) AS n_parsed,
                  (SELECT count(*) FROM bad) AS n_bad""")

    # the stored log: dates inside the data
    in_range = lambda body: with_fixtures(body, STORED_START, STORED_END)
    q["stored_actions_by_date"] = in_range(
        f"SELECT session_date, {ACTION_COLS}, city_id, strftime(action_ts, '%Y-%m-%d %H:%M:%S') AS parsed_time FROM acts")
    q["stored_session_aggregate"] = in_range(f"SELECT {SESSION_COLS} FROM sess")
    q["stored_session_detail"] = in_range(f"SELECT {DETAIL_COLS} FROM detail")

    # optional forms
    q["top10_session_detail_each"] = W(
        f"SELECT {DETAIL_COLS} FROM acts JOIN (SELECT session_id FROM topsess) t USING (session_id)")
    q["category_counts_click_order"] = W(
        "SELECT category_id, click_count, order_count, pay_count FROM catc WHERE click_count > 0 OR order_count > 0")
    return q
