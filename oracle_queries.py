"""SQL twins of the registered queries, written independently of the Spark code.

Every statement starts from the table ``events``.  ``COMMON`` applies the derivation rules of
``demo_tables``; the statements then compute each result in plain SQL.
"""

from __future__ import annotations

AS_OF = "DATE '2024-01-30'"
EVENT_LIST = "['add_to_cart', 'click', 'order', 'view']"
CATEGORY_LIST = "['Burgers', 'Desserts', 'Drinks', 'Pizza', 'Salads']"
DEVICE_LIST = "['kiosk', 'mobile', 'tablet', 'web']"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


COMMON = """
WITH base AS (
    SELECT event_id AS seq, ts AS event_ts, user_id, event_type AS raw_type, value,
           CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 25 AS k
    FROM events
),
all_events AS (
    SELECT seq,
           CAST(seq AS VARCHAR) AS event_id,
           'rest_00' || CAST(seq % 3 + 1 AS VARCHAR) AS restaurant_id,
           's' || CAST(user_id % 7 AS VARCHAR) || '-'
               || CAST(CAST(date_trunc('week', event_ts) AS DATE) AS VARCHAR) AS session_id,
           CASE WHEN seq % 53 = 0 THEN 'soon'
                ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS "timestamp",
           CASE WHEN raw_type = 'signup' THEN 'add_to_cart'
                WHEN raw_type = 'purchase' AND k % 5 = 2 THEN 'click'
                WHEN raw_type = 'purchase' THEN 'order'
                WHEN raw_type = 'view' AND k % 5 = 4 THEN 'click'
                ELSE raw_type END AS event_type,
           'item_' || lpad(CAST(k AS VARCHAR), 3, '0') AS menu_item_id,
           'Item ' || CAST(k AS VARCHAR) AS menu_item_name,
           CASE k % 5 WHEN 0 THEN 'Burgers' WHEN 1 THEN 'Pizza' WHEN 2 THEN 'Salads'
                      WHEN 3 THEN 'Drinks' ELSE 'Desserts' END AS category,
           CASE WHEN seq % 97 = 0 THEN -value ELSE value END AS price,
           CASE WHEN user_id % 20 < 10 THEN 'mobile' WHEN user_id % 20 < 16 THEN 'web'
                WHEN user_id % 20 = 19 THEN 'tablet'
                WHEN event_ts < TIMESTAMP '2024-01-24' OR seq % 4 = 0 THEN 'kiosk'
                ELSE 'web' END AS device_type,
           CASE WHEN seq % 53 <> 0 THEN event_ts END AS event_ts,
           CASE WHEN seq % 3 = 0 THEN date_trunc('day', event_ts) + INTERVAL 1 DAY
                ELSE event_ts + to_hours(CAST(seq % 7 * 4 AS INTEGER))
                     + to_milliseconds(CAST(seq * 37 % 2000 - 500 AS INTEGER)) END AS ingested_at,
           CASE seq % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END AS platform
    FROM base
),
clickstream AS (
    SELECT *, CAST(ingested_at AS DATE) AS arrival, CAST(event_ts AS DATE) AS event_date
    FROM all_events WHERE event_type <> 'error' AND price > 0
)
"""

JUDGED = (
    COMMON
    + f"""
, shaped AS (
    SELECT seq, ingested_at, event_ts, seq % 41 AS form, event_id, restaurant_id,
           CASE WHEN seq % 41 = 8 THEN NULL ELSE session_id END AS session_id,
           CASE WHEN seq % 41 = 18 THEN 'soon' ELSE "timestamp" END AS "timestamp",
           CASE WHEN seq % 41 IN (7, 10) THEN 'VIEW' ELSE event_type END AS event_type,
           menu_item_id,
           CASE WHEN seq % 41 = 9 THEN ' \t' ELSE menu_item_name END AS menu_item_name,
           CASE WHEN seq % 41 = 11 THEN 'Sushi' ELSE category END AS category,
           price,
           CASE WHEN seq % 41 = 7 THEN NULL WHEN seq % 41 IN (11, 12) THEN 'watch'
                ELSE device_type END AS device_type,
           platform,
           CASE seq % 41 WHEN 13 THEN NULL WHEN 20 THEN NULL WHEN 14 THEN 0.0 WHEN 19 THEN 1.0
                ELSE price END AS number,
           CASE seq % 41 WHEN 13 THEN '"abc"' WHEN 14 THEN '0' WHEN 19 THEN 'true'
                WHEN 20 THEN '[1]' WHEN 15 THEN '"' || CAST(price AS VARCHAR) || '"'
                ELSE CAST(price AS VARCHAR) END AS price_json
    FROM all_events
),
texts AS (
    SELECT *,
           '{{"event_id":"' || event_id || '","restaurant_id":"' || restaurant_id
           || '","session_id":' || coalesce('"' || session_id || '"', 'null')
           || ',"timestamp":"' || "timestamp" || '","event_type":"' || event_type
           || '","menu_item_id":"' || menu_item_id
           || '","menu_item_name":"' || replace(menu_item_name, chr(9), '\\t')
           || '","category":"' || category || '","price":' || price_json
           || coalesce(',"device_type":"' || device_type || '"', '')
           || ',"platform":"' || platform || '"}}' AS line
    FROM shaped
),
verdicts AS (
    SELECT *,
           CASE WHEN form = 4 THEN 'junk ' || event_id
                WHEN form = 5 THEN '{{"body":' || event_id || '}}'
                WHEN form = 6 THEN '{{"body":"[1]"}}'
                WHEN form = 17 THEN line || ' x'
                WHEN form = 1 THEN '{{"body":"' || replace(line, '"', '\\"') || '"}}'
                WHEN form = 2 THEN '{{"body":' || line || '}}'
                WHEN form = 3 THEN '{{"body":null,' || substr(line, 2)
                WHEN form = 16 THEN '{{"ingested_at":"1999-01-01","user_id":"u1",' || substr(line, 2)
                ELSE line END AS value,
           CASE WHEN form IN (4, 5, 17) THEN 'Request body is not valid JSON'
                WHEN form = 6 THEN 'Request body must be a JSON object'
                WHEN form = 8 THEN 'Required field ''session_id'' must not be null or empty'
                WHEN form = 9 THEN 'Required field ''menu_item_name'' must not be null or empty'
                WHEN form = 7 THEN 'Missing required field: ''device_type'''
                WHEN event_type NOT IN ('view', 'click', 'add_to_cart', 'order')
                    THEN 'Invalid event_type ''' || event_type || {_text("'. Must be one of: " + EVENT_LIST)}
                WHEN form = 11 THEN {_text("Invalid category 'Sushi'. Must be one of: " + CATEGORY_LIST)}
                WHEN form = 12 THEN {_text("Invalid device_type 'watch'. Must be one of: " + DEVICE_LIST)}
                WHEN form = 13 THEN 'Field ''price'' must be a numeric value, got: str'
                WHEN form = 20 THEN 'Field ''price'' must be a numeric value, got: list'
                WHEN number <= 0
                    THEN 'Field ''price'' must be a positive number, got: ' || CAST(number AS VARCHAR)
           END AS error
    FROM texts
),
judged AS (
    SELECT seq, ingested_at, event_ts, form, value, line,
           CASE WHEN error IS NULL THEN 200 ELSE 400 END AS status,
           error,
           CASE WHEN error LIKE 'Request body%' THEN 'body'
                WHEN error LIKE 'Invalid %' THEN split_part(error, ' ', 2)
                WHEN error IS NOT NULL THEN split_part(error, '''', 2) END AS field,
           CASE WHEN error LIKE '%not valid JSON' THEN 'not_json'
                WHEN error LIKE '%JSON object' THEN 'not_object'
                WHEN error LIKE 'Missing%' THEN 'missing'
                WHEN error LIKE 'Required%' THEN 'empty'
                WHEN error LIKE 'Invalid%' THEN 'domain'
                WHEN error IS NOT NULL THEN 'price' END AS error_type,
           CASE WHEN form NOT IN (4, 5, 6, 17) THEN event_id END AS event_id,
           CASE WHEN form NOT IN (4, 5, 6, 17) THEN restaurant_id END AS restaurant_id,
           CASE WHEN form NOT IN (4, 5, 6, 17) THEN session_id END AS session_id,
           CASE WHEN form NOT IN (4, 5, 6, 17) THEN "timestamp" END AS "timestamp",
           CASE WHEN form NOT IN (4, 5, 6, 17) THEN event_type END AS event_type,
           CASE WHEN form NOT IN (4, 5, 6, 17) THEN menu_item_id END AS menu_item_id,
           CASE WHEN form NOT IN (4, 5, 6, 17) THEN menu_item_name END AS menu_item_name,
           CASE WHEN form NOT IN (4, 5, 6, 17) THEN category END AS category,
           CASE WHEN form NOT IN (4, 5, 6, 17) THEN device_type END AS device_type,
           CASE WHEN form NOT IN (4, 5, 6, 17) THEN number END AS price,
           platform
    FROM verdicts
)
"""
)

WEEK = f"BETWEEN {AS_OF} - 6 AND {AS_OF}"
MONTH = f"BETWEEN {AS_OF} - 29 AND {AS_OF}"

FIELDS = """event_id, restaurant_id, session_id, "timestamp", event_type, menu_item_id,
    menu_item_name, category, price, device_type, event_ts, ingested_at"""
PARTITIONS = """strftime(ingested_at, '%Y') AS year, strftime(ingested_at, '%m') AS month,
    strftime(ingested_at, '%d') AS day, strftime(ingested_at, '%H') AS hour"""
EXTRA = """'{"platform":"' || platform || '"}' AS extra"""

POPULAR_ITEMS = f"""
SELECT menu_item_name, category, total_interactions, views, clicks, add_to_cart_count, orders,
       round(revenue, 2) AS total_revenue
FROM (
    SELECT menu_item_id, menu_item_name, category, count(*) AS total_interactions,
           count(*) FILTER (WHERE event_type = 'view') AS views,
           count(*) FILTER (WHERE event_type = 'click') AS clicks,
           count(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_cart_count,
           count(*) FILTER (WHERE event_type = 'order') AS orders,
           coalesce(sum(price) FILTER (WHERE event_type = 'order'), 0) AS revenue
    FROM clickstream WHERE arrival {WEEK}
    GROUP BY menu_item_id, menu_item_name, category
)
ORDER BY total_interactions DESC, menu_item_id, menu_item_name, category LIMIT 20"""

HOURLY = f"""
SELECT CAST(hour(event_ts) AS INTEGER) AS hour_of_day, dayname(event_ts) AS day_of_week,
       CAST(isodow(event_ts) AS INTEGER) AS day_num, event_type, count(*) AS event_count
FROM clickstream WHERE arrival {WEEK} AND event_date {WEEK}
GROUP BY ALL"""

CATEGORY = f"""
SELECT s.*, r.conversion_rate
FROM (
    SELECT category, event_type, count(*) AS event_count,
           count(DISTINCT menu_item_id) AS unique_items,
           round(coalesce(sum(price), 0), 2) AS total_revenue, round(avg(price), 2) AS avg_price
    FROM clickstream WHERE arrival {MONTH} GROUP BY category, event_type
) s
LEFT JOIN (
    SELECT category,
           CASE WHEN count_if(event_type = 'view') > 0
                THEN round(count_if(event_type = 'order')::DOUBLE / count_if(event_type = 'view'), 4)
           END AS conversion_rate
    FROM clickstream WHERE arrival {MONTH} GROUP BY category
) r USING (category)"""

RATES = """
SELECT time_bucket(INTERVAL '5 minutes', ingested_at) AS window_start,
       time_bucket(INTERVAL '5 minutes', ingested_at) + INTERVAL '5 minutes' AS window_end,
       count(*) AS invocations,
       count(*) FILTER (WHERE status = 400) AS errors,
       count(*) FILTER (WHERE status = 200) AS delivered
FROM judged GROUP BY 1, 2"""



EVENT_QUERIES = {
    "arrival_window": f"""SELECT event_id, {PARTITIONS} FROM clickstream WHERE arrival {WEEK}""",
    "event_window": f"""SELECT event_id, "timestamp" FROM clickstream WHERE event_date {WEEK}""",
    "of_types": """SELECT event_id, event_type FROM clickstream
        WHERE event_type IN ('order', 'add_to_cart')""",
    "popular_items": POPULAR_ITEMS,
    "hourly_trends": HOURLY,
    "category_analysis": CATEGORY,
    "category_analysis_joined": CATEGORY,
    "category_conversion": f"""
        SELECT category,
               round(CAST(count(*) FILTER (WHERE event_type = 'order') AS DOUBLE)
                     / count(*) FILTER (WHERE event_type = 'view'), 4) AS conversion_rate
        FROM clickstream WHERE arrival {MONTH} GROUP BY category
        HAVING count(*) FILTER (WHERE event_type = 'view') > 0""",
    "device_breakdown": f"""
        SELECT restaurant_id, device_type, n AS event_count,
               round(CAST(100.0 AS DOUBLE) * n / CAST(sum(n) OVER (PARTITION BY restaurant_id)
                     AS DOUBLE), 2) AS percentage_of_restaurant_total, unique_sessions
        FROM (SELECT restaurant_id, device_type, count(*) AS n,
                     count(DISTINCT session_id) AS unique_sessions
              FROM clickstream WHERE arrival {WEEK} GROUP BY restaurant_id, device_type)""",
    "calculated_fields": f"""
        SELECT {FIELDS}, {EXTRA}, {PARTITIONS},
               CASE WHEN event_type = 'order' THEN 1 ELSE 0 END AS is_order,
               CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS is_view,
               CAST(hour(event_ts) AS INTEGER) AS hour_of_day,
               strftime(event_ts, '%a') AS day_of_week,
               CASE WHEN event_type = 'order' THEN price ELSE 0.0 END AS revenue
        FROM clickstream""",
    "item_interactions": f"""
        SELECT menu_item_name, category, count(event_id) AS event_count FROM clickstream
        WHERE event_date {WEEK} AND event_type IN ('order', 'add_to_cart')
        GROUP BY menu_item_name, category""",
    "revenue_by_item": f"""
        SELECT menu_item_name, round(sum(price), 2) AS revenue FROM clickstream
        WHERE event_date {WEEK} AND event_type = 'order' GROUP BY menu_item_name""",
    "heatmap": "SELECT hour_of_day"
    + "".join(
        f", CAST(sum(event_count) FILTER (WHERE day_of_week = '{day}') AS BIGINT) AS \"{day}\""
        for day in (
            "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
        )
    )
    + f" FROM ({HOURLY}) GROUP BY hour_of_day",
    "events_by_category": """SELECT category, count(event_id) AS event_count FROM clickstream
        GROUP BY category""",
    "category_event_breakdown": """SELECT category, event_type, count(event_id) AS event_count
        FROM clickstream GROUP BY category, event_type""",
    "revenue_kpi": f"""
        SELECT revenue, prior_revenue,
               round(CAST(100.0 AS DOUBLE) * (revenue - prior_revenue)
                     / nullif(prior_revenue, 0), 2) AS change_pct
        FROM (SELECT round(coalesce(sum(price) FILTER (WHERE event_date {WEEK}), 0), 2) AS revenue,
                     round(coalesce(sum(price) FILTER (
                         WHERE event_date BETWEEN {AS_OF} - 13 AND {AS_OF} - 7), 0), 2)
                         AS prior_revenue
              FROM clickstream WHERE event_type = 'order')""",
    "rolled_up_categories": f"""
        SELECT category, event_type, count(event_id) AS event_count,
               round(coalesce(sum(price) FILTER (WHERE event_type = 'order'), 0), 2) AS revenue
        FROM clickstream WHERE arrival {WEEK} GROUP BY category, event_type""",
    "events_by_device": """SELECT device_type, count(event_id) AS event_count FROM clickstream
        GROUP BY device_type""",
    "restaurant_device_pivot": "SELECT restaurant_id"
    + "".join(
        f", count(*) FILTER (WHERE device_type = '{device}') AS {device}_events"
        f", count(DISTINCT session_id) FILTER (WHERE device_type = '{device}') AS {device}_sessions"
        for device in ("mobile", "tablet", "kiosk", "web")
    )
    + " FROM clickstream GROUP BY restaurant_id",
    "device_daily_trend": """SELECT CAST(event_date AS VARCHAR) AS event_date, device_type, count(event_id) AS event_count
        FROM clickstream WHERE event_date IS NOT NULL GROUP BY event_date, device_type""",
    "category_daily_views": """SELECT CAST(event_date AS VARCHAR) AS event_date, category, count(*) AS views FROM clickstream
        WHERE event_type = 'view' AND event_date IS NOT NULL GROUP BY event_date, category""",
    "hourly_profile": """SELECT CAST(hour(event_ts) AS INTEGER) AS hour_of_day,
        count(*) AS event_count FROM clickstream WHERE event_ts IS NOT NULL GROUP BY 1""",
    "device_platform_mix": """SELECT device_type, platform, count(DISTINCT session_id) AS sessions,
        count(*) FILTER (WHERE event_type = 'view') AS views
        FROM clickstream GROUP BY device_type, platform""",
    "device_dropoff": f"""
        SELECT restaurant_id, device_type, current_count, prior_count,
               coalesce(CAST(current_count AS DOUBLE) / nullif(prior_count, 0) < 0.5, false)
                   AS dropped
        FROM (SELECT restaurant_id, device_type,
                     count(*) FILTER (WHERE arrival {WEEK}) AS current_count,
                     count(*) FILTER (WHERE arrival < {AS_OF} - 6) AS prior_count
              FROM clickstream WHERE arrival BETWEEN {AS_OF} - 13 AND {AS_OF}
              GROUP BY restaurant_id, device_type)""",
    "session_funnel": """
        SELECT restaurant_id,
               count(*) FILTER (WHERE v) AS viewed,
               count(*) FILTER (WHERE v AND c) AS clicked,
               count(*) FILTER (WHERE v AND c AND a) AS carted,
               count(*) FILTER (WHERE v AND c AND a AND o) AS ordered
        FROM (SELECT restaurant_id, session_id, menu_item_id,
                     bool_or(event_type = 'view') AS v, bool_or(event_type = 'click') AS c,
                     bool_or(event_type = 'add_to_cart') AS a, bool_or(event_type = 'order') AS o
              FROM clickstream GROUP BY restaurant_id, session_id, menu_item_id)
        GROUP BY restaurant_id""",
    "clock_skew": """
        SELECT device_type, events, unparsed, low / 1e6 AS min_skew_s, high / 1e6 AS max_skew_s,
               sign(p95) * (abs(p95) - abs(p95) % CAST(pow(10, greatest(
                   length(CAST(abs(p95) AS VARCHAR)) - 3, 0)) AS BIGINT)) / 1e6 AS p95_skew_s,
               negative
        FROM (
            SELECT device_type, count(*) AS events, count(*) FILTER (WHERE skew IS NULL) AS unparsed,
                   min(skew) AS low, max(skew) AS high, quantile_disc(skew, 0.95) AS p95,
                   count(*) FILTER (WHERE skew < 0) AS negative
            FROM (SELECT device_type, epoch_us(ingested_at) - epoch_us(event_ts) AS skew
                  FROM clickstream)
            GROUP BY device_type
        )""",
    "clock_skew_stored": f"""
        SELECT device_type, count(*) AS events, count(*) FILTER (WHERE skew IS NULL) AS unparsed,
               min(skew) / 1e6 AS min_skew_s, max(skew) / 1e6 AS max_skew_s,
               count(*) FILTER (WHERE skew < 0) AS negative, true AS p95_right
        FROM (SELECT device_type, epoch_us(ingested_at) - epoch_us(event_ts) AS skew
              FROM clickstream WHERE arrival {WEEK})
        GROUP BY device_type""",
    "late_arrivals": f"""
        SELECT {FIELDS}, {EXTRA}, {PARTITIONS} FROM clickstream
        WHERE arrival {WEEK} AND NOT event_date {WEEK}""",
}

PAYLOAD_QUERIES = {
    "validate_events": """SELECT seq, status, error_type, field, error, event_type, price
        FROM judged""",
    "acknowledge": """
        SELECT seq, status,
               CASE WHEN status = 200 THEN '{"status":"ok","event_id":"' || event_id || '"}'
                    ELSE '{"error":"' || error || '","field":"' || field || '"}' END AS body
        FROM judged""",
    "accepted_events": f"""
        SELECT event_id, restaurant_id, session_id, "timestamp", event_type, menu_item_id,
               menu_item_name, category, price, device_type,
               CASE WHEN form <> 18 THEN event_ts END AS event_ts, ingested_at, {PARTITIONS},
               CASE WHEN form = 3 THEN '{{"body":null,"platform":"' || platform || '"}}'
                    WHEN form = 16 THEN '{{"platform":"' || platform || '","user_id":"u1"}}'
                    ELSE '{{"platform":"' || platform || '"}}' END AS extra
        FROM judged WHERE status = 200""",
    "rejected_events": """
        SELECT error_type, error, field, event_id, restaurant_id, left(value, 200) AS raw_excerpt,
               value
        FROM judged WHERE status = 400""",
    "rejection_summary": """SELECT field, count(*) AS rejected FROM judged WHERE status = 400
        GROUP BY field""",
    "ingest_summary": """
        SELECT dimension, value, event_count, rejected_pct, rejected_pct > 10 AS warn
        FROM (SELECT dimension, value, count(*) AS event_count,
                     round(CAST(100.0 AS DOUBLE) * count(*) FILTER (WHERE status = 400)
                           / count(*), 2) AS rejected_pct
              FROM (SELECT 'event_type' AS dimension, coalesce(event_type, 'unknown') AS value,
                           status FROM judged
                    UNION ALL SELECT 'restaurant_id', coalesce(restaurant_id, 'unknown'), status
                    FROM judged
                    UNION ALL SELECT 'device_type', coalesce(device_type, 'unknown'), status
                    FROM judged
                    UNION ALL SELECT 'total', 'all', status FROM judged)
              GROUP BY dimension, value)""",
    "ingest_rate_5min": RATES,
    "stream_ingest_rate": RATES,
    "ingest_error_alarm": f"""SELECT window_start, window_end, errors FROM ({RATES})
        WHERE errors >= 10""",
    "ingest_error_alarm_of_two": f"""SELECT window_start, window_end, errors FROM ({RATES})
        WHERE errors >= 2""",
    "stream_alarm": f"""SELECT window_start, window_end, errors FROM ({RATES})
        WHERE errors >= 2""",
    "stream_alarm_transitions": """
        , rates AS (
            SELECT coalesce(restaurant_id, 'unknown') AS alarm,
                   time_bucket(INTERVAL 5 MINUTE, ingested_at) AS start,
                   count(*) FILTER (WHERE status = 400) AS errors
            FROM judged GROUP BY ALL
        ),
        heard AS (SELECT date_trunc('milliseconds', max(ingested_at)) - INTERVAL 10 MINUTE AS upto FROM judged),
        closed AS (SELECT rates.*, upto, lead(start) OVER (PARTITION BY alarm ORDER BY start) AS following
                   FROM rates, heard WHERE start + INTERVAL 5 MINUTE <= upto),
        states AS (
            SELECT alarm, start AS "at", errors, CASE WHEN errors >= 2 THEN 'ALARM' ELSE 'OK' END AS state
            FROM closed
            UNION ALL
            SELECT alarm, start + INTERVAL 5 MINUTE, 0, 'OK' FROM closed
            WHERE following > start + INTERVAL 5 MINUTE
               OR following IS NULL AND start + INTERVAL 10 MINUTE <= upto
        ),
        steps AS (SELECT *, lag(state) OVER (PARTITION BY alarm ORDER BY "at") AS was FROM states)
        SELECT alarm, "at", was AS old_state, state AS new_state, errors FROM steps
        WHERE was IS DISTINCT FROM state""",
    "payload_drift": """
        SELECT 'platform' AS "column", count(*) AS payloads, 'added' AS kind
        FROM judged WHERE form NOT IN (4, 5, 6, 17)
        UNION ALL SELECT 'body', count(*), 'added' FROM judged WHERE form = 3
        UNION ALL SELECT 'user_id', count(*), 'added' FROM judged WHERE form = 16
        UNION ALL SELECT 'ingested_at', count(*), 'added' FROM judged WHERE form = 16""",
    "landed_rejects": f"""SELECT {PARTITIONS}, error_type, field, error, value
        FROM judged WHERE status = 400""",
    "compacted_lake": f"""SELECT {PARTITIONS}, count(*) AS events, 1 AS files,
        count(DISTINCT seq % 2) AS batches, round(sum(price), 2) AS price_sum
        FROM judged WHERE status = 200 GROUP BY ALL""",
    "replayed_lake": f"""SELECT {PARTITIONS}, count(*) AS events, 1 AS files,
        count(DISTINCT seq % 2) AS batches, round(sum(price), 2) AS price_sum
        FROM judged WHERE status = 200 GROUP BY ALL""",
    "payload_schema_versions": """
        , members AS (
            SELECT strftime(ingested_at, '%Y-%m-%d-%H') AS hour_key, unnest(list_filter([
                {'c': 'event_id', 'k': 2}, {'c': 'restaurant_id', 'k': 2}, {'c': 'timestamp', 'k': 2},
                {'c': 'session_id', 'k': CASE WHEN form = 8 THEN 0 ELSE 2 END},
                {'c': 'event_type', 'k': 2}, {'c': 'menu_item_id', 'k': 2}, {'c': 'menu_item_name', 'k': 2},
                {'c': 'category', 'k': 2}, {'c': 'platform', 'k': 2},
                {'c': 'price', 'k': CASE WHEN form IN (13, 15) THEN 2 WHEN form = 19 THEN 4
                                         WHEN form = 20 THEN 8 ELSE 1 END},
                {'c': 'device_type', 'k': CASE WHEN form <> 7 THEN 2 END},
                {'c': 'body', 'k': CASE WHEN form = 3 THEN 0 END},
                {'c': 'user_id', 'k': CASE WHEN form = 16 THEN 2 END},
                {'c': 'ingested_at', 'k': CASE WHEN form = 16 THEN 2 END}
            ], lambda m: m.k IS NOT NULL)) AS m
            FROM judged WHERE form NOT IN (4, 5, 6, 17)
        ),
        hours AS (SELECT hour_key, m.c AS col, bit_or(m.k) AS kinds FROM members GROUP BY ALL),
        numbered AS (SELECT hour_key, row_number() OVER (ORDER BY hour_key) AS number
                     FROM (SELECT DISTINCT hour_key FROM hours)),
        merged AS (
            SELECT col, number, bit_or(kinds) OVER upto AS now,
                   lag(number) OVER by_hour AS last_seen, lead(number) OVER by_hour AS next_seen
            FROM hours JOIN numbered USING (hour_key)
            WINDOW by_hour AS (PARTITION BY col ORDER BY number),
                   upto AS (PARTITION BY col ORDER BY number ROWS UNBOUNDED PRECEDING)
        ),
        named AS (
            SELECT col, number, last_seen, next_seen,
                   CASE now WHEN 0 THEN 'null' WHEN 1 THEN 'number' WHEN 2 THEN 'string' WHEN 4 THEN 'boolean'
                            WHEN 8 THEN 'array' ELSE 'mixed' END AS kind
            FROM merged
        ),
        steps AS (SELECT *, lag(kind) OVER (PARTITION BY col ORDER BY number) AS was FROM named),
        changes AS (
            SELECT col, number, was AS old_type, kind AS new_type,
                   CASE WHEN was IS NULL THEN 'added' WHEN was <> kind THEN 'type' ELSE 'returned' END AS change
            FROM steps WHERE was IS NULL OR was <> kind OR last_seen < number - 1
            UNION ALL
            SELECT col, number + 1, kind, NULL, 'missing' FROM named
            WHERE next_seen IS DISTINCT FROM number + 1
        ),
        starts AS (SELECT DISTINCT number FROM changes WHERE change IN ('added', 'type'))
        SELECT (SELECT count(*) FROM starts s WHERE s.number <= c.number)::INTEGER AS version,
               hour_key[1:4] AS "year", hour_key[6:7] AS "month", hour_key[9:10] AS "day",
               hour_key[12:13] AS "hour", col AS "column", change, old_type, new_type
        FROM changes c JOIN numbered USING (number)""",
    "catalog_events": f"""SELECT event_id, event_type, {PARTITIONS} FROM judged
        WHERE status = 200 AND CAST(ingested_at AS DATE) {WEEK}""",
    "stream_dedup": """SELECT event_id, min(price) AS price FROM judged WHERE status = 200
        GROUP BY event_id""",
    "stream_dedup_state": """SELECT event_id, min(price) AS price FROM judged WHERE status = 200
        GROUP BY event_id""",
    "stream_ingest": """
        SELECT event_type, count(*) AS events, round(sum(price), 2) AS price_sum,
               count(DISTINCT session_id) AS sessions
        FROM judged WHERE status = 200 GROUP BY event_type""",
    "stream_rejects": """SELECT error_type, field, count(*) AS rejected
        FROM judged WHERE status = 400 GROUP BY error_type, field""",
}


LANDED = f"""
SELECT {PARTITIONS}, event_id, event_type, price,
       CASE WHEN form <> 18 THEN event_ts END AS event_ts, platform
FROM judged WHERE status = 200"""

PAYLOAD_QUERIES["stream_flushes"] = """
SELECT CASE seq % 3 WHEN 0 THEN 'start' WHEN 1 THEN 'size' ELSE 'waits, time' END AS flush,
       count(*) AS events, round(sum(price), 2) AS price_sum
FROM judged WHERE status = 200 GROUP BY ALL"""
PAYLOAD_QUERIES["device_platform_mix_landed"] = """
SELECT device_type, platform, count(DISTINCT session_id) AS sessions,
       count(*) FILTER (WHERE event_type = 'view') AS views
FROM judged WHERE status = 200 GROUP BY device_type, platform"""
PAYLOAD_QUERIES |= {name: LANDED for name in ("landed_json", "landed_parquet")}


# Stored and fetched results, by report.
SUITE_QUERIES = {
    "device_breakdown_of": EVENT_QUERIES["device_breakdown"],
    "category_conversion_of": EVENT_QUERIES["category_conversion"],
    **{f"{name}_from_partials": EVENT_QUERIES[name]
       for name in ("device_breakdown", "restaurant_device_pivot", "category_analysis")},
    "report_table": f"""SELECT * FROM ({EVENT_QUERIES["device_breakdown"]})""",
    "suite_status": f"""
        SELECT name, status, least(n, 30) AS fetched, n > 30 AS truncated
        FROM (VALUES ('popular_items', 'SUCCEEDED', (SELECT count(*) FROM ({POPULAR_ITEMS}))),
                     ('hourly_trends', 'SUCCEEDED', (SELECT count(*) FROM ({HOURLY}))),
                     ('category_analysis', 'SUCCEEDED', (SELECT count(*) FROM ({CATEGORY}))),
                     ('device_breakdown', 'SUCCEEDED',
                      (SELECT count(*) FROM ({EVENT_QUERIES["device_breakdown"]}))))
             AS r(name, status, n)""",
}


def statements() -> dict[str, str]:
    """Every statement with its common part."""
    over_events = {name: COMMON + sql for name, sql in {**EVENT_QUERIES, **SUITE_QUERIES}.items()}
    return over_events | {name: JUDGED + sql for name, sql in PAYLOAD_QUERIES.items()}
