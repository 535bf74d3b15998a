"""The bound playback model in DuckDB SQL, one relation per table of :class:`viewtide.bind.Playback`."""

from __future__ import annotations


def half_up(num: str, den: str, digits: int) -> str:
    """``num / den`` rounded half up to ``digits`` decimals by integer arithmetic (both non-negative)."""
    f = 10 ** digits
    return (f"(CASE WHEN ({den}) > 0 THEN ((2 * {f} * CAST({num} AS HUGEINT) + CAST({den} AS HUGEINT)) "
            f"// (2 * CAST({den} AS HUGEINT))) / {f}.0 END)")


RELATIONS: dict[str, str] = {}

RELATIONS["ev"] = """
SELECT event_id, ts AS event_time, CAST(ts AS DATE) AS day, user_id, event_type, value, props,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, CAST(floor(value * 10) AS BIGINT) AS watch_seconds
FROM events"""

RELATIONS["titles"] = """
SELECT p_partkey AS k, p_type AS genre, p_size AS runtime_min, p_name FROM part"""

RELATIONS["landed"] = """
SELECT event_id, CAST(user_id AS VARCHAR) AS customer_id, user_id,
       CASE WHEN event_id % 307 = 0 THEN 'bad' || event_id
            WHEN k < 1000000 THEN 'tt' || lpad(CAST(k AS VARCHAR), 7, '0') ELSE 'tt' || k END AS title_id,
       'd' || (k % 10) AS device_id, 'd' || (k % 10) || '_v' || (k % 2) AS device_version_id, event_type,
       event_time AS event_timestamp,
       event_time + to_seconds((event_id * 7919) % 5400 + CASE WHEN event_id % 211 = 0 THEN 90000
                               WHEN event_id % 197 = 0 THEN -10800 ELSE 0 END) AS server_received_at,
       CAST(floor(value * 10000) AS BIGINT) AS position_ms,
       CASE k % 4 WHEN 0 THEN 1500 WHEN 1 THEN 3000 WHEN 2 THEN 5000 ELSE 8000 END AS bitrate_kbps,
       'C' || (user_id % 10) AS geo_country, 1 AS schema_version, day AS event_date,
       hour(event_time) AS event_hour
FROM ev"""

RELATIONS["landing"] = """
SELECT * FROM landed
UNION ALL
SELECT * REPLACE (server_received_at + INTERVAL 60 SECOND AS server_received_at, position_ms + 10000 AS position_ms)
FROM landed WHERE event_id % 50 = 0"""

RELATIONS["marked"] = """
SELECT *, CASE WHEN event_type NOT IN ('signup', 'purchase', 'view', 'click') THEN 'unknown_event_type'
               WHEN event_timestamp > server_received_at + INTERVAL 5 MINUTE THEN 'future_client_clock'
               WHEN NOT regexp_matches(title_id, '^tt[0-9]{7,10}$') THEN 'invalid_title_id'
               WHEN event_id IS NULL THEN 'missing_event_id'
               WHEN epoch_us(server_received_at) // 1000000 - epoch_us(event_timestamp) // 1000000 > 86400
               THEN 'stale_late_arrival' END AS reason
FROM landing"""

RELATIONS["quarantine"] = "SELECT * FROM marked WHERE reason IS NOT NULL"

RELATIONS["deduplicated"] = """
SELECT * EXCLUDE (rn, reason) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY server_received_at DESC) AS rn
  FROM marked WHERE reason IS NULL) WHERE rn = 1"""

RELATIONS["raw"] = """
SELECT * EXCLUDE (is_start), customer_id || '-' || CAST(sum(is_start) OVER (PARTITION BY user_id
         ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id
FROM (SELECT *, CASE WHEN lag(event_timestamp) OVER u IS NULL
                       OR event_timestamp - lag(event_timestamp) OVER u > INTERVAL 240 MINUTE
                     THEN 1 ELSE 0 END AS is_start
      FROM deduplicated WINDOW u AS (PARTITION BY user_id ORDER BY event_timestamp, event_id))"""

RELATIONS["titles_source"] = """
SELECT CASE WHEN p_partkey < 1000000 THEN 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0')
            ELSE 'tt' || p_partkey END AS tconst, p_name AS primary_title, p_type AS title_type,
       replace(p_name, ' ', ',') AS genres, p_size AS runtime_minutes,
       CAST((p_partkey % 91) / 10.0 + 1 AS DECIMAL(3, 1)) AS imdb_rating, p_partkey * 7 % 1000 AS num_votes
FROM part"""

RELATIONS["customers_source"] = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, sha256(CAST(c_custkey AS VARCHAR)) AS email_hash,
       DATE '2023-11-06' + CAST(c_custkey % 70 AS INTEGER) AS signup_date, n_name AS country,
       c_mktsegment AS plan_tier,
       CASE c_custkey % 4 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-49' ELSE '50+' END AS age_band,
       c_custkey % 5 + 1 AS household_size
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

RELATIONS["registry"] = """
SELECT 'd' || s_suppkey AS device_id, 'd' || s_suppkey || '_v' || v AS device_version_id,
       CASE s_suppkey % 4 WHEN 0 THEN 'tv' WHEN 1 THEN 'mobile' WHEN 2 THEN 'laptop' ELSE 'console' END
       AS device_type, n_name AS platform, s_name AS device_model, 'os' || s_nationkey AS os_version,
       'app' || v AS app_version, v = 0 AND s_acctbal < 0 AS is_deprecated
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey, (VALUES (0), (1)) AS versions(v)"""

RELATIONS["dim_title"] = "SELECT row_number() OVER (ORDER BY tconst) AS title_key, * FROM titles_source"
RELATIONS["dim_customer"] = ("SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * "
                             "FROM customers_source")
RELATIONS["dim_device"] = """
SELECT row_number() OVER (ORDER BY device_id) AS device_key, *
FROM (SELECT DISTINCT device_id, device_type, platform, device_model FROM registry)"""
RELATIONS["dim_device_version"] = """
SELECT row_number() OVER (ORDER BY device_version_id) AS device_version_key, device_version_id, r.device_id,
       device_key, os_version, app_version, is_deprecated
FROM registry r LEFT JOIN dim_device d ON r.device_id = d.device_id"""

RELATIONS["dim_date"] = """
SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_key, d AS full_date, year(d) AS year,
       quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, day(d) AS day,
       isodow(d) AS day_of_week, dayname(d) AS day_name, weekofyear(d) AS week_of_year,
       isodow(d) IN (6, 7) AS is_weekend, isodow(d) = 5 AS is_premiere_friday,
       CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) <= 5 THEN 'Spring'
            WHEN month(d) <= 8 THEN 'Summer' ELSE 'Fall' END AS season
FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2027-12-31', INTERVAL 1 DAY)) AS DATE) AS d)"""

RELATIONS["fact_events"] = """
SELECT event_id, session_id, customer_key, title_key, device_key, device_version_key,
       year(event_date) * 10000 + month(event_date) * 100 + day(event_date) AS date_key, event_type,
       event_timestamp, position_ms, bitrate_kbps, geo_country, event_date, event_hour, server_received_at
FROM raw r
LEFT JOIN dim_customer c ON r.customer_id = c.customer_id
LEFT JOIN dim_title t ON r.title_id = t.tconst
LEFT JOIN dim_device d ON r.device_id = d.device_id
LEFT JOIN (SELECT device_version_id, device_version_key FROM dim_device_version) v
       ON r.device_version_id = v.device_version_id"""

RELATIONS["session_agg"] = """
SELECT session_id,
       arg_min(customer_key, event_timestamp) FILTER (WHERE customer_key IS NOT NULL) AS customer_key,
       arg_min(title_key, event_timestamp) FILTER (WHERE title_key IS NOT NULL) AS title_key,
       arg_min(device_key, event_timestamp) FILTER (WHERE device_key IS NOT NULL) AS device_key,
       arg_min(device_version_key, event_timestamp) FILTER (WHERE device_version_key IS NOT NULL)
       AS device_version_key,
       min(event_timestamp) AS session_start_ts, max(event_timestamp) AS session_end_ts,
       max(position_ms) AS max_position_ms, count(*) FILTER (WHERE event_type = 'click') AS pause_count,
       count(*) FILTER (WHERE event_type = 'signup') AS seek_count,
       count(*) FILTER (WHERE event_type = 'view') AS play_resume_count,
       bool_or(event_type = 'purchase') AS was_completed
FROM fact_events GROUP BY session_id"""

RELATIONS["fact_sessions"] = f"""
SELECT session_id, customer_key, s.title_key, device_key, device_version_key,
       year(session_start_ts) * 10000 + month(session_start_ts) * 100 + day(session_start_ts) AS date_key,
       session_start_ts, session_end_ts,
       epoch_us(session_end_ts) // 1000000 - epoch_us(session_start_ts) // 1000000 AS watch_duration_seconds,
       runtime_minutes * 60 AS content_duration_seconds,
       CASE WHEN max_position_ms >= runtime_minutes * 60000 AND runtime_minutes > 0 THEN 1.0
            ELSE {half_up('max_position_ms', 'runtime_minutes * 60000', 3)} END AS completion_pct,
       pause_count, seek_count, play_resume_count, was_completed, false AS was_force_closed,
       session_end_ts AS _last_event_at, CAST(session_start_ts AS DATE) AS session_start_date
FROM session_agg s LEFT JOIN dim_title t ON s.title_key = t.title_key"""

RELATIONS["fact_daily"] = f"""
SELECT session_start_date AS engagement_date, any_value(date_key) AS date_key, customer_key, title_key,
       count(DISTINCT session_id) AS sessions_count, sum(watch_duration_seconds) AS total_watch_seconds,
       {half_up('sum(CAST(round(completion_pct * 1000) AS BIGINT))', 'count(completion_pct) * 1000', 3)}
       AS completion_pct,
       max(session_end_ts) AS last_session_end_ts,
       max(CASE WHEN was_completed THEN content_duration_seconds ELSE watch_duration_seconds END * 1000)
       AS last_position_ms
FROM fact_sessions GROUP BY session_start_date, customer_key, title_key"""

_MEASURES = f"""count(DISTINCT customer_key) AS distinct_viewers, count(*) AS sessions_count,
       CAST(sum(watch_duration_seconds) AS BIGINT) AS total_watch_seconds,
       count(*) FILTER (WHERE was_completed) AS completion_count,
       {half_up('count(*) FILTER (WHERE was_completed)', 'count(*)', 3)} AS completion_rate,
       CAST(sum(watch_duration_seconds) AS BIGINT) // count(*) AS avg_session_seconds"""

RELATIONS["content_mart"] = f"""
SELECT session_start_date AS engagement_date, s.title_key, tconst, primary_title, title_type, genres, {_MEASURES}
FROM fact_sessions s LEFT JOIN dim_title t ON s.title_key = t.title_key GROUP BY 1, 2, 3, 4, 5, 6"""

RELATIONS["device_mart"] = f"""
SELECT session_start_date AS engagement_date, device_type, platform, {_MEASURES}
FROM fact_sessions s LEFT JOIN dim_device d ON s.device_key = d.device_key GROUP BY 1, 2, 3"""

RELATIONS["session_genres"] = """
SELECT s.*, trim(g) AS genre FROM fact_sessions s
JOIN dim_title t ON s.title_key = t.title_key, unnest(string_split(t.genres, ',')) AS u(g)"""

RELATIONS["genre_mart"] = f"""
SELECT engagement_date, genre, watch_seconds,
       {half_up('watch_seconds * 100', 'day_total', 2)} AS pct_of_day
FROM (SELECT session_start_date AS engagement_date, genre, sum(watch_duration_seconds) AS watch_seconds,
             sum(sum(watch_duration_seconds)) OVER (PARTITION BY session_start_date) AS day_total
      FROM session_genres GROUP BY 1, 2)"""

RELATIONS["funnel_mart"] = """
SELECT session_start_date AS engagement_date, s.title_key, tconst, primary_title, title_type,
       CASE WHEN completion_pct IS NOT NULL
            THEN least(CAST(round(completion_pct * 1000) AS BIGINT) // 100, 9) END AS bucket,
       count(*) AS sessions_in_bucket
FROM fact_sessions s LEFT JOIN dim_title t ON s.title_key = t.title_key GROUP BY 1, 2, 3, 4, 5, 6"""
