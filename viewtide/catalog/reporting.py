"""Marts and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewtide.catalog.model import ts
from viewtide.catalog.registry import query
from viewtide.catalog.relations import half_up
from viewtide.operators.joins import attach
from viewtide.operators.windows import rolling_actives
from viewtide.plans import dims, marts, reports, sketches
from viewtide.session import work_path
from viewtide.sources import tables

CONTENT = ("engagement_date:s title_key:i tconst:s primary_title:s title_type:s genres:s distinct_viewers:i "
           "sessions_count:i total_watch_seconds:i completion_count:i completion_rate:d avg_session_seconds:i")


def day(text: str):
    return F.lit(text).cast("date")


@query("m1_content_engagement", CONTENT, "SELECT * FROM content_mart")
def content_engagement(p):
    return p.content_mart


@query("m1_content_one_day", CONTENT, "SELECT * FROM content_mart WHERE engagement_date = DATE '2024-01-10'")
def content_one_day(p):
    return marts.content_engagement(p.fact_sessions, p.dim_title, "2024-01-10")


@query("m1_content_quantiles", "engagement_date:s title_key:i p50_session_seconds:i p95_session_seconds:i",
       """SELECT session_start_date AS engagement_date, title_key,
          quantile_disc(watch_duration_seconds, 0.5) AS p50_session_seconds,
          quantile_disc(watch_duration_seconds, 0.95) AS p95_session_seconds FROM fact_sessions GROUP BY 1, 2""")
def content_quantiles(p):
    return marts.content_engagement(p.fact_sessions, p.dim_title, quantiles=True)


@query("m2_device_engagement", "engagement_date:s device_type:s platform:s sessions_count:i distinct_viewers:i "
       "total_watch_seconds:i avg_session_seconds:i completion_rate:d", "SELECT * FROM device_mart")
def device_engagement(p):
    return p.device_mart


@query("m3_genre_mix", "engagement_date:s genre:s watch_seconds:i pct_of_day:d", "SELECT * FROM genre_mart")
def genre_mix(p):
    return p.genre_mart


@query("m4_completion_funnel", "engagement_date:s title_key:i tconst:s primary_title:s title_type:s bucket:i "
       "sessions_in_bucket:i", "SELECT * FROM funnel_mart")
def completion_funnel(p):
    return p.funnel_mart


@query("m5_drop_off", "engagement_date:s title_key:i bucket_index:i bucket_low_pct:d sessions_reached:i "
       "drop_off_rate:d",
       f"""SELECT engagement_date, title_key, bucket_index, bucket_index / 10.0 AS bucket_low_pct, sessions_reached,
          {half_up('prev - sessions_reached', 'prev', 3)} AS drop_off_rate FROM (
          SELECT *, lag(sessions_reached) OVER (PARTITION BY engagement_date, title_key ORDER BY bucket_index) AS prev
          FROM (SELECT g.engagement_date, g.title_key, b.bucket_index, coalesce(sum(f.sessions_in_bucket), 0)
                AS sessions_reached FROM (SELECT DISTINCT engagement_date, title_key FROM funnel_mart
                WHERE bucket IS NOT NULL) g CROSS JOIN (SELECT unnest(range(10)) AS bucket_index) b
                LEFT JOIN funnel_mart f ON f.engagement_date = g.engagement_date
                AND f.title_key IS NOT DISTINCT FROM g.title_key AND f.bucket >= b.bucket_index GROUP BY 1, 2, 3))""")
def drop_off(p):
    return marts.drop_off(p.funnel_mart)


@query("m6_cohort_retention", "signup_week:s retention_week:s weeks_since_signup:i cohort_size:i active_customers:i "
       "retention_rate:d",
       f"""WITH c AS (SELECT customer_key, CAST(date_trunc('week', signup_date) AS DATE) AS signup_week
                      FROM dim_customer),
          z AS (SELECT signup_week, count(*) AS cohort_size FROM c GROUP BY 1),
          a AS (SELECT signup_week, CAST(date_trunc('week', session_start_date) AS DATE) AS retention_week,
                count(DISTINCT s.customer_key) AS active_customers FROM fact_sessions s JOIN c
                ON s.customer_key = c.customer_key GROUP BY 1, 2)
          SELECT a.signup_week, retention_week, (retention_week - a.signup_week) // 7 AS weeks_since_signup,
          cohort_size, active_customers, {half_up('active_customers', 'cohort_size', 3)} AS retention_rate
          FROM a JOIN z ON a.signup_week = z.signup_week WHERE retention_week >= a.signup_week""")
def cohort_retention(p):
    return marts.cohort_retention(p.dim_customer, p.fact_sessions)


@query("m7_device_quality", "engagement_date:s device_key:i device_version_key:i device_type:s platform:s "
       "sessions_count:i distinct_customers:i total_watch_seconds:i avg_bitrate_kbps:i completion_rate:d",
       f"""SELECT s.session_start_date AS engagement_date, s.device_key, s.device_version_key, device_type, platform,
          count(DISTINCT s.session_id) AS sessions_count, count(DISTINCT s.customer_key) AS distinct_customers,
          sum(CASE WHEN b.rn = 1 THEN watch_duration_seconds ELSE 0 END) AS total_watch_seconds,
          sum(bitrate_kbps) // count(bitrate_kbps) AS avg_bitrate_kbps,
          {half_up('count(DISTINCT CASE WHEN was_completed THEN s.session_id END)', 'count(DISTINCT s.session_id)', 3)}
          AS completion_rate
          FROM fact_sessions s JOIN (SELECT session_id, bitrate_kbps, row_number() OVER (PARTITION BY session_id)
          AS rn FROM raw) b ON s.session_id = b.session_id LEFT JOIN dim_device d ON s.device_key = d.device_key
          GROUP BY 1, 2, 3, 4, 5""")
def device_quality(p):
    p = p.stored("raw", "fact_sessions")
    return marts.device_quality(p.raw, p.fact_sessions, p.dim_device)


@query("m8_genre_mix_ext", "engagement_date:s genre_name:s total_watch_seconds:i sessions_count:i distinct_viewers:i "
       "share_of_watch_pct:d",
       f"""SELECT *, {half_up('total_watch_seconds', 'day_total', 4)} AS share_of_watch_pct FROM (
          SELECT session_start_date AS engagement_date, genre AS genre_name,
          sum(watch_duration_seconds) AS total_watch_seconds, count(*) AS sessions_count,
          count(DISTINCT customer_key) AS distinct_viewers,
          sum(sum(watch_duration_seconds)) OVER (PARTITION BY session_start_date) AS day_total
          FROM session_genres GROUP BY 1, 2)""")
def genre_mix_ext(p):
    return marts.genre_mix_ext(p.fact_sessions, p.dim_title)


@query("m9_content_from_daily", "engagement_date:s title_key:i distinct_viewers:i sessions_count:i "
       "total_watch_seconds:i completion_count:i completion_rate:d avg_session_seconds:i",
       f"""SELECT engagement_date, title_key, count(DISTINCT customer_key) AS distinct_viewers,
          sum(sessions_count) AS sessions_count, sum(total_watch_seconds) AS total_watch_seconds,
          count(*) FILTER (WHERE completion_pct >= 0.9) AS completion_count,
          {half_up('count(*) FILTER (WHERE completion_pct >= 0.9)', 'count(*)', 3)} AS completion_rate,
          floor(avg(total_watch_seconds / CAST(sessions_count AS DOUBLE))) AS avg_session_seconds
          FROM fact_daily WHERE title_key IS NOT NULL GROUP BY 1, 2""")
def content_from_daily(p):
    return marts.content_from_daily(p.fact_daily, p.dim_title)


# --- reports ---

@query("r1_top_titles", "tconst:s primary_title:s total_watch_seconds:i sessions_count:i",
       """SELECT tconst, primary_title, sum(total_watch_seconds) AS total_watch_seconds,
          sum(sessions_count) AS sessions_count FROM content_mart GROUP BY 1, 2
          ORDER BY 3 DESC, 1 LIMIT 10""")
def top_titles(p):
    return reports.top_titles(p.content_mart, 10)


@query("r1_top_titles_7d", "tconst:s primary_title:s total_watch_seconds:i sessions_count:i",
       """SELECT tconst, primary_title, sum(total_watch_seconds) AS total_watch_seconds,
          sum(sessions_count) AS sessions_count FROM content_mart WHERE engagement_date >= DATE '2024-01-24'
          GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10""")
def top_titles_week(p):
    return reports.top_titles(p.content_mart, 10, since=day("2024-01-24"))


@query("r2_top_genres", "genre:s watch_seconds:i",
       "SELECT genre, sum(watch_seconds) AS watch_seconds FROM genre_mart GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_genres(p):
    return reports.top_genres(p.genre_mart, 10)


@query("r3_device_breakdown", "device_type:s platform:s sessions_count:i total_watch_seconds:i",
       """SELECT device_type, platform, sum(sessions_count) AS sessions_count,
          sum(total_watch_seconds) AS total_watch_seconds FROM device_mart GROUP BY 1, 2""")
def device_breakdown(p):
    return reports.device_breakdown(p.device_mart)


@query("r4_completion_by_type", "title_type:s sessions:i completed:i completion_rate:d",
       f"""SELECT title_type, count(*) AS sessions, count(*) FILTER (WHERE was_completed) AS completed,
          {half_up('count(*) FILTER (WHERE was_completed)', 'count(*)', 3)} AS completion_rate
          FROM fact_sessions s JOIN dim_title t ON s.title_key = t.title_key GROUP BY 1""")
def completion_by_type(p):
    return reports.completion_by_type(p.fact_sessions, p.dim_title)


@query("r5_completion_by_genre", "genre_name:s avg_completion:d sessions:i",
       """SELECT genre AS genre_name, CAST(sum(CAST(round(completion_pct * 1000) AS BIGINT)) AS DOUBLE) / 1000
          / count(completion_pct) AS avg_completion, count(*) AS sessions FROM session_genres
          WHERE session_start_ts >= TIMESTAMP '2024-01-10' GROUP BY 1""")
def completion_by_genre(p):
    return reports.completion_by_genre(p.fact_sessions, p.dim_title, dims.build_dim_genre(p.titles_source),
                                       ts("2024-01-10"))


@query("r6_active_users", "dau:i wau:i mau:i",
       """SELECT count(DISTINCT CASE WHEN engagement_date = DATE '2024-01-24' THEN customer_key END) AS dau,
          count(DISTINCT CASE WHEN engagement_date >= DATE '2024-01-18' THEN customer_key END) AS wau,
          count(DISTINCT CASE WHEN engagement_date >= DATE '2023-12-26' THEN customer_key END) AS mau
          FROM fact_daily WHERE engagement_date < DATE '2024-01-25'""")
def active_users(p):
    return reports.active_users(p.fact_daily, day("2024-01-25"))


@query("r6_rolling_mau", "engagement_date:s actives:i",
       """SELECT d.engagement_date, count(DISTINCT customer_key) AS actives
          FROM (SELECT CAST(unnest(generate_series(min(engagement_date), max(engagement_date), INTERVAL 1 DAY)) AS DATE)
                AS engagement_date FROM fact_daily WHERE customer_key IS NOT NULL) d LEFT JOIN fact_daily a
          ON a.engagement_date <= d.engagement_date AND a.engagement_date > d.engagement_date - 30 GROUP BY 1""")
def rolling_mau(p):
    return rolling_actives(p.fact_daily, "customer_key", "engagement_date", 30)


@query("r6_sketch_actives", "engagement_date:s actives:i within_bound:s",
       """SELECT d.engagement_date, count(DISTINCT customer_key) AS actives, true AS within_bound
          FROM (SELECT CAST(unnest(generate_series(min(engagement_date), max(engagement_date), INTERVAL 1 DAY)) AS DATE)
                AS engagement_date FROM fact_daily WHERE customer_key IS NOT NULL) d LEFT JOIN fact_daily a
          ON a.engagement_date <= d.engagement_date AND a.engagement_date > d.engagement_date - 7 GROUP BY 1""")
def sketch_actives(p):
    """Weekly actives from stored daily sketches beside the exact ones: within four standard errors on every day."""
    p = p.stored("fact_daily")
    path = work_path(p.spark, "viewer-sketches")
    tables.replace_table(sketches.viewer_sketches(p.fact_daily, "customer_key", "engagement_date"), path, ["engagement_date"])
    estimated = sketches.rolling_viewers(tables.read_table(p.spark, path), "engagement_date", 7, out="estimate")
    exact = rolling_actives(p.fact_daily, "customer_key", "engagement_date", 7)
    off = F.abs(F.col("estimate") - F.col("actives")) <= F.greatest(F.lit(1.0), F.col("actives") * 4 * 1.04 / 2 ** (sketches.HLL_BITS / 2))
    return exact.join(estimated, "engagement_date", "left").withColumn("within_bound", F.coalesce(off, F.col("actives") == 0))


@query("m1_quantile_sketches", "title_type:s n:i within_bound:s",
       """SELECT title_type, count(watch_duration_seconds) AS n, true AS within_bound
          FROM fact_sessions s JOIN dim_title t ON s.title_key = t.title_key WHERE watch_duration_seconds IS NOT NULL GROUP BY 1""")
def quantile_sketches(p):
    """Watch-time quantiles per title type over all days, from stored daily sketches; their true ranks are within the bound."""
    p = p.stored("fact_sessions")
    path = work_path(p.spark, "quantile-sketches")
    rows = attach(p.fact_sessions, p.dim_title, "title_key", ["title_type"], "inner")
    tables.replace_table(sketches.quantile_sketches(rows, "watch_duration_seconds", "session_start_date", ["title_type"]), path,
                         ["session_start_date"])
    ps = {"p10": 0.1, "p50": 0.5, "p95": 0.95}
    found = sketches.rolled_up(tables.read_table(p.spark, path), ["title_type"], ps)
    errors = sketches.rank_errors(rows, "watch_duration_seconds", ["title_type"], found, ps)
    within = F.greatest(*[F.col(f"{n}_rank_error") for n in ps]) <= sketches.RANK_ERROR
    return found.join(errors, "title_type").select("title_type", "n", within.alias("within_bound"))


_LAST = "WHERE engagement_date = (SELECT max(engagement_date) FROM {m})"


@query("r7_panel_content", "primary_title:s title_type:s distinct_viewers:i sessions_count:i total_watch_seconds:i "
       "completion_rate:d", "SELECT * FROM content_mart " + _LAST.format(m="content_mart")
       + " ORDER BY total_watch_seconds DESC, title_key LIMIT 20")
def panel_content(p):
    return reports.panel("content_engagement_daily", p.content_mart)


@query("r7_panel_device", "device_type:s platform:s sessions_count:i distinct_viewers:i total_watch_seconds:i "
       "completion_rate:d", "SELECT * FROM device_mart " + _LAST.format(m="device_mart")
       + " ORDER BY total_watch_seconds DESC, device_type, platform LIMIT 20")
def panel_device(p):
    return reports.panel("device_engagement_daily", p.device_mart)


@query("r7_panel_genre", "genre:s watch_seconds:i pct_of_day:d", "SELECT * FROM genre_mart "
       + _LAST.format(m="genre_mart") + " ORDER BY watch_seconds DESC, genre LIMIT 20")
def panel_genre(p):
    return reports.panel("genre_mix_daily", p.genre_mart)


@query("r7_panel_funnel", "primary_title:s title_type:s bucket:i sessions_in_bucket:i", "SELECT * FROM funnel_mart "
       "WHERE engagement_date = DATE '2024-01-15' ORDER BY sessions_in_bucket DESC, title_key, bucket LIMIT 20")
def panel_funnel(p):
    return reports.panel("title_completion_funnel", p.funnel_mart, "2024-01-15")


@query("r8_most_engaged", "customer_key:i watch_seconds:i sessions_count:i",
       """SELECT customer_key, sum(total_watch_seconds) AS watch_seconds, sum(sessions_count) AS sessions_count
          FROM fact_daily WHERE engagement_date >= DATE '2024-01-18' AND engagement_date < DATE '2024-01-25'
          AND customer_key IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def most_engaged(p):
    return reports.most_engaged(p.fact_daily, day("2024-01-25"), 7)


@query("r9_watch_by_country", "country:s watch_seconds:i sessions:i",
       """SELECT country, sum(watch_duration_seconds) AS watch_seconds, count(*) AS sessions FROM fact_sessions s
          LEFT JOIN dim_customer c ON s.customer_key = c.customer_key GROUP BY 1""")
def watch_by_country(p):
    return reports.watch_by(p.fact_sessions, p.dim_customer, "customer_key", "country")


@query("r9_watch_by_device_type", "device_type:s watch_seconds:i sessions:i",
       """SELECT device_type, sum(watch_duration_seconds) AS watch_seconds, count(*) AS sessions FROM fact_sessions s
          LEFT JOIN dim_device d ON s.device_key = d.device_key GROUP BY 1""")
def watch_by_device_type(p):
    return reports.watch_by(p.fact_sessions, p.dim_device, "device_key", "device_type")


@query("r10_bitrate_by_platform", "platform:s events:i avg_kbps:d p50_kbps:d p90_kbps:d",
       """SELECT platform, count(*) AS events, avg(bitrate_kbps) AS avg_kbps, quantile_cont(bitrate_kbps, 0.5)
          AS p50_kbps, quantile_cont(bitrate_kbps, 0.9) AS p90_kbps FROM fact_events e JOIN dim_device d
          ON e.device_key = d.device_key GROUP BY 1""")
def bitrate_by_platform(p):
    p = p.stored("fact_events")
    return reports.bitrate_by_platform(p.fact_events, p.dim_device)


@query("r11_premiere_lift", "friday_sessions:d other_sessions:d friday_watch_seconds:d other_watch_seconds:d "
       "sessions_lift:d watch_lift:d",
       """SELECT *, friday_sessions / other_sessions AS sessions_lift,
          friday_watch_seconds / other_watch_seconds AS watch_lift FROM (
          SELECT avg(s) FILTER (WHERE f) AS friday_sessions, avg(s) FILTER (WHERE NOT f) AS other_sessions,
          avg(w) FILTER (WHERE f) AS friday_watch_seconds, avg(w) FILTER (WHERE NOT f) AS other_watch_seconds
          FROM (SELECT isodow(engagement_date) = 5 AS f, sum(sessions_count) AS s, sum(total_watch_seconds) AS w
                FROM fact_daily GROUP BY engagement_date))""")
def premiere_lift(p):
    return reports.premiere_lift(p.fact_daily, p.dim_date)


@query("r12_counts_by_type", "event_type:s n:i", "SELECT event_type, count(*) AS n FROM raw GROUP BY 1")
def counts_by_type(p):
    return reports.counts_by_type(p.raw)


@query("r13_daily_totals", "engagement_date:s sessions_count:i total_watch_seconds:i",
       """SELECT engagement_date, sum(sessions_count) AS sessions_count,
          sum(total_watch_seconds) AS total_watch_seconds FROM content_mart GROUP BY 1""")
def daily_totals(p):
    return reports.daily_totals(p.content_mart)


@query("r14_peak_concurrency", "day:s peak_sessions:i",
       """WITH s AS (SELECT epoch_us(session_start_ts) // 1000000 AS a, epoch_us(session_end_ts) // 1000000 AS z
                     FROM fact_sessions),
          d AS (SELECT unnest(generate_series(min(a) // 86400, max(z) // 86400)) AS n FROM s),
          t AS (SELECT n * 86400 AS t FROM d UNION SELECT a FROM s),
          o AS (SELECT t, count(a) AS open FROM t LEFT JOIN s ON a <= t AND z >= t GROUP BY 1)
          SELECT CAST(to_timestamp(t // 86400 * 86400) AT TIME ZONE 'UTC' AS DATE) AS day, max(open) AS peak_sessions
          FROM o GROUP BY 1""")
def peak_concurrency(p):
    return reports.peak_concurrency(p.fact_sessions)


@query("r15_agg_user_daily", "engagement_date:s customer_key:i total_watch_seconds:i sessions_count:i "
       "distinct_titles_watched:i",
       """SELECT engagement_date, customer_key, sum(total_watch_seconds) AS total_watch_seconds,
          sum(sessions_count) AS sessions_count, count(DISTINCT title_key) AS distinct_titles_watched
          FROM fact_daily GROUP BY 1, 2""")
def agg_user_daily(p):
    return reports.agg_user_daily(p.fact_daily)


@query("r15_agg_country_daily", "engagement_date:s country:s total_watch_seconds:i unique_users:i",
       """SELECT engagement_date, country, sum(total_watch_seconds) AS total_watch_seconds,
          count(DISTINCT f.customer_key) AS unique_users FROM fact_daily f LEFT JOIN dim_customer c
          ON f.customer_key = c.customer_key GROUP BY 1, 2""")
def agg_country_daily(p):
    return reports.agg_country_daily(p.fact_daily, p.dim_customer)


@query("r16_title_reach", "week:s title_key:i distinct_viewers:i",
       """SELECT CAST(date_trunc('week', engagement_date) AS DATE) AS week, title_key, count(DISTINCT customer_key)
          AS distinct_viewers FROM fact_daily GROUP BY 1, 2""")
def title_reach(p):
    return reports.title_reach(p.fact_daily)
