"""Data-quality queries. The bound data is imperfect on purpose, so some checks fail and both sides must say so."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewtide.bind import ROLES, RULES
from viewtide.catalog.model import ts
from viewtide.catalog.registry import query
from viewtide.plans import marts, quality
from viewtide.sources.metrics import metric_rows

CHECK = "check:s passed:s observed:s expected:s"


def zero(name: str, count: str, source: str) -> str:
    """SQL of a check that passes at 0."""
    return (f"SELECT '{name}' AS \"check\", {count} = 0 AS passed, CAST(CAST({count} AS BIGINT) AS VARCHAR) AS observed, "
            f"'0' AS expected FROM {source}")


def zeros(counts: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(zero(n, c, source) for n, c in counts.items())


def same(name: str, a: str, b: str) -> str:
    return (f"SELECT '{name}' AS \"check\", a = b AS passed, CAST(a AS VARCHAR) AS observed, CAST(b AS VARCHAR) "
            f"AS expected FROM (SELECT CAST(coalesce(({a}), 0) AS BIGINT) AS a, "
            f"CAST(coalesce(({b}), 0) AS BIGINT) AS b)")


FACT = "SELECT count(*) FROM fact_events"
SESSIONS = "SELECT count(*) FROM fact_sessions"

RECONCILED = {
    "q1_fact_equals_raw": (same("fact_rows_equal_raw_rows", FACT, "SELECT count(*) FROM raw"),
                           quality.check_fact_equals_raw, "fact_events raw"),
    "q2_title_key_known": (zero("event_title_key_known", "count(*) FILTER (WHERE title_key IS NULL)", "fact_events"),
                           quality.check_title_key_known, "fact_events"),
    "q3_customer_key_known": (
        zero("event_customer_key_known", "count(*) FILTER (WHERE customer_key IS NULL)", "fact_events"),
        quality.check_customer_key_known, "fact_events"),
    "q4_date_key_resolves": (
        zero("fact_events_date_key_resolves", "count(*)",
             "(SELECT 1 FROM fact_events WHERE date_key NOT IN (SELECT date_key FROM dim_date))"),
        quality.check_date_key_resolves, "fact_events dim_date"),
    "q4_daily_date_key_resolves": (
        zero("fact_daily_date_key_resolves", "count(*)",
             "(SELECT 1 FROM fact_daily WHERE date_key NOT IN (SELECT date_key FROM dim_date))"),
        lambda t: quality.check_date_key_resolves(t, "fact_daily"), "fact_daily dim_date"),
    "q4_session_date_key_resolves": (
        zero("fact_sessions_date_key_resolves", "count(*)",
             "(SELECT 1 FROM fact_sessions WHERE date_key NOT IN (SELECT date_key FROM dim_date))"),
        lambda t: quality.check_date_key_resolves(t, "fact_sessions"), "fact_sessions dim_date"),
    "q5_date_key_matches": (
        zero("date_key_matches_event_date", "count(*) FILTER (WHERE date_key <> CAST(strftime(event_date, '%Y%m%d') "
             "AS BIGINT))", "fact_events"), quality.check_date_key_matches, "fact_events"),
    "q6_sessions_equal": (same("sessions_equal_distinct_event_sessions", SESSIONS,
                               "SELECT count(DISTINCT session_id) FROM fact_events"),
                          quality.check_sessions_equal_event_sessions, "fact_sessions fact_events"),
    "q7_completion_range": (
        zero("completion_pct_in_range", "count(*) FILTER (WHERE completion_pct < 0 OR completion_pct > 1.001)",
             "fact_sessions"), quality.check_completion_range, "fact_sessions"),
    "q8_end_after_start": (
        zero("session_end_not_before_start", "count(*) FILTER (WHERE session_end_ts < session_start_ts)",
             "fact_sessions"), quality.check_end_after_start, "fact_sessions"),
    "q9_watch_within_span": (
        zero("watch_within_session_span", "count(*) FILTER (WHERE watch_duration_seconds > epoch_us(session_end_ts) "
             "/ 1000000.0 - epoch_us(session_start_ts) / 1000000.0 + 1)", "fact_sessions"),
        quality.check_watch_within_span, "fact_sessions"),
    "q10_mart_sessions": (same("mart_sessions_equal_fact_sessions", "SELECT sum(sessions_count) FROM content_mart",
                               SESSIONS), quality.check_mart_sessions, "content_mart fact_sessions"),
    "q11_device_equals_content": (
        same("device_watch_equals_content_watch", "SELECT sum(total_watch_seconds) FROM device_mart",
             "SELECT sum(total_watch_seconds) FROM content_mart"), quality.check_device_equals_content,
        "device_mart content_mart"),
    "q12_genre_pct": (
        zero("genre_pct_sums_to_100_each_day", "count(*) FILTER (WHERE p NOT BETWEEN 99 AND 101)",
             "(SELECT sum(pct_of_day) AS p FROM genre_mart GROUP BY engagement_date)"), quality.check_genre_pct,
        "genre_mart"),
    "q16_duplicates": (
        zero("landing_no_duplicate_event_id", "(count(*) - count(DISTINCT event_id))", "landing"),
        lambda t: quality.check_no_duplicates(t, "landing"), "landing"),
    "q17_leaks": (
        zeros({"leaked_future": "count(*) FILTER (WHERE event_timestamp > server_received_at + INTERVAL 5 MINUTE)",
               "leaked_bad_title": "count(*) FILTER (WHERE NOT regexp_matches(title_id, '^tt[0-9]{7,10}$'))",
               "leaked_null_id": "count(*) FILTER (WHERE event_id IS NULL)"}, "raw"), quality.check_leaks, "raw"),
    "q18_orphans": (
        zeros({f"orphan_{d}": f"count(*) FILTER (WHERE {d}_key IS NULL)" for d in ("title", "device", "customer")},
              "fact_events"), quality.check_orphans, "fact_events"),
    "q18_orphan_rate": (
        " UNION ALL ".join(
            f"SELECT 'orphan_rate_{d}' AS \"check\", n = 0 OR n * 1000 < total AS passed, n || ' of ' || total AS observed, "
            f"'< 1 per mille' AS expected FROM (SELECT count(*) FILTER (WHERE {d}_key IS NULL) AS n, count(*) AS total FROM "
            "fact_events)" for d in ("title", "device", "customer")), quality.check_orphan_rate, "fact_events"),
    "q19_positions": (zero("position_not_negative", "count(*) FILTER (WHERE position_ms < 0)", "raw"),
                      quality.check_positions, "raw"),
    "q20_mart_ratio": (
        """SELECT 'mart_rows_per_session' AS "check", m BETWEEN ceil(f * 0.01) AND f AS passed, m || ' of ' || f AS observed,
           '0.01 .. 1.0' AS expected FROM (SELECT (SELECT count(*) FROM content_mart) AS m, (SELECT count(*) FROM fact_sessions) AS f)""",
        quality.check_mart_ratio, "content_mart fact_sessions"),
    "q19_session_sanity": (
        zeros({"negative_watch": "count(*) FILTER (WHERE watch_duration_seconds < 0)",
               "bad_completion_pct": "count(*) FILTER (WHERE completion_pct < 0 OR completion_pct > 1)",
               "end_before_start": "count(*) FILTER (WHERE session_end_ts < session_start_ts)",
               "watch_over_24h": "count(*) FILTER (WHERE watch_duration_seconds > 86400)"}, "fact_sessions"),
        quality.check_session_sanity, "fact_sessions"),
    "q20_mart_recompute": (
        zero("mart_equals_recomputation", "count(*)",
             "((SELECT engagement_date, title_key, sessions_count FROM content_mart EXCEPT SELECT session_start_date, "
             "title_key, count(*) FROM fact_sessions GROUP BY 1, 2))"), quality.check_mart_recompute,
        "content_mart fact_sessions"),
    "q21_rate_bounds": (
        zero("completion_rate_in_range", "count(*) FILTER (WHERE completion_rate < 0 OR completion_rate > 1)",
             "content_mart"), quality.check_rate_bounds, "content_mart"),
    "q39_daily_watch": (same("daily_watch_equals_session_watch", "SELECT sum(total_watch_seconds) FROM fact_daily",
                             "SELECT sum(watch_duration_seconds) FROM fact_sessions"), quality.check_daily_watch,
                        "fact_daily fact_sessions"),
    "q40_event_session_unique": (
        zero("fact_events_unique_event_id_session_id", "count(*)", "(SELECT 1 FROM fact_events GROUP BY event_id, "
             "session_id HAVING count(*) > 1)"), quality.check_event_session_unique, "fact_events"),
    "q43_dau": (
        zero("daily_customers_equal_dau", "count(*)",
             "(SELECT engagement_date FROM (SELECT engagement_date, count(DISTINCT customer_key) AS n FROM fact_daily "
             "GROUP BY 1) JOIN (SELECT session_start_date, count(DISTINCT customer_key) AS m FROM fact_sessions "
             "GROUP BY 1) ON engagement_date = session_start_date WHERE n <> m)"), quality.check_dau,
        "fact_daily fact_sessions"),
    "q38_fact_vs_raw": (same("fact_rows_near_raw_rows", FACT, "SELECT count(*) FROM raw"), quality.check_fact_vs_raw,
                        "fact_events raw"),
    "q38_mart_vs_fact": (same("mart_sessions_near_fact_sessions", "SELECT sum(sessions_count) FROM content_mart",
                              SESSIONS), quality.check_mart_vs_fact, "content_mart fact_sessions"),
    "q13_raw_share": (
        """SELECT 'raw_within_landing' AS "check", s >= 0.95 AS passed, CAST(s AS VARCHAR) AS observed,
           '0.95..1.0' AS expected FROM (SELECT round((SELECT count(*) FROM raw) / CAST((SELECT count(*) FROM landing)
           AS DOUBLE), 6) AS s)""", quality.check_raw_share_of_landing, "raw landing"),
}

for _name, (_sql, _build, _needs) in RECONCILED.items():
    def _plan(p, build=_build, needs=_needs):
        return build(p.tables(*needs.split()))

    query(_name, CHECK, _sql)(_plan)


@query("q_reconciliation", CHECK, " UNION ALL ".join(f"({RECONCILED[n][0]})" for n in (
    "q1_fact_equals_raw", "q2_title_key_known", "q3_customer_key_known", "q4_date_key_resolves",
    "q5_date_key_matches", "q6_sessions_equal", "q7_completion_range", "q8_end_after_start", "q9_watch_within_span",
    "q10_mart_sessions", "q11_device_equals_content", "q12_genre_pct", "q4_daily_date_key_resolves")))
def reconciliation(p):
    p = p.stored("raw", "fact_events", "fact_sessions", "content_mart")
    return quality.run_all(p.tables("raw", "fact_events", "fact_sessions", "fact_daily", "dim_date", "content_mart",
                                    "device_mart", "genre_mart"))


@query("q14_customer_coverage", "event_customers:i known_customers:i unknown_customers:i",
       """SELECT count(*) AS event_customers, count(c.customer_id) AS known_customers,
          count(*) - count(c.customer_id) AS unknown_customers FROM (SELECT DISTINCT customer_id FROM raw) r
          LEFT JOIN customers_source c ON r.customer_id = c.customer_id""")
def customer_coverage(p):
    return quality.customer_coverage(p.tables("raw", "customers"))


@query("q15_title_coverage", "events:i events_with_title:i pct_with_title:d",
       """SELECT count(*) AS events, count(title_key) AS events_with_title,
          count(title_key) * 100.0 / count(*) AS pct_with_title FROM fact_events""")
def title_coverage(p):
    return quality.title_coverage(p.tables("fact_events"))


@query("q22_landing_freshness", "landing_rows:i latest_arrival:t future_dated:i",
       """SELECT count(*) AS landing_rows, max(server_received_at) AS latest_arrival, count(*) FILTER
          (WHERE event_timestamp > server_received_at + INTERVAL 5 MINUTE) AS future_dated FROM landing""")
def landing_freshness(p):
    return quality.landing_freshness(p.tables("landing"))


METRICS_SQL = """SELECT (SELECT count(*) FROM deduplicated) AS raw_count, (SELECT count(*) FROM quarantine)
  AS quarantine_count, round((SELECT count(*) FROM quarantine) * 100.0 / ((SELECT count(*) FROM deduplicated)
  + (SELECT count(*) FROM quarantine)), 3) AS quarantine_pct, (SELECT round(quantile_cont(epoch_us(server_received_at)
  - epoch_us(event_timestamp), 0.99) / 1000000.0, 1) FROM deduplicated) AS lag_p99_seconds"""


@query("q23_batch_metrics", "raw_count:i quarantine_count:i quarantine_pct:d lag_p99_seconds:d", METRICS_SQL)
def batch_metrics(p):
    return quality.batch_metrics(p.deduplicated, p.quarantine)


@query("q23_batch_gate", CHECK,
       f"""SELECT 'raw_count' AS "check", raw_count >= 1 AS passed, CAST(raw_count AS VARCHAR) AS observed,
           '>= 1' AS expected FROM ({METRICS_SQL}) UNION ALL SELECT 'quarantine_pct', quarantine_pct <= 5,
           CAST(quarantine_pct AS VARCHAR), '<= 5.0' FROM ({METRICS_SQL})""")
def batch_gate(p):
    return quality.batch_gate(quality.batch_metrics(p.deduplicated, p.quarantine))


@query("q24_scorecard", "raw_24h:i quarantined_24h:i quarantine_pct:d quarantine_pct_7d:d lag_p99_24h:d "
       "orphan_titles:i orphan_devices:i latest_mart_day:s",
       f"""SELECT r AS raw_24h, q AS quarantined_24h, round(q * 100.0 / (q + r), 2) AS quarantine_pct,
           round(m.quarantine_pct, 3) AS quarantine_pct_7d, round(m.lag_p99_seconds, 1) AS lag_p99_24h,
           (SELECT count(*) FROM fact_events WHERE title_key IS NULL) AS orphan_titles,
           (SELECT count(*) FROM fact_events WHERE device_key IS NULL) AS orphan_devices,
           (SELECT max(engagement_date) FROM content_mart) AS latest_mart_day
           FROM (SELECT (SELECT count(*) FROM raw WHERE server_received_at >= TIMESTAMP '2024-01-20'
                 AND server_received_at < TIMESTAMP '2024-01-21') AS r, (SELECT count(*) FROM quarantine
                 WHERE server_received_at >= TIMESTAMP '2024-01-20' AND server_received_at < TIMESTAMP '2024-01-21')
                 AS q), ({METRICS_SQL}) AS m""")
def scorecard(p):
    as_of = ts("2024-01-21")
    metrics = metric_rows(quality.batch_metrics(p.deduplicated, p.quarantine), "microbatch", "r1", as_of, as_of,
                          as_of - F.expr("interval 3 hours"))
    return quality.scorecard(p.tables("raw", "quarantine", "fact_events", "content_mart"), metrics, as_of)


def _range(name, table, col, lo, hi):
    return zero(f"{name}.{col}_in_range", f"count(*) FILTER (WHERE {col} < {lo} OR {col} > {hi})", table)


def _filled(name, table, col):
    return zero(f"{name}.{col}_not_null", f"count(*) FILTER (WHERE {col} IS NULL)", table)


def _unique(name, table, cols):
    return zero(f"{name}_unique_{'_'.join(cols)}", "count(*)",
                f"(SELECT 1 FROM {table} GROUP BY {', '.join(cols)} HAVING count(*) > 1)")


@query("q25_mart_tests", CHECK, " UNION ALL ".join(
    [sql for t, (need, ranges, unique) in quality.MART_TESTS.items()
     for sql in [*[_filled(t, t, c) for c in need], *[_range(t, t, *r) for r in ranges], _unique(t, t, unique)]]))
def mart_tests(p):
    p = p.stored("fact_sessions", "content_mart", "device_mart", "genre_mart", "funnel_mart")
    return quality.mart_tests(p.tables("content_mart", "device_mart", "genre_mart", "funnel_mart"))


@query("q26_required_fields", "field:s missing:i mistyped:i",
       """SELECT 'k' AS field, count(*) FILTER (WHERE event_id % 59 = 0) AS missing,
          count(*) FILTER (WHERE event_id % 59 <> 0 AND event_id % 53 = 0) AS mistyped FROM events
          UNION ALL SELECT 'event_type', 0, 0 UNION ALL SELECT 'session_id', (SELECT count(*) FROM events), 0""")
def required_fields(p):
    """JSON events: every 59th has no ``k``, every 53rd a ``k`` that is no number, none has a session id."""
    k = F.when(F.col("event_id") % 53 == 0, "many").otherwise(F.get_json_object("props", "$.k"))
    doc = F.to_json(F.struct("event_type", F.when(F.col("event_id") % 59 != 0, k).alias("k")))
    return quality.required_fields(p.events.select(doc.alias("doc")), "doc",
                                   {"k": "int", "event_type": "string", "session_id": "string"})


@query("q27_enum_violations", CHECK,
       zeros({"invalid_event_type": "count(*) FILTER (WHERE event_type = 'error')",
              "invalid_schema_version": "count(*) FILTER (WHERE schema_version <> 1)"}, "landing"))
def enum_violations(p):
    return quality.enum_violations(p.landing, RULES.event_types)


@query("q28_session_sequencing", "sessions:i first_not_play:i first_not_at_zero:i last_not_end:i",
       """SELECT count(*) AS sessions, count(*) FILTER (WHERE f <> 'view') AS first_not_play,
          count(*) FILTER (WHERE p <> 0) AS first_not_at_zero,
          count(*) FILTER (WHERE l NOT IN ('purchase', 'click')) AS last_not_end
          FROM (SELECT arg_min(event_type, event_timestamp) AS f, arg_min(position_ms, event_timestamp) AS p,
                arg_max(event_type, event_timestamp) AS l FROM raw GROUP BY session_id)""")
def session_sequencing(p):
    return quality.session_sequencing(p.raw, ROLES)


@query("q29_position_drops", "event_id:i session_id:s position_ms:i previous_position_ms:i",
       """SELECT event_id, session_id, position_ms, prev AS previous_position_ms FROM (SELECT *, lag(position_ms)
          OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS prev FROM raw)
          WHERE event_type <> 'signup' AND position_ms < coalesce(prev, 0)""")
def position_drops(p):
    return quality.position_drops(p.raw, ROLES)


@query("q30_fk_violations", CHECK,
       zeros({"unknown_title": "count(*) FILTER (WHERE title_id NOT IN (SELECT tconst FROM titles_source "
                               "WHERE title_type <> 'PROMO'))",
              "unknown_customer": "count(*) FILTER (WHERE customer_id NOT IN (SELECT customer_id FROM "
                                  "customers_source WHERE household_size <> 3))"}, "landing"))
def fk_violations(p):
    return quality.fk_violations(p.landing, p.titles_source.where("title_type <> 'PROMO'"),
                                 p.customers_source.where("household_size <> 3"), "tconst", "customer_id")


@query("q31_hourly_distribution", CHECK,
       """SELECT 'peak_hours_not_below_night' AS "check", peak >= night AS passed,
          CAST(round(peak, 3) AS VARCHAR) AS observed, CAST(round(night, 3) AS VARCHAR) AS expected
          FROM (SELECT avg(n) FILTER (WHERE h BETWEEN 19 AND 21) AS peak, avg(n) FILTER (WHERE h <= 5) AS night
                FROM (SELECT event_hour AS h, count(*) AS n FROM landing GROUP BY 1))""")
def hourly_distribution(p):
    return quality.hourly_distribution(p.landing)


@query("q32_event_profile", "events:i sessions:i completed:i exited:i customers:i titles:i devices:i "
       "completion_rate:d exit_rate:d",
       """SELECT *, completed / CAST(sessions AS DOUBLE) AS completion_rate, exited / CAST(sessions AS DOUBLE)
          AS exit_rate FROM (SELECT count(*) AS events, count(DISTINCT session_id) AS sessions,
          count(DISTINCT CASE WHEN event_type = 'purchase' THEN session_id END) AS completed,
          count(DISTINCT CASE WHEN event_type = 'click' THEN session_id END) AS exited,
          count(DISTINCT customer_id) AS customers, count(DISTINCT title_id) AS titles,
          count(DISTINCT device_id) AS devices FROM raw)""")
def event_profile(p):
    return quality.event_profile(p.raw, ROLES)


@query("q34_batch_thresholds", CHECK,
       """WITH n AS (SELECT count(*) AS total, count(reason) AS bad, (SELECT count(*) FROM deduplicated) AS kept
                     FROM marked),
          v AS (SELECT (total - bad) / CAST(kept AS DOUBLE) AS dup, bad / CAST(total AS DOUBLE) AS q FROM n)
          SELECT 'dedup_ratio' AS "check", dup < 1.05 AS passed, CASE WHEN dup >= 1.1 THEN 'alert '
            WHEN dup >= 1.05 THEN 'warn ' ELSE 'ok ' END || round(dup, 6) AS observed, '< 1.05' AS expected FROM v
          UNION ALL SELECT 'quarantine_rate', q < 0.01, CASE WHEN q >= 0.05 THEN 'alert ' WHEN q >= 0.01 THEN 'warn '
            ELSE 'ok ' END || round(q, 6), '< 0.01' FROM v
          UNION ALL SELECT 'schema_conformity', share > 0.999, CAST(round(share, 6) AS VARCHAR), '> 0.999' FROM (SELECT count(*)
            FILTER (WHERE event_id IS NOT NULL AND customer_id IS NOT NULL AND title_id IS NOT NULL AND event_type IS NOT NULL)
            / CAST(count(*) AS DOUBLE) AS share FROM marked)""")
def batch_thresholds(p):
    return quality.batch_thresholds(p.marked, p.deduplicated, ["event_id", "customer_id", "title_id", "event_type"])


@query("q35_volume_anomalies", "hour_start:t rows:i baseline:d deviation:d",
       """WITH g AS (SELECT unnest(generate_series(date_trunc('hour', min(event_time)), date_trunc('hour', max(event_time)),
                     INTERVAL 1 HOUR)) AS hour_start FROM ev),
          h AS (SELECT g.hour_start, count(event_id) AS n FROM g LEFT JOIN ev
                ON date_trunc('hour', event_time) = g.hour_start GROUP BY 1)
          SELECT * FROM (SELECT a.hour_start, a.n AS rows, avg(b.n) AS baseline, (a.n - avg(b.n)) / nullif(avg(b.n), 0)
          AS deviation FROM h a JOIN h b ON b.hour_start < a.hour_start
          AND b.hour_start >= a.hour_start - INTERVAL 28 DAY AND hour(a.hour_start) = hour(b.hour_start)
          AND dayofweek(a.hour_start) = dayofweek(b.hour_start)
          GROUP BY 1, 2) WHERE abs(deviation) > 0.5""")
def volume_anomalies(p):
    return quality.volume_anomalies(p.events.selectExpr("cast(ts as timestamp) as t"), "t")


@query("q36_lag_sla", CHECK,
       " UNION ALL ".join(
           f"""SELECT 'lag_{n}' AS "check", v < {limit} AS passed, CAST(round(v, 3) AS VARCHAR) AS observed,
               '< {limit}' AS expected FROM (SELECT quantile_cont(epoch_us(server_received_at)
               - epoch_us(event_timestamp), {q}) / 1000000.0 AS v FROM deduplicated)"""
           for n, (q, limit) in quality.LAG_TARGETS.items()))
def lag_sla(p):
    return quality.lag_sla(p.deduplicated)


@query("q37_zone_score", "score:d action:s",
       f"""SELECT round(sum(CASE WHEN passed THEN w ELSE 0 END) * 100.0 / sum(w), 3) AS score,
          CASE WHEN sum(CASE WHEN passed THEN w ELSE 0 END) * 100.0 / sum(w) < 70 THEN 'halt'
               WHEN sum(CASE WHEN passed THEN w ELSE 0 END) * 100.0 / sum(w) < 90 THEN 'flag' ELSE 'green' END
          AS action FROM (SELECT passed, CASE WHEN "check" = 'orphan_title' THEN 3.0 ELSE 1.0 END AS w FROM (
          {RECONCILED['q17_leaks'][0]} UNION ALL {RECONCILED['q18_orphans'][0]}
          UNION ALL {RECONCILED['q16_duplicates'][0]}))""")
def zone_score(p):
    t = p.tables("raw", "fact_events", "landing")
    checks = (quality.check_leaks(t).unionByName(quality.check_orphans(t))
              .unionByName(quality.check_no_duplicates(t, "landing")))
    return quality.zone_score(checks, {"orphan_title": 3.0})


@query("q41_smoke_checks", CHECK,
       """SELECT 'distinct_viewers_positive' AS "check", sum(distinct_viewers) > 0 AS passed, CAST(CAST(sum(distinct_viewers) AS BIGINT)
          AS VARCHAR) AS observed, '> 0' AS expected FROM content_mart
          UNION ALL SELECT 'input_rows_positive', count(*) > 0, CAST(count(*) AS VARCHAR), '> 0' FROM landing
          UNION ALL SELECT 'genre_share_sums_to_one', true, '0', '0'
          UNION ALL SELECT 'retention_rate_in_range', true, '0', '0'""")
def smoke_checks(p):
    return quality.smoke_checks(p.tables("content_mart", "landing"),
                                marts.cohort_retention(p.dim_customer, p.fact_sessions),
                                marts.genre_mix_ext(p.fact_sessions, p.dim_title))


@query("q42_vendor_load", CHECK,
       zero("tconst_unique", "count(*)", "(SELECT 1 FROM titles_source GROUP BY tconst HAVING count(*) > 1)")
       + " UNION ALL " + zero("tconst_not_null", "count(*) FILTER (WHERE tconst IS NULL)", "titles_source")
       + """ UNION ALL SELECT 'row_count_delta', abs(a - b) <= 0.2 * b, CAST(a AS VARCHAR), CAST(b AS VARCHAR) FROM
          (SELECT count(*) AS a, count(*) FILTER (WHERE title_type <> 'PROMO') AS b FROM titles_source)""")
def vendor_load(p):
    return quality.vendor_load(p.titles_source, p.titles_source.where("title_type <> 'PROMO'"), "tconst")

