"""Aggregation, window, sort and reshaping patterns over the event, order and line-item tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.bind import K, Playback
from viewtide.catalog.registry import query
from viewtide.functions.scalars import any_event, count_where, decile, exact_ratio, first_known, value_at_last
from viewtide.operators import aggregates as agg
from viewtide.operators import keys, windows
from viewtide.operators.joins import enrich

ORDER = ["event_time", "event_id"]


def ev(p: Playback) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return p.events.select(
        "event_id", ts.alias("event_time"), F.to_date(ts).alias("day"), "user_id", "event_type", "value", "props",
        F.expr(K).alias("k"),
        F.floor(F.col("value") * 10).alias("watch_seconds"))


def titles(p: Playback) -> DataFrame:
    return p.table("part").select(F.col("p_partkey").alias("k"), F.col("p_type").alias("genre"),
                                  F.col("p_size").alias("runtime_min"), "p_name")


def watched(p: Playback) -> DataFrame:
    return enrich(ev(p), titles(p), "k", ["genre", "runtime_min"])


@query("a1_group_stats", "genre:s sum_watch_seconds:i avg_watch_seconds:d n:i min_watch_seconds:i max_watch_seconds:i",
       """SELECT genre, sum(watch_seconds) AS sum_watch_seconds, avg(watch_seconds) AS avg_watch_seconds,
          count(*) AS n, min(watch_seconds) AS min_watch_seconds, max(watch_seconds) AS max_watch_seconds
          FROM ev JOIN titles USING (k) GROUP BY genre""")
def group_stats(p):
    return agg.group_stats(watched(p), ["genre"], "watch_seconds")


@query("a2_distinct_count", "event_type:s distinct_user_id:i",
       "SELECT event_type, count(DISTINCT user_id) AS distinct_user_id FROM events GROUP BY 1")
def distinct_count(p):
    return agg.distinct_count(p.events, ["event_type"], "user_id")


@query("a3_count_where", "l_returnflag:s big:i cheap:i n:i",
       """SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS big,
          count(*) FILTER (WHERE l_discount >= 0.05) AS cheap, count(*) AS n FROM lineitem GROUP BY 1""")
def count_if(p):
    return p.table("lineitem").groupBy("l_returnflag").agg(
        count_where(F.col("l_quantity") > 25).alias("big"), count_where(F.col("l_discount") >= 0.05).alias("cheap"),
        F.count(F.lit(1)).alias("n"))


@query("a4_first_known", "user_id:i first_k:i",
       """SELECT user_id, arg_min(k, event_time) FILTER (WHERE value > 2) AS first_k FROM ev GROUP BY 1""")
def first_non_null(p):
    rows = ev(p).withColumn("known", F.when(F.col("value") > 2, F.col("k")))
    return rows.groupBy("user_id").agg(first_known("known", ORDER).alias("first_k"))


@query("a5_any_event", "user_id:i bought:s",
       "SELECT user_id, bool_or(event_type = 'purchase') AS bought FROM events GROUP BY 1")
def any_purchase(p):
    return p.events.groupBy("user_id").agg(any_event("event_type", "purchase").alias("bought"))


@query("a6_having", "p_type:s n:i", "SELECT p_type, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 2")
def having(p):
    return agg.groups_over(p.table("part"), ["p_type"], 2)


@query("a7_percentiles", "genre:s p50:d p90:d",
       """SELECT genre, quantile_cont(watch_seconds, 0.5) AS p50, quantile_cont(watch_seconds, 0.9) AS p90
          FROM ev JOIN titles USING (k) GROUP BY 1""")
def percentiles(p):
    return agg.percentiles(watched(p), ["genre"], "watch_seconds", {"p50": 0.5, "p90": 0.9})


@query("a7_percentiles_lineitem", "l_returnflag:s p50:d p90:d",
       """SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS p50, quantile_cont(l_extendedprice, 0.9) AS p90
          FROM lineitem GROUP BY 1""")
def percentiles_lineitem(p):
    return agg.percentiles(p.table("lineitem"), ["l_returnflag"], "l_extendedprice", {"p50": 0.5, "p90": 0.9})


@query("a8_approx_percentiles", "genre:s p50:d p95:d p99:d",
       """SELECT genre, quantile_disc(watch_seconds, 0.5) AS p50, quantile_disc(watch_seconds, 0.95) AS p95,
          quantile_disc(watch_seconds, 0.99) AS p99 FROM ev JOIN titles USING (k) GROUP BY 1""")
def approx_percentiles(p):
    return agg.approx_percentiles(watched(p), ["genre"], "watch_seconds", {"p50": 0.5, "p95": 0.95, "p99": 0.99},
                                  accuracy=100_000)


@query("a9_value_at_last", "user_id:i last_type:s",
       "SELECT user_id, arg_max(event_type, ts) AS last_type FROM events GROUP BY 1")
def argmax(p):
    return ev(p).groupBy("user_id").agg(value_at_last("event_type", ORDER).alias("last_type"))


@query("a10_compare_counts", "orders:i lines:i",
       "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS lines")
def compare_counts(p):
    return agg.compare_counts(p.table("orders"), p.table("lineitem"), "orders", "lines")


@query("a11_rollup_days", "engagement_date:s sessions_count:i total_watch_seconds:i",
       """SELECT engagement_date, sum(sessions_count) AS sessions_count, sum(total_watch_seconds) AS total_watch_seconds
          FROM content_mart GROUP BY 1""")
def rollup_days(p):
    return agg.rollup_days(p.content_mart, "engagement_date", ["sessions_count", "total_watch_seconds"])


@query("a12_deciles", "l_returnflag:s bucket:i n:i",
       """SELECT l_returnflag, least(CAST(l_linenumber AS BIGINT) * 10 // 7, 9) AS bucket, count(*) AS n
          FROM lineitem GROUP BY 1, 2""")
def deciles(p):
    share = F.col("l_linenumber").cast("decimal(10,0)") / F.lit(7)
    exact = F.floor(F.col("l_linenumber") * 10 / 7)
    rows = p.table("lineitem").withColumn("bucket", F.when(share >= 1, decile(share)).otherwise(exact))
    return rows.groupBy("l_returnflag", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query("a13_threshold_funnel", "step:s n_sessions:i",
       """WITH m AS (SELECT user_id, k, max(least(value * 10 / (runtime_min * 60.0), 1.0)) AS pct
                     FROM ev JOIN titles USING (k) GROUP BY 1, 2)
          SELECT 'started' AS step, count(*) FILTER (WHERE pct > 0) AS n_sessions FROM m
          UNION ALL SELECT 'p25', count(*) FILTER (WHERE pct >= 0.25) FROM m
          UNION ALL SELECT 'p50', count(*) FILTER (WHERE pct >= 0.5) FROM m
          UNION ALL SELECT 'p100', count(*) FILTER (WHERE pct >= 1.0) FROM m""")
def threshold_funnel(p):
    pct = F.when(F.col("runtime_min") > 0, F.least(F.col("value") * 10 / (F.col("runtime_min") * 60.0), F.lit(1.0)))
    best = watched(p).groupBy("user_id", "k").agg(F.max(pct).alias("pct"))
    steps = {"started": (">", 0.0), "p25": (">=", 0.25), "p50": (">=", 0.5), "p100": (">=", 1.0)}
    return agg.threshold_funnel(best, "pct", steps, "n_sessions")


def _with_nulls(p: Playback) -> DataFrame:
    return p.events.select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"))


@query("a14_null_counts", "col_name:s null_count:i",
       """SELECT 'user_id' AS col_name, count(*) FILTER (WHERE event_id % 7 = 0) AS null_count FROM events
          UNION ALL SELECT 'event_type', count(*) FILTER (WHERE event_id % 11 = 0) FROM events
          UNION ALL SELECT 'value', count(*) FILTER (WHERE event_id % 13 = 0) FROM events""")
def null_counts(p):
    return agg.null_counts(_with_nulls(p), ["user_id", "event_type", "value"])


@query("q33_null_flags", "event_id:i has_null:s",
       "SELECT event_id, event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 AS has_null FROM events")
def null_flags(p):
    return agg.null_flags(_with_nulls(p), ["user_id", "event_type", "value"])


TYPES = ("signup", "purchase", "view", "click", "error")


@query("a15_pivot", "day:s signup:i purchase:i view:i click:i error:i",
       "SELECT day, " + ", ".join(f"sum(watch_seconds) FILTER (WHERE event_type = '{t}') AS {t}" for t in TYPES)
       + " FROM ev GROUP BY 1")
def pivot(p):
    return agg.pivot_sum(ev(p), "day", "event_type", "watch_seconds", TYPES)


@query("a16_unpivot", "user_id:i event_type:s watch_seconds:i",
       "SELECT user_id, event_type, sum(watch_seconds) AS watch_seconds FROM ev GROUP BY 1, 2")
def unpivot(p):
    wide = agg.pivot_sum(ev(p), "user_id", "event_type", "watch_seconds", TYPES)
    return agg.unpivot_nonnull(wide, ["user_id"], list(TYPES), "event_type", "watch_seconds")


@query("a17_distinct", "user_id:i event_type:s", "SELECT DISTINCT user_id, event_type FROM events")
def distinct(p):
    return agg.distinct_rows(p.events, ["user_id", "event_type"])


@query("w1_latest_per_key", "user_id:i event_id:i event_type:s",
       """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id
          ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest(p):
    return windows.latest_per_key(ev(p), ["user_id"], ORDER)


@query("w2_rank_all", "event_id:i watch_seconds:i rank:i dense_rank:i",
       """SELECT event_id, watch_seconds, rank() OVER (ORDER BY watch_seconds DESC) AS rank,
          dense_rank() OVER (ORDER BY watch_seconds DESC) AS dense_rank FROM ev""")
def ranks(p):
    return keys.rank_all(ev(p), "watch_seconds")


@query("w3_lead", "event_id:i next_event_type:s",
       "SELECT event_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_event_type "
       "FROM events")
def lead(p):
    return windows.next_value(ev(p), ["user_id"], ORDER, "event_type", "next_event_type")


@query("w4_lag_seconds", "event_id:i seconds_since_prev:d",
       """SELECT event_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)))
          / 1000000.0 AS seconds_since_prev FROM events""")
def lag(p):
    return windows.seconds_since_prev(ev(p), ["user_id"], ORDER, "event_time")


@query("w5_running_sum", "event_id:i cumulative_watch:i",
       """SELECT event_id, sum(watch_seconds) OVER (PARTITION BY user_id ORDER BY event_time, event_id
          ROWS UNBOUNDED PRECEDING) AS cumulative_watch FROM ev""")
def running_sum(p):
    return windows.running_total(ev(p), ["user_id"], ORDER, "watch_seconds", "cumulative_watch")


@query("w6_moving_avg", "user_id:i day:s watch_min:d rolling_avg_3:d",
       """SELECT user_id, day, watch_min, avg(watch_min) OVER (PARTITION BY user_id ORDER BY day
          ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_avg_3
          FROM (SELECT user_id, day, round(sum(watch_seconds) / 60.0, 2) AS watch_min FROM ev GROUP BY 1, 2)""")
def moving_avg(p):
    daily = ev(p).groupBy("user_id", "day").agg(F.round(F.sum("watch_seconds") / F.lit(60.0).cast("double"), 2)
                                                .alias("watch_min"))
    return windows.moving_avg(daily, ["user_id"], ["day"], "watch_min", 3, "rolling_avg_3")


@query("w7_running_max", "event_id:i max_watch_so_far:i",
       """SELECT event_id, max(watch_seconds) OVER (PARTITION BY user_id ORDER BY event_time, event_id
          ROWS UNBOUNDED PRECEDING) AS max_watch_so_far FROM ev""")
def running_max(p):
    return windows.running_maximum(ev(p), ["user_id"], ORDER, "watch_seconds", "max_watch_so_far")


@query("w8_pct_of_group", "user_id:i k:i watch_seconds:i user_total:i pct:d",
       """SELECT *, watch_seconds / user_total AS pct FROM (SELECT user_id, k, CAST(sum(watch_seconds) AS DOUBLE)
          AS watch_seconds, CAST(sum(sum(watch_seconds)) OVER (PARTITION BY user_id) AS DOUBLE) AS user_total
          FROM ev GROUP BY 1, 2)""")
def pct_of_group(p):
    rows = ev(p).groupBy("user_id", "k").agg(F.sum("watch_seconds").alias("watch_seconds"))
    return windows.pct_of_group(rows, ["user_id"], "watch_seconds", "user_total", "pct")


@query("w9_first_last", "user_id:i k:i first_event:s last_event:s",
       """SELECT user_id, k, arg_min(event_type, event_time) AS first_event, arg_max(event_type, event_time)
          AS last_event FROM ev GROUP BY 1, 2""")
def first_last(p):
    return windows.first_last(ev(p), ["user_id", "k"], ORDER, "event_type", "first_event", "last_event")


@query("w10_top_n", "genre:s k:i watch_seconds:i",
       """SELECT genre, k, watch_seconds FROM (SELECT genre, k, watch_seconds, row_number() OVER
          (PARTITION BY genre ORDER BY watch_seconds DESC, k) AS rn FROM (SELECT genre, k, sum(watch_seconds)
          AS watch_seconds FROM ev JOIN titles USING (k) GROUP BY 1, 2)) WHERE rn <= 2""")
def top_n(p):
    by_title = ev(p).groupBy("k").agg(F.sum("watch_seconds").alias("watch_seconds"))
    return windows.top_n(enrich(by_title, titles(p), "k", ["genre"]), ["genre"], "watch_seconds", ["k"], 2)


@query("w11_group_mean_flag", "event_id:i genre_avg:d above_avg:s",
       """SELECT event_id, avg(watch_seconds) OVER (PARTITION BY genre) AS genre_avg,
          watch_seconds > avg(watch_seconds) OVER (PARTITION BY genre) AS above_avg FROM ev JOIN titles USING (k)""")
def group_mean(p):
    return windows.group_mean_flag(watched(p), ["genre"], "watch_seconds", "genre_avg", "above_avg")


@query("w12_sessionize", "event_id:i session_num:i",
       """SELECT event_id, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
          AS session_num FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE
          THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""")
def sessionize(p):
    return windows.sessionize(ev(p), ["user_id"], ORDER, "event_time")


@query("w13_dedup_latest", "user_id:i k:i event_id:i",
       """SELECT user_id, k, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, k
          ORDER BY event_time DESC) AS rn FROM ev) WHERE rn = 1""")
def dedup_latest(p):
    return windows.dedup_latest(ev(p).drop("props"), ["user_id", "k"], "event_time")


@query("w14_day_over_day", "day:s dau:i prev_dau:i delta:i pct_change:d",
       """SELECT day, dau, prev AS prev_dau, dau - prev AS delta, (dau - prev) / CAST(prev AS DOUBLE) AS pct_change
          FROM (SELECT day, dau, lag(dau) OVER (ORDER BY day) AS prev
                FROM (SELECT day, count(DISTINCT user_id) AS dau FROM ev GROUP BY 1))""")
def day_over_day(p):
    dau = ev(p).groupBy("day").agg(F.countDistinct("user_id").alias("dau"))
    return windows.day_over_day(dau, "day", "dau")


@query("w15_assign_keys", "p_partkey:i part_key:i",
       "SELECT p_partkey, 100 + row_number() OVER (ORDER BY p_partkey) AS part_key FROM part")
def assign_keys(p):
    return keys.assign_keys(p.table("part").select("p_partkey"), "p_partkey", "part_key", offset=100)


@query("w15_hash_keys", "p_partkey:i part_key:i")
def hash_keys(p):
    return keys.hash_keys(p.table("part").select("p_partkey"), "p_partkey", "part_key")


@query("w15_hash_keys_stable", "n_rows:i n_keys:i n_same:i n_null:i",
       "SELECT count(*) AS n_rows, count(DISTINCT p_partkey) AS n_keys, count(*) AS n_same, 0 AS n_null FROM part")
def hash_keys_stable(p):
    """As many keys as natural keys, none missing, and the same ones when the rows come in another order and partitioning."""
    part = p.table("part").select("p_partkey")
    first = keys.hash_keys(part, "p_partkey", "part_key")
    again = keys.hash_keys(part.repartition(3, F.rand(1)), "p_partkey", "other")
    return first.join(again, "p_partkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("part_key").alias("n_keys"),
        F.count_if(F.col("part_key") == F.col("other")).alias("n_same"), F.count_if(F.col("part_key").isNull()).alias("n_null"))


@query("w16_silent_gaps", "user_id:i day:s last_active:s silent_days:i active_days_before:i",
       """SELECT * FROM (SELECT user_id, day, lag(day) OVER w AS last_active, day - lag(day) OVER w AS silent_days,
          row_number() OVER w - 1 AS active_days_before FROM (SELECT DISTINCT user_id, day FROM ev)
          WINDOW w AS (PARTITION BY user_id ORDER BY day)) WHERE silent_days > 2 AND active_days_before >= 3""")
def silent_gaps(p):
    return windows.silent_gaps(ev(p), "user_id", "day", days=2, sustained=3)


@query("w17_rolling_actives", "day:s actives:i",
       """SELECT d.day, count(DISTINCT user_id) AS actives
          FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM ev
                WHERE user_id IS NOT NULL) d
          LEFT JOIN (SELECT DISTINCT user_id, day FROM ev) a ON a.day <= d.day AND a.day > d.day - 7 GROUP BY 1""")
def rolling_actives(p):
    return windows.rolling_actives(ev(p), "user_id", "day", 7)


@query("w18_watch_deltas", "event_id:i watch_seconds_delta:d",
       """SELECT event_id, CASE WHEN event_type IN ('view', 'signup') AND nxt IS NOT NULL
          THEN (epoch_us(nxt) - epoch_us(event_timestamp)) / 1000000.0 ELSE 0 END AS watch_seconds_delta
          FROM (SELECT *, lead(event_timestamp) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id)
                AS nxt FROM raw)""")
def watch_deltas(p):
    return windows.watch_deltas(p.raw, "session_id", "event_timestamp", "event_id", "event_type", ["view", "signup"])


@query("o1_top_k", "o_orderkey:i o_totalprice:d",
       "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(p):
    return agg.top_k(p.table("orders"), "o_totalprice", ["o_orderkey"], 10)


@query("o2_latest_day", "event_id:i day:s",
       "SELECT event_id, day FROM ev WHERE day = (SELECT max(day) FROM ev)")
def latest_day(p):
    return agg.latest_day(ev(p), "day")


@query("o3_sorted", "o_orderpriority:s o_orderdate:s n:i",
       "SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2")
def sorted_rows(p):
    n = p.table("orders").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("o_orderdate")).agg(
        F.count(F.lit(1)).alias("n"))
    return agg.sorted_rows(n, ["o_orderpriority", "o_orderdate"])


@query("u1_stack_metrics", "metric:s n:i",
       """SELECT 'orders' AS metric, count(*) AS n FROM orders UNION ALL SELECT 'lines', count(*) FROM lineitem
          UNION ALL SELECT 'events', count(*) FROM events""")
def stack_metrics(p):
    names = {"orders": "orders", "lines": "lineitem", "events": "events"}
    return agg.stack_metrics([p.table(t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(m).alias("metric"), "n")
                              for m, t in names.items()])


@query("u2_hot_cold", "day:s event_type:s n:i", "SELECT day, event_type, count(*) AS n FROM ev GROUP BY 1, 2")
def hot_cold(p):
    counts = ev(p).groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return agg.hot_cold(counts, counts, "day", F.lit("2024-01-24").cast("date"))


@query("j12_enrich", "event_id:i genre:s device_type:s",
       """SELECT event_id, genre, CASE (k % 10) % 4 WHEN 0 THEN 'tv' WHEN 1 THEN 'mobile' WHEN 2 THEN 'laptop'
          ELSE 'console' END AS device_type FROM ev JOIN titles USING (k)""")
def enrich_events(p):
    rows = enrich(ev(p), titles(p), "k", ["genre"]).withColumn("device_id", F.concat(F.lit("d"), F.col("k") % 10))
    return enrich(rows, p.registry.select("device_id", "device_type").distinct(), "device_id", ["device_type"])


@query("fn_exact_ratio", "l_suppkey:i late_share:d",
       """SELECT l_suppkey, ((2 * 1000 * count(*) FILTER (WHERE l_returnflag = 'R') + count(*)) // (2 * count(*)))
          / 1000.0 AS late_share FROM lineitem GROUP BY 1""")
def ratio(p):
    n = p.table("lineitem").groupBy("l_suppkey").agg(count_where(F.col("l_returnflag") == "R").alias("r"),
                                                     F.count(F.lit(1)).alias("n"))
    return n.withColumn("late_share", exact_ratio(F.col("r"), F.col("n"), 4, 3))
