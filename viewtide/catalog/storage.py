"""Table sinks: each query writes derived tables to the shared work folder and returns what they hold afterwards."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from viewtide import schema
from viewtide.bind import ROLES, RULES
from viewtide.catalog.model import received_span, ts
from viewtide.catalog.patterns import ev
from viewtide.catalog.registry import query
from viewtide.operators.joins import compare_partitioned, differing_partitions
from viewtide.operators.windows import latest_per_key
from viewtide.plans import dims, facts, marts, quality, raw
from viewtide.session import work_path
from viewtide.sources import metrics, tables


def rows_as(name: str):
    return F.count(F.lit(1)).alias(name)


@query("k1_replace_table", "o_orderkey:i o_totalprice:d", "SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders")
def replace_table(p):
    """Written, then replaced by a version computed from itself."""
    path = work_path(p.spark, "orders")
    tables.replace_table(p.table("orders").select("o_orderkey", "o_totalprice"), path)
    again = tables.read_table(p.spark, path).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    tables.replace_table(again, path)
    return tables.read_table(p.spark, path)


@query("k2_create_then_upsert", "user_id:i event_id:i day:s",
       """SELECT user_id, event_id, day FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time
          DESC, event_id DESC) AS rn FROM ev) WHERE rn = 1""")
def create_then_upsert(p):
    """Latest event per user, fed in two batches by type; rows move between day partitions on the way."""
    path = work_path(p.spark, "latest")
    rows = ev(p).select("user_id", "event_id", "event_time", "day", "event_type")
    for batch in ("event_type in ('view', 'click')", "event_type not in ('view', 'click')"):
        newest = latest_per_key(rows.where(batch), ["user_id"], ["event_time", "event_id"])
        tables.upsert(newest, path, ["user_id"], ["day"], ["event_time", "event_id"])
    return tables.read_table(p.spark, path)


@query("k3_upsert_newest_wins", "event_id:i server_received_at:t position_ms:i",
       "SELECT event_id, server_received_at, position_ms FROM deduplicated")
def upsert_newest_wins(p):
    """The newer copies arrive first; the older ones that follow must not replace them."""
    path = work_path(p.spark, "raw")
    clean, _ = raw.split_quarantine(p.landing, RULES)
    newest = raw.newest_events(clean)
    tables.upsert(newest, path, ["event_id"], ["event_date"], ["server_received_at"])
    originals, _ = raw.split_quarantine(p.as_landing(p.events), RULES)
    tables.upsert(originals, path, ["event_id"], ["event_date"], ["server_received_at"])
    return tables.read_table(p.spark, path, originals.schema)


@query("k3_moved_copies", "event_id:i event_date:s server_received_at:t",
       """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN event_date + CAST(event_id % 5 + 2 AS INTEGER) ELSE event_date END
            AS event_date,
          CASE WHEN event_id % 7 = 0 THEN server_received_at + INTERVAL 10 DAY ELSE server_received_at END AS server_received_at
          FROM deduplicated""")
def moved_copies(p):
    """Newer copies whose event time was corrected by two to six days: each replaces its event in another partition."""
    path = work_path(p.spark, "moved")
    p = p.stored("deduplicated")
    rows = p.deduplicated.select("event_id", "event_date", "server_received_at")
    tables.upsert(rows, path, ["event_id"], ["event_date"], ["server_received_at"])
    moved = rows.where("event_id % 7 = 0").withColumns({
        "event_date": F.expr("date_add(event_date, cast(event_id % 5 + 2 as int))"),
        "server_received_at": F.col("server_received_at") + F.expr("interval 10 days")})
    tables.upsert(moved, path, ["event_id"], ["event_date"], ["server_received_at"])
    return tables.read_table(p.spark, path)


@query("k4_upsert_scd1", "customer_key:i customer_id:s plan_tier:s",
       """WITH old AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id
                       FROM customers_source WHERE household_size <> 2)
          SELECT coalesce(customer_key, (SELECT max(customer_key) FROM old) + row_number() OVER (
                 PARTITION BY customer_key IS NULL ORDER BY s.customer_id)) AS customer_key, s.customer_id, plan_tier
          FROM customers_source s LEFT JOIN old ON s.customer_id = old.customer_id""")
def upsert_scd1(p):
    path = work_path(p.spark, "dim-customer")
    first = p.customers_source.where("household_size <> 2").withColumn("plan_tier", F.lit("unknown"))
    tables.replace_table(dims.build_dim_customer(first), path)
    stored = tables.read_table(p.spark, path)
    tables.replace_table(dims.build_dim_customer(p.customers_source, stored), path)
    return tables.read_table(p.spark, path)


@query("k5_replace_partitions", "day:s event_type:s n:i",
       """SELECT day, event_type, CASE WHEN day = DATE '2024-01-10' THEN 2 ELSE 1 END * count(*) AS n FROM ev
          WHERE day <> DATE '2024-01-11' GROUP BY 1, 2, ev.day""")
def replace_partitions(p):
    """One day doubled, one day replaced by nothing, the others untouched."""
    path = work_path(p.spark, "daily")
    counts = ev(p).groupBy("day", "event_type").agg(rows_as("n"))
    tables.replace_table(counts, path, ["day"])
    doubled = counts.where(F.col("day") == F.lit("2024-01-10").cast("date")).withColumn("n", F.col("n") * 2)
    tables.replace_partitions(doubled, path, "day", [date(2024, 1, 10), date(2024, 1, 11)])
    return tables.read_table(p.spark, path)


@query("k6_append", "event_type:s n:i", "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1")
def append(p):
    path = work_path(p.spark, "log")
    for _ in range(2):
        tables.append(p.events.select("event_id", "event_type"), path)
    return tables.read_table(p.spark, path).groupBy("event_type").agg(rows_as("n"))


@query("k7_build_mart", "engagement_date:s genre:s watch_seconds:i pct_of_day:d", "SELECT * FROM genre_mart")
def build_mart(p):
    """Full build, then one day built again over it."""
    path = work_path(p.spark, "mart")
    p = p.stored("fact_sessions")
    marts.build_mart("genre_mix_daily", p.fact_sessions, {"dim_title": p.dim_title}, path)
    marts.build_mart("genre_mix_daily", p.fact_sessions, {"dim_title": p.dim_title}, path, "2024-01-10")
    return tables.read_table(p.spark, path)


@query("k8_rebuild", "event_date:s n:i", "SELECT event_date, count(*) AS n FROM deduplicated GROUP BY 1")
def rebuild(p):
    path = work_path(p.spark, "rebuild")
    tables.replace_table(p.deduplicated, path, ["event_date"])
    tables.replace_table(p.deduplicated, path, ["event_date"])
    return tables.read_table(p.spark, path).groupBy("event_date").agg(rows_as("n"))


@query("k9_compact", "day:s files:i n:i", "SELECT day, 1 AS files, 3 * count(*) AS n FROM ev GROUP BY 1")
def compact(p):
    """Three appends leave several small files per day; compaction leaves one."""
    path = work_path(p.spark, "small-files")
    for _ in range(3):
        tables.append(ev(p).select("event_id", "day"), path, ["day"])
    tables.compact(p.spark, path, ["day"])
    stored = tables.read_table(p.spark, path).withColumn("file", F.input_file_name())
    return stored.groupBy("day").agg(F.countDistinct("file").alias("files"), rows_as("n"))


@query("k10_target_file_size", "day:s oversized:i split_for_nothing:i n:i",
       "SELECT day, 0 AS oversized, 0 AS split_for_nothing, count(*) AS n FROM ev GROUP BY 1")
def target_file_size(p):
    """Upserted in many tasks: files above the target, and files of a day that the target would hold together."""
    path = work_path(p.spark, "sized")
    rows = ev(p).select("event_id", "day", "props").repartition(16, "event_id")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        tables.upsert(rows.where(part), path, ["event_id"], ["day"], [])
    size = F.col("_metadata.file_size")
    files = tables.read_table(p.spark, path).groupBy("day", F.col("_metadata.file_path").alias("file")).agg(
        F.max(size).alias("size"), rows_as("rows"))
    target = schema.TARGET_FILE_BYTES
    return files.groupBy("day").agg(
        F.count_if(F.col("size") > target).alias("oversized"),
        (rows_as("files") - F.greatest(F.lit(1), F.ceil(F.sum("size") / (target / 8)))).alias("extra"), F.sum("rows").alias("n")
    ).select("day", "oversized", F.greatest("extra", F.lit(0)).alias("split_for_nothing"), "n")


@query("k11_sorted_layout", "event_date:s unsorted:i n:i",
       "SELECT event_date, 0 AS unsorted, count(*) AS n FROM raw GROUP BY 1")
def sorted_layout(p):
    """The raw zone as it is built, in two batches: rows that stand before their predecessor in their file."""
    root = work_path(p.spark, "sorted")
    p = p.stored("raw")
    for part in ("event_id % 3 > 0", "event_id % 3 = 0"):
        raw.store_raw_events(p.raw.where(part), p.quarantine, f"{root}/raw", f"{root}/quarantine", ["event_date"])
    rows = p.spark.read.schema(p.raw.schema).parquet(f"{root}/raw").select(
        "event_date", F.struct(*raw.RAW_SORT).alias("k"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    after = rows.select("file", (F.col("at") + 1).alias("at"), F.col("k").alias("before"))
    pairs = rows.join(after, ["file", "at"], "left")
    return pairs.groupBy("event_date").agg(F.count_if(F.col("before") > F.col("k")).alias("unsorted"), rows_as("n"))


@query("k12_prune", "day:s n:i", "SELECT day, count(*) AS n FROM ev WHERE day >= DATE '2024-01-24' GROUP BY 1")
def prune(p):
    path = work_path(p.spark, "hot")
    tables.replace_table(ev(p).select("event_id", "day"), path, ["day"])
    tables.prune(p.spark, path, "day", 7, date(2024, 1, 31))
    return tables.read_table(p.spark, path).groupBy("day").agg(rows_as("n"))


@query("k13_run_metrics", "dag_id:s metric_name:s metric_value:d",
       """SELECT 'microbatch' AS dag_id, m AS metric_name, v AS metric_value FROM (
          SELECT 'raw_count' AS m, CAST(count(*) AS DOUBLE) AS v FROM deduplicated
          UNION ALL SELECT 'quarantine_count', count(*) FROM quarantine)""")
def run_metrics(p):
    """The window column is text and no number, so it leaves no metric."""
    path = work_path(p.spark, "metrics")
    row = quality.batch_metrics(p.deduplicated, p.quarantine).select(
        "raw_count", "quarantine_count", F.lit("2024-01-01..2024-01-31").alias("window"))
    start, end = ts("2024-01-01"), ts("2024-01-31")
    metrics.write_metrics(metrics.metric_rows(row, "microbatch", "run-1", start, end, end), path)
    return tables.read_table(p.spark, path)


@query("k13_observed_metrics", "metric_name:s metric_value:d",
       """SELECT 'raw_count' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value FROM deduplicated
          UNION ALL SELECT 'raw_max_position_ms', max(position_ms) FROM deduplicated
          UNION ALL SELECT 'quarantine_count', count(*) FROM quarantine""")
def observed_metrics(p):
    """Figures of raw and quarantine from the writes that store them."""
    root = work_path(p.spark, "observed")
    n = F.count(F.lit(1))
    found = metrics.observed(p.deduplicated, lambda df: tables.replace_table(df, f"{root}/raw", ["event_date"]),
                             raw_count=n, raw_max_position_ms=F.max("position_ms"))
    found |= metrics.observed(p.quarantine, lambda df: tables.replace_table(df, f"{root}/quarantine"), quarantine_count=n)
    start = ts("2024-01-01")
    row = tables.read_table(p.spark, f"{root}/raw").limit(1).select(*[F.lit(v).alias(k) for k, v in found.items()])
    metrics.write_metrics(metrics.metric_rows(row, "raw", "run-1", start, start, start), f"{root}/metrics")
    return tables.read_table(p.spark, f"{root}/metrics")


@query("j11_compare_partitions", "engagement_date:s title_key:i left_sessions:i right_sessions:i status:s partitions_read:i",
       """WITH old AS (SELECT engagement_date, title_key, sessions_count AS s FROM content_mart),
          new AS (SELECT engagement_date, title_key, s + CASE WHEN engagement_date = DATE '2024-01-12' THEN 1 ELSE 0 END AS s
                  FROM old WHERE engagement_date <> DATE '2024-01-20')
          SELECT *, 2 AS partitions_read FROM (
          SELECT coalesce(o.engagement_date, n.engagement_date) AS engagement_date, coalesce(o.title_key, n.title_key) AS title_key,
            o.s AS left_sessions, n.s AS right_sessions, CASE WHEN n.s IS NULL THEN 'only_left' ELSE 'differs' END AS status
          FROM old o LEFT JOIN new n ON o.engagement_date = n.engagement_date AND o.title_key = n.title_key
          WHERE o.s IS DISTINCT FROM n.s)""")
def compare_partitions(p):
    """Two stored versions of a mart: one day changed, one day gone; the other days are not compared row by row."""
    a, b = work_path(p.spark, "old"), work_path(p.spark, "new")
    day = F.col("engagement_date")
    rows = p.content_mart.select("engagement_date", "title_key", "sessions_count")
    tables.replace_table(rows, a, ["engagement_date"])
    old = tables.read_table(p.spark, a)
    more = F.when(day == F.lit("2024-01-12").cast("date"), 1).otherwise(0)
    tables.replace_table(old.where(day != F.lit("2024-01-20").cast("date")).withColumn("sessions_count", F.col("sessions_count") + more),
                         b, ["engagement_date"])
    new = tables.read_table(p.spark, b)
    cols = ["engagement_date", "title_key", "sessions_count"]
    n = len(differing_partitions(old, new, "engagement_date", cols))
    found = compare_partitioned(old, new, "engagement_date", cols[:2], cols[2:])
    return found.withColumnsRenamed({"left_sessions_count": "left_sessions", "right_sessions_count": "right_sessions"}).withColumn(
        "partitions_read", F.lit(n))


@query("k14_save_checks", "check:s passed:s observed:s",
       """SELECT 'orphan_' || d AS "check", n = 0 AS passed, n AS observed FROM (
          SELECT 'title' AS d, count(*) FILTER (WHERE title_key IS NULL) AS n FROM fact_events
          UNION ALL SELECT 'device', count(*) FILTER (WHERE device_key IS NULL) FROM fact_events
          UNION ALL SELECT 'customer', count(*) FILTER (WHERE customer_key IS NULL) FROM fact_events)""")
def save_checks(p):
    path = work_path(p.spark, "checks")
    metrics.save_checks(quality.check_orphans(p.tables("fact_events")), path, ts("2024-02-01"))
    return tables.read_table(p.spark, path)


@query("k14_gated_mart", "engagement_date:s genre:s watch_seconds:i refused:i _built_at:t",
       "SELECT engagement_date, genre, watch_seconds, 1 AS refused, TIMESTAMP '2024-02-01 00:00:00' AS _built_at FROM genre_mart")
def gated_mart(p):
    """A refresh whose checks hold, then one from sessions that came twice: its checks fail and the mart stays as it was."""
    path = work_path(p.spark, "gated")
    p = p.stored("fact_events", "fact_sessions")
    dim, refused = {"dim_title": p.dim_title}, 0
    for times, day in ((1, "2024-02-01"), (2, "2024-02-02")):
        sessions = p.fact_sessions.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("copy")
        gate = quality.check_sessions_equal_event_sessions({"fact_events": p.fact_events, "fact_sessions": sessions})
        try:
            marts.build_mart("genre_mix_daily", sessions, dim, path, checks=gate, built_at=ts(day))
        except metrics.CheckFailed:
            refused += 1
    return tables.read_table(p.spark, path).withColumn("refused", F.lit(refused))


@query("k14_commit_checks", "check:s passed:s",
       "SELECT unnest(['commit_gap', 'snapshot_lag']) AS \"check\", true AS passed")
def commit_checks(p):
    """File times of a table just written in two batches."""
    path = work_path(p.spark, "cadence")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        tables.append(ev(p).where(part).select("event_id", "day"), path, ["day"])
    return quality.check_commits(tables.read_table(p.spark, path), F.current_timestamp())


@query("rz1_store_raw_events", "kind:s n:i",
       """SELECT 'raw' AS kind, count(*) AS n FROM deduplicated UNION ALL SELECT 'quarantine', count(*)
          FROM quarantine""")
def store_raw_events(p):
    """Stored twice: neither the raw table nor the quarantine grows the second time."""
    root = work_path(p.spark, "raw-zone")
    for _ in range(2):
        clean, bad = raw.build_raw_events(p.landing, *map(F.lit, received_span(p)), RULES)
        raw.store_raw_events(clean, bad, f"{root}/raw", f"{root}/quarantine", parts=["event_date"])
    kinds = [tables.read_table(p.spark, f"{root}/{k}").select(F.lit(k).alias("kind")) for k in ("raw", "quarantine")]
    return kinds[0].unionByName(kinds[1]).groupBy("kind").agg(rows_as("n"))


@query("fx2_incremental", "session_id:s session_start_date:s watch_duration_seconds:i completion_pct:d pause_count:i "
       "n_events:i",
       """SELECT session_id, session_start_date, watch_duration_seconds, completion_pct, pause_count,
          (SELECT count(*) FROM fact_events) AS n_events FROM fact_sessions""")
def incremental_facts(p):
    """Raw events taken in four intervals of server time, the third one twice: the facts equal the one-pass build."""
    root = work_path(p.spark, "incremental")
    p = p.stored("raw", "dim_title", "dim_customer", "dim_device", "dim_device_version")
    lo, hi = p.raw.agg(F.min("server_received_at"), F.max("server_received_at")).first()
    step = (hi - lo) / 4 + timedelta(seconds=1)
    for k in (0, 1, 2, 2, 3):
        facts.run_interval(p.raw, p.star, p.dim_title, F.lit(lo + k * step), F.lit(lo + (k + 1) * step),
                           f"{root}/events", f"{root}/sessions", ROLES)
    n = tables.read_table(p.spark, f"{root}/events").agg(F.count(F.lit(1)).alias("n_events")).withColumn("k", F.lit(0))
    return tables.read_table(p.spark, f"{root}/sessions").withColumn("k", F.lit(0)).join(F.broadcast(n), "k")  # one row


@query("fx2_store_sessions", "session_id:s session_start_date:s watch_duration_seconds:i pause_count:i",
       "SELECT session_id, session_start_date, watch_duration_seconds, pause_count FROM fact_sessions")
def store_sessions(p):
    """First built without each session's opening event, then completed: start days move, no row stays behind."""
    path = work_path(p.spark, "sessions")
    p = p.stored("fact_events")
    w = F.row_number().over(Window.partitionBy("session_id").orderBy("event_timestamp", "event_id"))
    tail = p.fact_events.withColumn("rn", w).where("rn > 1").drop("rn")
    facts.store_fact_sessions(facts.build_fact_sessions(tail, p.dim_title, ROLES), path)
    facts.store_fact_sessions(facts.build_fact_sessions(p.fact_events, p.dim_title, ROLES), path)
    return tables.read_table(p.spark, path)


@query("fx3_changed_days", "session_start_date:s",
       """SELECT DISTINCT d.session_start_date FROM fact_sessions d
          WHERE session_id IN (SELECT session_id FROM raw WHERE position_ms > 3000000)""")
def changed_days(p):
    """Days to roll up again after some events arrived: sessions that changed, by their day before and after."""
    p = p.stored("fact_events")
    build = facts.build_fact_sessions
    touched = p.fact_events.where("position_ms > 3000000").select("session_id").distinct()
    before = build(p.fact_events.join(touched, "session_id", "left_anti"), p.dim_title, ROLES)
    return facts.changed_days(before, build(p.fact_events, p.dim_title, ROLES))
