"""Structured Streaming queries: the events file is streamed to its end and the sink is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.bind import ROLES, RULES, TABLES, Playback
from viewtide.catalog.registry import query
from viewtide.operators.joins import resolve_keys
from viewtide.plans.raw import split_quarantine
from viewtide.session import work_path
from viewtide.sources import readers, tables
from viewtide.streaming import events as stream_events
from viewtide.streaming import landing as stream_landing
from viewtide.streaming import sessions as stream_sessions


def rows_as(name: str):
    return F.count(F.lit(1)).alias(name)


def stream(p: Playback) -> DataFrame:
    """Landing rows as an unbounded input."""
    source = readers.stream_files(p.spark, "parquet", f"{p.folder}/events.parquet", TABLES["events"],
                                  **stream_landing.source_limits("parquet"))
    return p.as_landing(source)


def landed(p: Playback, df: DataFrame, name: str, parts=("event_date",)) -> DataFrame:
    """Run a stream to its end into Parquet and read the sink."""
    path, log = work_path(p.spark, name), work_path(p.spark, f"{name}-log")
    stream_landing.drain(stream_landing.land_stream(df, path, log, parts=parts, drain=True))
    return p.spark.read.schema(df.schema).parquet(path)


@query("st1_land_stream", "event_id:i event_type:s server_received_at:t event_date:s",
       "SELECT event_id, event_type, server_received_at, event_date FROM landed")
def land_stream(p):
    return landed(p, stream(p), "landing")


@query("s6_event_stream", "event_type:s n:i", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def event_stream(p):
    """JSON lines written from the events, read as an unbounded source."""
    path = work_path(p.spark, "wire")
    p.events.select(F.col("event_id").cast("string").alias("event_id"), "event_type").write.json(path)
    source = readers.read_event_stream(p.spark, "json", {"path": path}, "event_id string, event_type string")
    return landed(p, source, "wire-landing", parts=("event_type",)).groupBy("event_type").agg(rows_as("n"))


@query("st2_restart", "n:i distinct_n:i", "SELECT count(*) AS n, count(DISTINCT event_id) AS distinct_n FROM events")
def restart(p):
    """A second start from the same checkpoint finds nothing new, so no row is written twice."""
    path, log = work_path(p.spark, "landing"), work_path(p.spark, "landing-log")
    for _ in range(2):
        stream_landing.drain(stream_landing.land_stream(stream(p), path, log, parts=("event_date",), drain=True))
    stored = p.spark.read.schema(stream(p).schema).parquet(path)
    return stored.agg(rows_as("n"), F.countDistinct("event_id").alias("distinct_n"))


@query("st3_drain", "event_hour:i n:i", "SELECT event_hour, count(*) AS n FROM landed GROUP BY 1")
def drained(p):
    return landed(p, stream(p), "drain", parts=("event_hour",)).groupBy("event_hour").agg(rows_as("n"))


@query("st4_dedup_stream", "event_id:i", "SELECT event_id FROM landed")
def dedup_stream(p):
    """Every 50th event comes twice within the stream and stays once."""
    twice = stream(p).withColumn("copy", F.explode(F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1)))
                                                   .otherwise(F.array(F.lit(0))))).drop("copy")
    return landed(p, stream_events.dedup_stream(twice, "40 days"), "dedup")


@query("st4_late_table", "event_id:i in_time:i behind:i",
       "SELECT event_id, 1 AS in_time, 1 AS behind FROM landed")
def late_table(p):
    """A shuffled backlog of a month under a horizon of a day: most rows come behind the watermark, and none is lost.
    ``in_time`` and ``behind`` say whether both tables have rows."""
    wire, path, late = (work_path(p.spark, n) for n in ("backlog", "first", "late"))
    rows = p.as_landing(p.events)
    for k in range(4):
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k).coalesce(1).write.mode("append").parquet(wire)
    source = p.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(wire)
    stream_landing.drain(stream_events.dedup_with_late_table(source, path, late, work_path(p.spark, "late-log"), 86_400))
    kept, behind = (p.spark.read.schema(rows.schema).parquet(x).select("event_id") for x in (path, late))
    some = [df.agg(F.least(rows_as("n"), F.lit(1)).alias(name)).withColumn("k", F.lit(0))
            for df, name in ((kept, "in_time"), (behind, "behind"))]
    flags = F.broadcast(some[0].join(some[1], "k"))  # one row
    return kept.unionByName(behind).distinct().withColumn("k", F.lit(0)).join(flags, "k").drop("k")


@query("st5_split_late", "late:s n:i",
       """SELECT epoch_us(server_received_at) // 1000000 - epoch_us(event_timestamp) // 1000000 > 86400 AS late,
          count(*) AS n FROM landed GROUP BY 1""")
def split_late(p):
    intime, late = stream_events.split_late(stream(p))
    kept = [landed(p, df, name).select(F.lit(name == "late").alias("late"))
            for df, name in ((intime, "intime"), (late, "late"))]
    return kept[0].unionByName(kept[1]).groupBy("late").agg(rows_as("n"))


@query("st6_drop_future", "event_id:i",
       "SELECT event_id FROM landed WHERE event_timestamp <= server_received_at + INTERVAL 5 MINUTE")
def drop_future(p):
    return landed(p, stream_events.drop_future(stream(p)), "guarded")


@query("st7_session_stream", "session_id:s session_start_date:s watch_duration_seconds:i completion_pct:d "
       "pause_count:i seek_count:i was_completed:s", "SELECT * FROM fact_sessions")
def session_stream(p):
    """Raw events arrive in two deliveries by type, each streamed as it lands; the fact equals the batch build."""
    wire, root, log = (work_path(p.spark, n) for n in ("wire", "session-zone", "session-log"))
    p = p.stored("raw", "dim_title", "dim_customer", "dim_device", "dim_device_version")
    rows, titles = p.raw, p.dim_title

    def update(batch: DataFrame) -> None:
        stream_sessions.update_sessions(batch, f"{root}/raw", f"{root}/quarantine", f"{root}/sessions",
                                        lambda e: resolve_keys(e, p.star), titles, RULES, ROLES, ("event_date",))

    for delivery in ("event_type in ('view', 'click')", "event_type not in ('view', 'click')"):
        rows.where(delivery).write.mode("append").parquet(wire)
        source = p.spark.readStream.schema(rows.schema).parquet(wire)
        stream_landing.drain(stream_sessions.session_stream(source, log, update))
    return tables.read_table(p.spark, f"{root}/sessions")


@query("st8_volume_stream", "window_start:t rows:i avg_lag_seconds:d max_lag_seconds:d",
       """SELECT time_bucket(INTERVAL 15 MINUTE, event_timestamp) AS window_start, count(*) AS rows,
          sum(epoch_us(server_received_at) - epoch_us(event_timestamp)) / count(*) / 1000000.0 AS avg_lag_seconds,
          max(epoch_us(server_received_at) - epoch_us(event_timestamp)) / 1000000.0 AS max_lag_seconds
          FROM landed GROUP BY 1""")
def volume_stream(p):
    """Windows leave the stream when the watermark passes, so the stream ends with a marker far in the future."""
    path, log, wire = (work_path(p.spark, n) for n in ("volume", "volume-log", "volume-in"))
    rows = p.as_landing(p.events).select("event_timestamp", "server_received_at", "event_id")
    rows.write.parquet(wire)
    last = rows.agg(F.max("event_timestamp").alias("m"))
    ends = last.select((F.col("m") + F.expr("interval 90 days")).alias("event_timestamp"),
                       (F.col("m") + F.expr("interval 90 days")).alias("server_received_at"),
                       F.lit(-1).cast("bigint").alias("event_id"))
    ends.coalesce(1).write.mode("append").parquet(wire)
    source = p.spark.readStream.schema(rows.schema).parquet(wire)
    out = stream_events.volume_stream(source, lateness="40 days")
    q = (out.writeStream.format("parquet").outputMode("append").option("path", path)
         .option("checkpointLocation", log).trigger(availableNow=True).start())
    stream_landing.drain(q)
    return p.spark.read.schema(out.schema).parquet(path)


@query("st8_volume_batch", "window_start:t rows:i max_lag_seconds:d",
       """SELECT time_bucket(INTERVAL 15 MINUTE, event_timestamp) AS window_start, count(*) AS rows,
          max(epoch_us(server_received_at) - epoch_us(event_timestamp)) / 1000000.0 AS max_lag_seconds
          FROM landed GROUP BY 1""")
def volume_batch(p):
    return stream_events.volume(p.as_landing(p.events))


@query("st9_replay", "run:i n:i", "SELECT run, count(*) AS n FROM landed, (VALUES (1), (2)) AS r(run) GROUP BY 1")
def replay(p):
    """The log read twice from its start, each time with a new checkpoint into a new table."""
    runs = []
    for run in (1, 2):
        path = work_path(p.spark, "replay")
        stream_landing.drain(stream_landing.replay(stream(p), path, work_path(p.spark, "replay-log"),
                                                   parts=("event_date",)))
        runs.append(p.spark.read.schema(stream(p).schema).parquet(path).select(F.lit(run).alias("run")))
    return runs[0].unionByName(runs[1]).groupBy("run").agg(rows_as("n"))


IDLE = """SELECT customer_id AS session_id, count(*) AS events, max(event_timestamp) AS last_event_ts,
          NOT bool_or(event_type IN ('purchase', 'click')) AS was_force_closed FROM (
          SELECT *, sum(s) OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING)
          AS g FROM (SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER w <= INTERVAL 240 MINUTE THEN 0
          ELSE 1 END AS s FROM deduplicated WINDOW w AS (PARTITION BY customer_id ORDER BY event_timestamp, event_id)))
          GROUP BY customer_id, g"""


@query("st10_close_idle", "session_id:s events:i last_event_ts:t was_force_closed:s", IDLE)
def close_idle(p):
    return stream_sessions.close_idle(p.deduplicated.withColumn("session_id", F.col("customer_id")), "240 minutes",
                                      end_types=ROLES.end)


@query("st10_timer_stream", "session_id:s events:i last_event_ts:t was_force_closed:s", IDLE)
def timer_stream(p):
    """The same sessions from a stream in two runs over one checkpoint, each closed by its timer; a marker far in the future
    lets the last timers fire."""
    wire, log, path = (work_path(p.spark, n) for n in ("idle-in", "idle-log", "idle"))
    rows = p.stored("deduplicated").deduplicated.select(F.col("customer_id").alias("session_id"), "event_timestamp", "event_type")
    middle = rows.agg(F.expr("timestamp_micros((min(unix_micros(event_timestamp)) + max(unix_micros(event_timestamp))) div 2)")
                      .alias("m")).first().m
    marker = rows.agg(F.max("event_timestamp").alias("m")).select(
        F.lit("marker").alias("session_id"), (F.col("m") + F.expr("interval 90 days")).alias("event_timestamp"),
        F.lit("view").alias("event_type"))
    before = F.col("event_timestamp") < F.lit(middle)
    was = {k: p.spark.conf.get(k) for k in stream_sessions.STATE_STORE}
    try:
        for k, v in stream_sessions.STATE_STORE.items():
            p.spark.conf.set(k, v)
        for delivery in ([rows.where(before)], [rows.where(~before), marker]):
            for part in delivery:
                part.write.mode("append").parquet(wire)
            source = p.spark.readStream.schema(rows.schema).parquet(wire)
            out = stream_sessions.close_idle_by_timer(source, 240 * 60, "1 day", ROLES.end)
            stream_landing.drain(out.writeStream.format("parquet").outputMode("append").option("path", path)
                                 .option("checkpointLocation", log).trigger(availableNow=True).start())
    finally:
        for k, v in was.items():
            p.spark.conf.set(k, v)
    return p.spark.read.schema(out.schema).parquet(path)


@query("st5_quarantine_stream", "n_clean:i n_bad:i",
       "SELECT count(*) FILTER (WHERE r.reason IS NULL) AS n_clean, count(r.reason) AS n_bad FROM (SELECT event_id, "
       "min(server_received_at) AS t FROM marked GROUP BY 1) f JOIN marked r ON r.event_id = f.event_id "
       "AND r.server_received_at = f.t")
def quarantine_stream(p):
    """The batch split applied to a stream."""
    clean, bad = split_quarantine(stream(p), RULES)
    a = landed(p, clean, "clean").agg(rows_as("n_clean")).withColumn("k", F.lit(0))
    b = landed(p, bad.drop("_quarantine_reason"), "bad").agg(rows_as("n_bad")).withColumn("k", F.lit(0))
    return a.join(F.broadcast(b), "k")  # two one-row aggregates
