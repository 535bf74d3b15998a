"""Fact tables at event, session and day grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.functions.scalars import completion_pct, date_key, epoch_seconds, value_at_last
from viewtide.operators.joins import attach, null_safe_join, resolve_keys
from viewtide.operators.windows import watch_deltas
from viewtide.sources import tables

FK_COLS = ("customer_key", "title_key", "device_key", "device_version_key")
EVENT_COLS = ("event_id", "session_id", *FK_COLS, "date_key", "event_type", "event_timestamp", "position_ms",
              "bitrate_kbps", "geo_country", "event_date", "event_hour")


@dataclass(frozen=True)
class Roles:
    """Which event types play which part in a session."""

    play: Sequence[str] = ("play",)
    pause: Sequence[str] = ("pause",)
    seek: Sequence[str] = ("seek",)
    resume: Sequence[str] = ("resume",)
    complete: Sequence[str] = ("complete",)
    end: Sequence[str] = ("complete", "exit")


def build_fact_events(raw: DataFrame, dims: Mapping[str, tuple[DataFrame, str, str]],
                      keep: Sequence[str] = ()) -> DataFrame:
    """Transaction fact: raw events with surrogate keys; an unresolved key stays NULL."""
    keyed = resolve_keys(raw, dims).withColumn("date_key", date_key(F.col("event_date")))
    return keyed.select(*EVENT_COLS, *keep)


def with_event_keys(events: DataFrame, raw: DataFrame, geography: DataFrame | None = None) -> DataFrame:
    """The event fact with ``time_of_day_key``, ``schema_version``, ``_loaded_at`` (where the raw zone has them) and, from
    a geography dimension, ``geography_key``; an unknown country stays NULL."""
    out = events.withColumn("time_of_day_key", F.col("event_hour").cast("int"))
    more = [c for c in ("schema_version", "_loaded_at") if c in raw.columns and c not in events.columns]
    if more:
        out = out.join(raw.select("event_id", *more), "event_id")
    if geography is None:
        return out
    return resolve_keys(out, {"geo_country": (geography, "country_code", "geography_key")})


def _among(types: Sequence[str]) -> str:
    """SQL text: whether the event type is one of ``types``; false when it is missing."""
    listed = ", ".join(f"'{t}'" for t in types)
    return f"coalesce(event_type in ({listed}), false)" if types else "false"


def session_aggregate(events: DataFrame, roles: Roles = Roles(), extra: bool = False, days: bool = False) -> DataFrame:
    """One row per session from all of its events, combined map-side before the shuffle; with ``days`` also the set of its
    days, ``event_days``."""
    known = [f"min_by({c}, if({c} is not null, struct(event_timestamp, event_id), null)) as {c}"
             for c in FK_COLS if c in events.columns]
    aggs = known + [
        "min(event_timestamp) as session_start_ts",
        "max(event_timestamp) as session_end_ts",
        "max(position_ms) as max_position_ms",
        f"count_if({_among(roles.pause)}) as pause_count",
        f"count_if({_among(roles.seek)}) as seek_count",
        f"bool_or({_among(roles.complete)}) as was_completed",
    ]
    if extra:
        aggs.append(f"count_if({_among([*roles.play, *roles.resume])}) as play_resume_count")
    if days:
        aggs.append("array_sort(collect_set(event_date)) as event_days")
    return events.groupBy("session_id").agg(*map(F.expr, aggs))


def build_fact_sessions(events: DataFrame, titles: DataFrame, roles: Roles = Roles(),
                        extra: bool = False, days: bool = False) -> DataFrame:
    """Accumulating snapshot: watch time is wall clock, completion is the furthest position over the runtime."""
    agg = session_aggregate(events, roles, extra, days)
    start, end = F.col("session_start_ts"), F.col("session_end_ts")
    more = ["play_resume_count", F.col("session_end_ts").alias("_last_event_at")] if extra else []
    more += ["event_days"] if days else []
    return attach(agg, titles, "title_key", ["runtime_minutes"]).select(
        "session_id", *[c for c in FK_COLS if c in agg.columns],
        date_key(F.to_date(start)).alias("date_key"), start, end,
        (epoch_seconds(end) - epoch_seconds(start)).cast("int").alias("watch_duration_seconds"),
        (F.col("runtime_minutes") * 60).cast("int").alias("content_duration_seconds"),
        completion_pct(F.col("max_position_ms"), F.col("runtime_minutes")).alias("completion_pct"),
        "pause_count", "seek_count", "was_completed", F.lit(False).alias("was_force_closed"),
        *more, F.to_date(start).alias("session_start_date"))


def touched_sessions(events: DataFrame, received: str, start: Column, end: Column) -> DataFrame:
    """All events of the sessions that received something in the interval, by server time."""
    hit = (events.where((F.col(received) >= start) & (F.col(received) < end))
           .select(F.col("session_id").alias("__s")).distinct())
    return events.join(hit, F.col("session_id") == F.col("__s"), "left_semi")


def store_fact_events(fact: DataFrame, path: str, order: Sequence[str]) -> None:
    tables.upsert(fact, path, ["event_id"], ["event_date"], order)


def store_fact_sessions(sessions: DataFrame, path: str, updated_at: Column | None = None) -> None:
    """Upsert by session. A recomputed session is complete, so it always replaces the stored one, also when it ends
    earlier than before; if its start moves to another day it leaves the old partition. ``updated_at``, a time the caller
    names, is kept as ``_updated_at``."""
    if updated_at is not None:
        sessions = sessions.withColumn("_updated_at", updated_at)
    tables.upsert(sessions, path, ["session_id"], ["session_start_date"], [])


def session_days(batch: DataFrame, fact_path: str) -> list[date]:
    """The days on which the sessions of ``batch`` have events: those stored with each known session, found through the
    fact's key index, and the batch's own. The list is bounded by the day partitions of raw."""
    days = batch.select("event_date")
    if tables.table_exists(batch.sparkSession, fact_path):
        known = tables.rows_with_keys(batch.sparkSession, fact_path, batch.select("session_id").distinct(), ["session_id"],
                                      ["session_start_date"], batch.sparkSession.read.parquet(fact_path).schema)
        days = days.unionByName(known.select(F.explode("event_days").alias("event_date")))
    return sorted(r[0] for r in days.distinct().collect() if r[0] is not None)


def on_days(events: DataFrame, days: Sequence[date]) -> DataFrame:
    """The partitions of these days; the scan skips all others."""
    return events.where(F.col("event_date").isin(list(days)) if days else F.lit(False))


def run_interval(raw: DataFrame, dims: Mapping[str, tuple[DataFrame, str, str]], titles: DataFrame, start: Column,
                 end: Column, event_path: str, session_path: str, roles: Roles = Roles()) -> None:
    """The incremental facts of one interval of server time: events received in it, and every session they touch.

    The events of touched sessions are read again from raw, all of them, so a session is complete each time; only the
    days on which one of them has events are read, so an old session costs its own days. New events are pruned by the lateness
    bound (a day before the interval, a day after for clocks ahead). Running an interval twice changes nothing.
    """
    days = F.col("event_date").between(F.date_sub(F.to_date(start), 1), F.date_add(F.to_date(end), 1))
    received = (F.col("server_received_at") >= start) & (F.col("server_received_at") < end)
    fresh = raw.where(days & received)
    store_fact_events(build_fact_events(fresh, dims, keep=["server_received_at"]), event_path, ["server_received_at"])
    events = touched_sessions(on_days(raw, session_days(fresh, session_path)), "server_received_at", start, end)
    store_fact_sessions(build_fact_sessions(build_fact_events(events, dims), titles, roles, days=True), session_path)


def build_fact_daily(sessions: DataFrame, day: date | str | None = None, include_ending: bool = False) -> DataFrame:
    """Day grain by (day, customer, title). ``include_ending`` also counts a session on the day it ends."""
    start_day, end_day = F.col("session_start_date"), F.to_date("session_end_ts")
    if include_ending:
        days = F.array_distinct(F.array(start_day, end_day))
        rows = sessions.withColumn("engagement_date", F.explode(days))
    else:
        rows = sessions.withColumn("engagement_date", start_day)
    if day is not None:
        rows = rows.where(F.col("engagement_date") == F.lit(day).cast("date"))
    aggs = [
        F.count("session_id").alias("sessions_count"),
        F.sum("watch_duration_seconds").cast("bigint").alias("total_watch_seconds"),
        F.avg("completion_pct").cast("decimal(4,3)").alias("completion_pct"),
        F.max("session_end_ts").alias("last_session_end_ts"),
        F.max(F.when(F.col("was_completed"), F.col("content_duration_seconds").cast("bigint") * 1000)
              .otherwise(F.col("watch_duration_seconds").cast("bigint") * 1000)).alias("last_position_ms"),
    ]
    if include_ending:
        aggs.append(value_at_last("content_duration_seconds", ["session_end_ts", "session_id"])
                    .alias("last_content_seconds"))
    return (rows.groupBy("engagement_date", "customer_key", "title_key").agg(*aggs)
            .withColumn("date_key", date_key(F.col("engagement_date"))))


def store_fact_daily(daily: DataFrame, path: str, days: Sequence[date]) -> None:
    """Replace the days; one without sessions ends up empty."""
    tables.replace_partitions(daily, path, "engagement_date", list(days))


def changed_days(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """Days whose sessions were added, changed or moved away, to be rolled up again."""
    now = after.select("session_id", "session_start_date", "session_end_ts", "completion_pct")
    if before is None:
        return now.select("session_start_date").distinct()
    was = before.select(*now.columns)
    added = null_safe_join(now, was, now.columns, "left_anti")
    gone = null_safe_join(was, now, now.columns, "left_anti")
    return added.unionByName(gone).select("session_start_date").distinct()


def force_closed(sessions: DataFrame, as_of: Column, idle_seconds: int = 24 * 3600) -> DataFrame:
    """Close sessions without an end event that were silent for longer than ``idle_seconds`` at ``as_of``.

    ``sessions`` carries ``ended``: whether any end event was seen.
    """
    silent = epoch_seconds(as_of) - epoch_seconds(F.col("session_end_ts"))
    return sessions.withColumn("was_force_closed", ~F.col("ended") & (silent > idle_seconds))


def ended_flag(events: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return events.groupBy("session_id").agg(F.max("event_timestamp").alias("session_end_ts"),
                                            F.expr(f"bool_or({_among(roles.end)}) as ended"))


def active_watch(events: DataFrame, roles: Roles = Roles(), hot_rows: int | None = None) -> DataFrame:
    """Watch seconds per session without pauses."""
    deltas = watch_deltas(events, "session_id", "event_timestamp", "event_id", "event_type",
                          [*roles.play, *roles.resume, *roles.seek], hot_rows=hot_rows)
    micros = F.round(F.col("watch_seconds_delta") * 1_000_000).cast("bigint")
    return deltas.groupBy("session_id").agg((F.sum(micros) / F.lit(1_000_000.0)).alias("active_watch_seconds"))


def orphan_rows(fact: DataFrame, keys: Sequence[str] = ("customer_key", "title_key", "device_key")) -> DataFrame:
    """Fact rows with an unresolved key and the list of those keys."""
    missing = F.filter(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys]), lambda m: m.isNotNull())
    return fact.withColumn("orphan_keys", F.array_join(missing, ",")).where(F.col("orphan_keys") != "")

