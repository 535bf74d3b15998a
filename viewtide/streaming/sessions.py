"""Sessions kept up to date by micro-batches, and sessions closed after silence, by windows or by timers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from viewtide.plans.facts import Roles, build_fact_sessions, on_days, session_days, store_fact_sessions
from viewtide.plans.raw import Rules, newest_events, split_quarantine, store_raw_events
from viewtide.sources import tables


def update_sessions(batch: DataFrame, raw_path: str, quarantine_path: str, fact_path: str,
                    resolve: Callable[[DataFrame], DataFrame], titles: DataFrame, rules: Rules = Rules(),
                    roles: Roles = Roles(), raw_parts: Sequence[str] = ("event_date", "event_hour")) -> None:
    """Bring raw and session fact up to date with one micro-batch; running it twice changes nothing.

    Sessions are recomputed from all of their raw events, so late and repeated events end in the same row as a batch
    build. ``resolve`` adds the surrogate keys.
    """
    spark = batch.sparkSession
    clean, bad = split_quarantine(batch, rules)
    store_raw_events(newest_events(clean), bad, raw_path, quarantine_path, raw_parts)
    if clean.isEmpty():
        return
    ids = clean.select(F.col("session_id").alias("__s")).distinct()
    raw = on_days(tables.read_table(spark, raw_path, clean.schema), session_days(clean, fact_path))
    events = raw.join(ids, F.col("session_id") == F.col("__s"), "left_semi")
    store_fact_sessions(build_fact_sessions(resolve(events), titles, roles, days=True), fact_path)


def session_stream(stream: DataFrame, checkpoint: str, update: Callable[[DataFrame], None],
                   drain: bool = True, seconds: int = 60) -> StreamingQuery:
    """Run ``update`` on every micro-batch. The tables hold the state; the checkpoint holds the offsets."""
    def step(batch: DataFrame, _: int) -> None:
        batch.persist()  # read several times; lost blocks are recomputed from the source
        try:
            update(batch)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()


def close_idle(df: DataFrame, idle: str = "30 minutes", lateness: str = "24 hours",
               end_types: Sequence[str] = ("complete", "exit"), ts: str = "event_timestamp") -> DataFrame:
    """Sessions whose silence exceeded ``idle``; force-closed when no end event was seen.

    On a stream rows appear once the watermark passes the silence (append mode). Windows of a session merge in the
    state store; the session settings merge them in each task first, so a hot key sends one row per task and window.
    """
    ended = F.coalesce(F.col("event_type").isin(list(end_types)), F.lit(False))
    rows = df.withWatermark(ts, lateness) if df.isStreaming else df
    return (rows.groupBy("session_id", F.session_window(ts, idle).alias("w"))
            .agg(F.min(ts).alias("first_event_ts"), F.max(ts).alias("last_event_ts"),
                 F.count(F.lit(1)).alias("events"), F.bool_or(ended).alias("ended"))
            .select("session_id", "first_event_ts", "last_event_ts", "events",
                    (~F.col("ended")).alias("was_force_closed")))


STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
CLOSED = "session_id string, first bigint, last bigint, events bigint, was_force_closed boolean"


class IdleSessions(StatefulProcessor):
    """The open spans of a session as state, and a timer where the earliest of them falls silent for too long.

    Micros since the epoch throughout. Events may come in any order down to the watermark: they open, extend or join spans.
    When the timer fires, spans silent for longer than the gap leave; the state of a session without spans is removed.
    The state keeps the time of the session's only timer, so timers are neither listed nor set again where they stand. Every
    call to the state is a message, and a session costs a few of them a batch.
    """

    def __init__(self, idle_micros: int):
        self.idle = idle_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getValueState(
            "spans", "first array<bigint>, last array<bigint>, n array<bigint>, ended array<boolean>, timer bigint")

    def close(self) -> None:
        pass

    def _open(self) -> tuple[list[tuple], int | None]:
        """The spans of the session and the time of its timer."""
        held = self.spans.get()
        return (list(zip(*held[:4])), held[4]) if held else ([], None)

    def _keep(self, spans: list[tuple], timer: int | None) -> None:
        """Store ``spans``; ``timer`` is the one that is set."""
        # Timers have milliseconds; the first one at which the silence is longer than the gap.
        due = (min(s[1] for s in spans) + self.idle) // 1000 + 1 if spans else None
        if timer != due and timer is not None:
            self.handle.deleteTimer(timer)
        if due is None:
            self.spans.clear()
            return
        if timer != due:
            self.handle.registerTimer(due)
        self.spans.update((*(list(c) for c in zip(*spans)), due))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        spans, timer = self._open()
        spans += [(r["at"], r["at"], 1, r["end"]) for r in rows]
        joined: list[tuple] = []
        for first, last, n, ended in sorted(spans):
            if joined and first - joined[-1][1] <= self.idle:
                was = joined[-1]
                joined[-1] = (was[0], max(was[1], last), was[2] + n, was[3] or ended)
            else:
                joined.append((first, last, n, ended))
        self._keep(joined, timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs() * 1000  # spans behind the first may be silent long enough as well
        spans, _ = self._open()
        self._keep([s for s in spans if s[1] + self.idle >= until], None)  # Spark removes the timer that fired
        for first, last, n, ended in spans:
            if last + self.idle < until:
                yield Row(session_id=key[0], first=first, last=last, events=n, was_force_closed=not ended)


def close_idle_by_timer(stream: DataFrame, idle_seconds: int = 1800, lateness: str = "24 hours",
                        end_types: Sequence[str] = ("complete", "exit"), ts: str = "event_timestamp") -> DataFrame:
    """The rows of :func:`close_idle`, each when its session's event-time timer fires. Start the query under
    ``STATE_STORE``. Events behind the watermark do not reach the state (see ``events.dedup_with_late_table``)."""
    ended = F.coalesce(F.col("event_type").isin(list(end_types)), F.lit(False))
    rows = (stream.where(F.col(ts).isNotNull()).withWatermark(ts, lateness)
            .select("session_id", ts, F.unix_micros(ts).alias("at"), ended.alias("end")))
    closed = rows.groupBy("session_id").transformWithState(IdleSessions(idle_seconds * 1_000_000), CLOSED, "append", "EventTime")
    return closed.select("session_id", F.timestamp_micros("first").alias("first_event_ts"),
                         F.timestamp_micros("last").alias("last_event_ts"), "events", "was_force_closed")
