"""Streams equal their batch form."""

import datetime as dt

from conftest import at
from pyspark.sql import Row
from pyspark.sql import functions as F

from viewtide.bind import Playback
from viewtide.catalog import QUERIES
from viewtide.plans import facts
from viewtide.plans.raw import newest_events, split_quarantine
from viewtide.sources import readers, tables
from viewtide.streaming import events, landing, sessions

T0 = at("2024-01-10 23:00:00")
M = dt.timedelta(minutes=1)


def conformed(df):
    return df.withColumns({"event_date": F.to_date("event_timestamp"), "event_hour": F.hour("event_timestamp")})


def test_sessions_from_micro_batches(spark, make_events, tmp_path):
    """Late, repeated and out-of-order events over three micro-batches end in the batch result."""
    batches = [
        [{"event_id": "a", "event_timestamp": T0 + 70 * M, "position_ms": 60000},
         {"event_id": "b", "event_timestamp": T0 + 80 * M, "event_type": "pause", "position_ms": 90000},
         {"event_id": "x", "event_type": "nonsense"}],
        [{"event_id": "c", "event_timestamp": T0, "position_ms": 0},
         {"event_id": "b", "event_timestamp": T0 + 80 * M, "event_type": "pause", "position_ms": 90000}],
        [{"event_id": "d", "session_id": "s2", "event_timestamp": T0 + 5 * M},
         {"event_id": "e", "event_timestamp": T0 + 90 * M, "event_type": "complete", "position_ms": 120000}]]
    wire = str(tmp_path / "wire")
    for b in batches:
        conformed(make_events(*b)).coalesce(1).write.mode("append").parquet(wire)
    schema = conformed(make_events({})).schema
    titles = spark.createDataFrame([(1, 4)], "title_key bigint, runtime_minutes int")

    def resolve(df):
        return df.withColumns({k: F.lit(1).cast("bigint") for k in facts.FK_COLS})

    root = str(tmp_path / "zone")

    def update(batch):
        sessions.update_sessions(batch, f"{root}/raw", f"{root}/bad", f"{root}/fact", resolve, titles)

    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(wire)
    query = sessions.session_stream(source, str(tmp_path / "log"), update)
    landing.drain(query)
    assert len(query.recentProgress) >= 3
    every = spark.read.schema(schema).parquet(wire)
    want = facts.build_fact_sessions(resolve(newest_events(split_quarantine(every)[0])), titles)
    got = tables.read_table(spark, f"{root}/fact").select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert tables.read_table(spark, f"{root}/bad").count() == 1
    before = sorted(map(str, got.collect()))
    update(every)  # a replay of everything changes nothing
    assert sorted(map(str, tables.read_table(spark, f"{root}/fact").select(*want.columns).collect())) == before


def test_land_restart_and_replay(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "1.json").write_text('{"event_id": "a", "event_type": "play"}\n')
    ddl = "event_id string, event_type string"
    out, log = str(tmp_path / "out"), str(tmp_path / "log")

    def run(target=out, checkpoint=log):
        stream = readers.read_event_stream(spark, "json", {"path": str(src)}, ddl)
        landing.drain(landing.land_stream(stream, target, checkpoint, parts=("event_type",), drain=True))

    run()
    (src / "2.json").write_text('{"event_id": "b", "event_type": "exit"}\n')
    run()
    run()
    assert spark.read.parquet(out).count() == 2
    run(str(tmp_path / "again"), str(tmp_path / "log2"))
    assert spark.read.parquet(str(tmp_path / "again")).count() == 2


def test_late_split_keeps_every_row(make_events):
    df = make_events({}, {"server_received_at": T0 + 25 * 60 * M, "event_timestamp": T0}, {"event_timestamp": None})
    ontime, late = events.split_late(df)
    assert ontime.count() == 1 and late.count() == 2


def test_future_guard(make_events):
    df = make_events({}, {"event_timestamp": T0 + 6 * M, "server_received_at": T0})
    assert events.drop_future(df).count() == 1


def test_volume_stream_equals_batch(spark, make_events, tmp_path):
    df = make_events(*[{"event_timestamp": T0 + i * 7 * M} for i in range(20)], {"event_timestamp": T0 + 9999 * M})
    wire = str(tmp_path / "wire")
    df.coalesce(1).write.parquet(wire)
    out = events.volume_stream(spark.readStream.schema(df.schema).parquet(wire), lateness="1 hour")
    q = (out.writeStream.format("parquet").option("path", str(tmp_path / "v")).outputMode("append")
         .option("checkpointLocation", str(tmp_path / "l")).trigger(availableNow=True).start())
    landing.drain(q)
    got = {(r["window_start"], r["rows"]) for r in spark.read.parquet(str(tmp_path / "v")).collect()}
    want = {(r["window_start"], r["rows"]) for r in events.volume(df).collect()}
    assert got == {w for w in want if w[0] < (T0 + 9000 * M).replace(tzinfo=None)}


def test_close_idle(make_events):
    df = make_events({"event_timestamp": T0}, {"event_timestamp": T0 + 29 * M},
                     {"event_timestamp": T0 + 80 * M, "event_type": "exit"})
    got = sorted((r["events"], r["was_force_closed"]) for r in sessions.close_idle(df).collect())
    assert got == [(1, False), (2, True)]


def test_moved_copy_and_old_session_in_micro_batches(spark, make_events, tmp_path, monkeypatch):
    """A newer copy dated days later replaces its event, and a session a year old costs its own days only."""
    root = str(tmp_path / "zone")
    titles = spark.createDataFrame([(1, 4)], "title_key bigint, runtime_minutes int")
    read = []
    plain = sessions.on_days
    monkeypatch.setattr(sessions, "on_days", lambda e, days: read.append(list(days)) or plain(e, days))

    def resolve(df):
        return df.withColumns({k: F.lit(1).cast("bigint") for k in facts.FK_COLS})

    def update(*rows):
        sessions.update_sessions(conformed(make_events(*rows)), f"{root}/raw", f"{root}/bad", f"{root}/fact", resolve, titles)

    year, day = T0 - dt.timedelta(days=365), dt.timedelta(days=1)
    late = dt.timedelta(days=300)
    update({"event_id": "old", "session_id": "s0", "event_timestamp": year, "server_received_at": year},
           {"event_id": "a", "session_id": "s1", "event_timestamp": T0, "server_received_at": T0})
    for k in range(1, 4):
        at_ = T0 + k * day
        update({"event_id": f"b{k}", "session_id": f"t{k}", "event_timestamp": at_, "server_received_at": at_})
    update({"event_id": "a", "session_id": "s1", "event_timestamp": T0 + 4 * day, "server_received_at": T0 + 4 * day},
           {"event_id": "new", "session_id": "s0", "event_timestamp": T0 + 4 * day, "server_received_at": T0 + 4 * day})
    assert read[-1] == [year.date(), T0.date(), (T0 + 4 * day).date()] and late > day
    raw = tables.read_table(spark, f"{root}/raw")
    assert raw.count() == 6 == raw.select("event_id").distinct().count()
    fact = {r["session_id"]: r for r in tables.read_table(spark, f"{root}/fact").collect()}
    assert len(fact) == 5 and fact["s1"]["session_start_date"] == (T0 + 4 * day).date()
    assert fact["s0"]["session_start_date"] == year.date() and len(fact["s0"]["event_days"]) == 2


def test_late_table_takes_what_the_watermark_leaves_behind(spark, make_events, tmp_path):
    wire, out, late, log = (str(tmp_path / n) for n in ("wire", "out", "late", "log"))
    order = [0, 50, 3, 49, 100, 98, 2, 101]  # hours; the horizon is ten
    first = make_events({})
    for k, h in enumerate(order):
        rows = [{"event_id": f"e{h}", "event_timestamp": T0 + h * 60 * M}, {"event_id": "e0", "event_timestamp": T0 + h * 60 * M}]
        make_events(*rows).coalesce(1).write.mode("append").parquet(wire)
        if k in (3, 7):  # a restart in between
            source = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(wire)
            landing.drain(events.dedup_with_late_table(source, out, late, log, 10 * 3600))
    kept = sorted(r.event_id for r in spark.read.schema(first.schema).parquet(out).collect())
    behind = {r.event_id for r in spark.read.schema(first.schema).parquet(late).collect()}
    assert {"e3", "e2"} <= behind and set(kept) | behind == {f"e{h}" for h in order} and not {"e49", "e98"} & behind
    assert all(kept.count(k) == 1 for k in kept if k != "e0")  # e0 comes again beyond the horizon


def test_timers_close_silent_sessions_after_a_restart(spark, tmp_path):
    wire, log, out = (str(tmp_path / n) for n in ("wire", "log", "out"))
    ddl = "session_id string, event_timestamp timestamp, event_type string"

    def minute(n):
        return T0 + n * M

    runs = [[("a", minute(10), "play"), ("a", minute(0), "play"), ("b", minute(5), "exit")],
            [("a", minute(25), "play"), ("b", minute(200), "play"), ("c", minute(400), "play")],
            [("z", minute(3000), "play")]]
    before = {k: spark.conf.get(k) for k in sessions.STATE_STORE}
    try:
        for k, v in sessions.STATE_STORE.items():
            spark.conf.set(k, v)
        for rows in runs:
            spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(wire)
            stream = sessions.close_idle_by_timer(spark.readStream.schema(ddl).parquet(wire), 1800, "1 hour")
            landing.drain(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", log)
                          .trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = sorted((r["session_id"], r["events"], r["was_force_closed"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", 3, True), ("b", 1, False), ("b", 1, True), ("c", 1, True)]


class FakeHandle:
    """One session's state and timers, and the messages they cost."""

    def __init__(self):
        self.held, self.timers, self.messages = None, set(), []

    def getValueState(self, *_):
        return self

    def _say(self, name):
        self.messages.append(name)

    def get(self):
        self._say("get")
        return self.held

    def exists(self):
        self._say("exists")
        return self.held is not None

    def update(self, value):
        self._say("update")
        self.held = value

    def clear(self):
        self._say("clear")
        self.held = None

    def registerTimer(self, at):
        self._say("register")
        self.timers.add(at)

    def deleteTimer(self, at):
        self._say("delete")
        self.timers.discard(at)

    def listTimers(self):
        self._say("list")
        return iter([(t,) for t in self.timers])


def test_a_session_costs_few_messages_to_its_state():
    handle, idle = FakeHandle(), sessions.IdleSessions(1_000_000)
    idle.init(handle)

    def put(*at):
        handle.messages.clear()
        list(idle.handleInputRows(("a",), iter([Row(at=t, end=False) for t in at]), None))
        return list(handle.messages)

    assert put(5_000_000) == ["get", "register", "update"] and handle.timers == {6_001}
    assert put(9_000_000) == ["get", "update"] and handle.timers == {6_001}  # the earliest span stands
    assert put(5_500_000) == ["get", "delete", "register", "update"] and handle.timers == {6_501}


def test_streaming_queries_compute_their_input_once(spark, monkeypatch):
    kept = []
    plain = Playback.stored
    monkeypatch.setattr(Playback, "stored", lambda self, *names: kept.append(names) or plain(self, *names))
    QUERIES["st7_session_stream"].run(spark, "/root/testdata/sf0.001")
    assert {"raw", *(f"dim_{d}" for d in ("title", "customer", "device", "device_version"))} <= set(kept[0])
