"""Dimensions, facts, marts and reports on hand-written rows."""

import datetime as dt
from decimal import Decimal

from conftest import at
from pyspark.sql import functions as F

from viewtide.plans import dims, facts, marts, quality, reports
from viewtide.sources import tables

T0 = at("2024-01-10 23:50:00")
M = dt.timedelta(minutes=1)


def titles(spark, *rows):
    return spark.createDataFrame(list(rows), "title_key bigint, tconst string, primary_title string, title_type string, "
                                 "genres string, runtime_minutes int")


TITLE_ROWS = [(1, "tt1", "One", "movie", "Action, Drama", 10), (2, "tt2", "Two", "movie", "Drama", None),
              (3, "tt3", "Three", "movie", None, 0)]


def keyed(make_events, *rows):
    full = [{"event_timestamp": T0 + i * M, **r} for i, r in enumerate(rows)]
    df = make_events(*[{k: v for k, v in r.items() if not k.endswith("_key")} for r in full])
    key_of = {f"e{i}": r for i, r in enumerate(full)}
    pairs = [(e, r.get("customer_key", 1), r.get("title_key", 1), r.get("device_key", 1)) for e, r in key_of.items()]
    lookup = df.sparkSession.createDataFrame(
        pairs, "event_id string, customer_key bigint, title_key bigint, device_key bigint")
    return df.join(lookup, "event_id").withColumn("event_date", F.to_date("event_timestamp"))


def sessions(make_events, spark, *rows, **kw):
    return facts.build_fact_sessions(keyed(make_events, *rows), titles(spark, *TITLE_ROWS), **kw)


def test_session_across_midnight(spark, make_events):
    row = sessions(make_events, spark, {}, {"event_timestamp": T0 + 20 * M, "event_type": "complete",
                                            "position_ms": 300000}).first()
    assert row["session_start_date"] == dt.date(2024, 1, 10) and row["watch_duration_seconds"] == 1200
    assert row["completion_pct"] == Decimal("0.500") and row["was_completed"] and row["date_key"] == 20240110


def test_completion_edges(spark, make_events):
    rows = sessions(make_events, spark,
                    {"session_id": "no_runtime", "title_key": 2, "position_ms": 9},
                    {"session_id": "zero_runtime", "title_key": 3, "position_ms": 9},
                    {"session_id": "unknown_title", "title_key": None, "position_ms": 9},
                    {"session_id": "past_end", "position_ms": 700000},
                    *[{"session_id": f"p{p}", "position_ms": p * 600} for p in (0, 99, 100, 970, 1000)])
    funnel = rows.withColumn("bucket", marts.decile(F.col("completion_pct")))
    got = {r["session_id"]: (r["completion_pct"], r["bucket"]) for r in funnel.collect()}
    for name in ("no_runtime", "zero_runtime", "unknown_title"):
        assert got[name] == (None, None)
    assert got["past_end"] == (Decimal("1.000"), 9)
    assert [got[f"p{p}"][1] for p in (0, 99, 100, 970, 1000)] == [0, 0, 1, 9, 9]


def test_first_known_key_skips_nulls(spark, make_events):
    row = sessions(make_events, spark, {"device_key": None}, {"device_key": 5}, {"device_key": 6}).first()
    assert row["device_key"] == 5


def test_counts_survive_missing_types(spark, make_events):
    row = sessions(make_events, spark, {"event_type": "pause"}, {"event_type": None}, {"event_type": "seek"},
                   extra=True).first()
    assert (row["pause_count"], row["seek_count"], row["was_completed"]) == (1, 1, False)
    assert row["play_resume_count"] == 0


def test_late_event_moves_the_session(spark, make_events, path):
    build = lambda *r: sessions(make_events, spark, *r)
    facts.store_fact_sessions(build({"event_timestamp": at("2024-01-11 00:10:00")}), path)
    facts.store_fact_sessions(build({"event_timestamp": at("2024-01-11 00:10:00")},
                                    {"event_timestamp": at("2024-01-10 23:59:00")}), path)
    rows = tables.read_table(spark, path).collect()
    assert [(r["session_id"], str(r["session_start_date"])) for r in rows] == [("s1", "2024-01-10")]
    assert not (tables.Files(spark, path).exists(f"{path}/session_start_date=2024-01-11"))


def test_unresolved_keys_stay(spark, make_events):
    s = sessions(make_events, spark, {"title_key": None}, {"session_id": "s2"})
    mart = marts.content_engagement(s, titles(spark, *TITLE_ROWS))
    assert {r["title_key"]: r["sessions_count"] for r in mart.collect()} == {None: 1, 1: 1}


def test_genres_are_trimmed_and_sum_to_100(spark, make_events):
    s = sessions(make_events, spark, {}, {"event_timestamp": T0 + 10 * M})
    rows = {r["genre"]: r["pct_of_day"] for r in marts.genre_mix(s, titles(spark, *TITLE_ROWS)).collect()}
    assert rows == {"Action": Decimal("50.00"), "Drama": Decimal("50.00")}


def test_empty_day_is_cleared(spark, make_events, path):
    s = sessions(make_events, spark, {}).withColumn("customer_key", F.lit(1).cast("bigint"))
    day = dt.date(2024, 1, 10)
    facts.store_fact_daily(facts.build_fact_daily(s, day), path, [day])
    assert tables.read_table(spark, path).count() == 1
    schema = tables.read_table(spark, path).schema
    facts.store_fact_daily(facts.build_fact_daily(s.where("false"), day), path, [day])
    assert tables.read_table(spark, path, schema).count() == 0


def test_empty_mart_panels(spark, make_events):
    s = sessions(make_events, spark, {}).where("false")
    mart = marts.content_engagement(s, titles(spark, *TITLE_ROWS))
    assert reports.panel("content_engagement_daily", mart).count() == 0


def test_scd1(spark):
    ddl = "nk string, a int"
    first = dims.upsert_scd1(None, spark.createDataFrame([("b", 1), ("a", 1), ("z", 1)], ddl), "nk", "key")
    second = dims.upsert_scd1(first, spark.createDataFrame([("b", 2), ("c", None), ("0", 3)], ddl), "nk", "key")
    got = {r["nk"]: (r["key"], r["a"]) for r in second.collect()}
    assert got == {"a": (1, 1), "b": (2, 2), "z": (3, 1), "0": (4, 3), "c": (5, None)}
    third = dims.upsert_scd1(second, spark.createDataFrame([("b", 2), ("c", None), ("0", 3)], ddl), "nk", "key")
    assert {r["nk"]: (r["key"], r["a"]) for r in third.collect()} == got


def test_one_device_one_key(spark):
    ddl = ("device_id string, device_version_id string, device_type string, platform string, device_model string, "
           "os_version string, app_version string, is_deprecated boolean")
    reg = spark.createDataFrame([("d1", "d1_v0", "tv", "x", "m1", "1", "1", False),
                                 ("d1", "d1_v1", "tv", "x", "m2", "2", "2", False)], ddl)
    dev = dims.build_dim_device(reg)
    assert dev.count() == 1
    ver = dims.build_dim_device_version(reg, dev)
    assert ver.count() == 2 and {r["device_key"] for r in ver.collect()} == {1}


def test_dim_date(spark):
    d = dims.build_dim_date(spark)
    row = d.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("date_key").alias("k"),
                F.count_if(F.col("is_premiere_friday") != (F.col("day_name") == "Friday")).alias("bad")).first()
    assert (row["n"], row["k"], row["bad"]) == (1461, 1461, 0)


def test_force_closed(spark, make_events):
    e = keyed(make_events, {"session_id": "open"}, {"session_id": "done", "event_type": "exit"})
    flags = facts.ended_flag(e)
    closed = facts.force_closed(flags, F.lit(T0 + dt.timedelta(hours=25)))
    assert {r["session_id"]: r["was_force_closed"] for r in closed.collect()} == {"open": True, "done": False}
    assert facts.force_closed(flags, F.lit(T0 + dt.timedelta(hours=23))).where("was_force_closed").count() == 0


def test_peak_concurrency(spark):
    def day(d, h, m=0):
        return at(f"2024-01-{d:02d} {h:02d}:{m:02d}:00")
    s = spark.createDataFrame([(day(1, 22), day(2, 3)), (day(1, 23), day(2, 1)), (day(2, 2), day(2, 4)),
                               (day(2, 12), day(2, 12))],
                              "session_start_ts timestamp, session_end_ts timestamp")
    assert {str(r["day"]): r["peak_sessions"] for r in reports.peak_concurrency(s).collect()} == {
        "2024-01-01": 2, "2024-01-02": 2}


def test_position_drops(spark, make_events):
    e = make_events(*[{"event_timestamp": T0 + i * M, "event_type": t, "position_ms": p} for i, (t, p) in enumerate(
        [("play", 0), ("pause", 50), ("resume", 40), ("seek", 10), ("play", 20), ("seek", 5), ("play", 4)])])
    for hot in (None, 2):
        got = {r["event_id"] for r in quality.position_drops(e, hot_rows=hot).collect()}
        assert got == {"e2", "e6"}


def test_checks_fail_on_bad_facts(spark, make_events):
    s = sessions(make_events, spark, {})
    bad = s.withColumn("session_end_ts", F.col("session_start_ts") - F.expr("interval 1 second"))
    assert not quality.check_end_after_start({"fact_sessions": bad}).first()["passed"]
    assert quality.check_end_after_start({"fact_sessions": s}).first()["passed"]
    genre = spark.createDataFrame([("2024-01-01", 100.0), ("2024-01-02", 50.0)], "engagement_date string, pct_of_day double")
    row = quality.check_genre_pct({"genre_mart": genre}).first()
    assert not row["passed"] and row["observed"] == "1"


def test_gate_raises(spark):
    import pytest

    from viewtide.sources.metrics import CheckFailed, assert_checks
    m = spark.createDataFrame([(10, 5, 33.333, 1.0)],
                              "raw_count bigint, quarantine_count bigint, quarantine_pct double, lag_p99_seconds double")
    with pytest.raises(CheckFailed, match="quarantine_pct"):
        assert_checks(quality.batch_gate(m))
    assert_checks(quality.batch_gate(m, max_quarantine_pct=50))


def test_compare_sees_missing_rows_and_null_keys(spark):
    a = spark.createDataFrame([(None, 1), (1, 1), (2, 2)], "k int, n int")
    b = spark.createDataFrame([(None, 2), (2, 2), (3, 1)], "k int, n int")
    from viewtide.operators.joins import compare
    assert {(r["k"], r["status"]) for r in compare(a, b, ["k"], ["n"]).collect()} == {
        (None, "differs"), (1, "only_left"), (3, "only_right")}
