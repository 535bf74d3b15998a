"""Cases that the test tables do not hold: midnight, dead hours, shrinking sessions, repeated keys."""

import datetime as dt

from conftest import at

from viewtide.plans import dims, facts, quality, reports
from viewtide.sources import tables


def test_peak_concurrency_around_midnight(spark):
    spans = [("2024-01-01 10:00:00", "2024-01-01 23:59:59"), ("2024-01-03 09:00:00", "2024-01-06 00:00:00"),
             ("2024-01-03 09:00:00", "2024-01-03 09:00:00"), ("2024-01-06 00:00:00", "2024-01-06 01:00:00")]
    df = spark.createDataFrame([(at(a), at(b)) for a, b in spans], "session_start_ts timestamp, session_end_ts timestamp")
    got = {str(r["day"]): r["peak_sessions"] for r in reports.peak_concurrency(df).collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 0, "2024-01-03": 2, "2024-01-04": 1, "2024-01-05": 1, "2024-01-06": 2}


def test_dead_hours_are_anomalies(spark):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    hours = [start + dt.timedelta(hours=h) for h in range(24 * 29)]
    dead = start + dt.timedelta(days=21, hours=5)
    df = spark.createDataFrame([(h,) for h in hours if h != dead for _ in range(4)], "t timestamp")
    rows = quality.volume_anomalies(df, "t").collect()
    got = {r["hour_start"].replace(tzinfo=dt.timezone.utc): (r["rows"], r["baseline"], r["deviation"]) for r in rows}
    assert got == {dead: (0, 4.0, -1.0)}
    later = df.where("t < '2024-01-29'")
    assert quality.volume_anomalies(later, "t", tolerance=0.2).count() == 1


def test_recomputed_session_replaces_a_longer_one(spark, path):
    def session(end):
        return spark.createDataFrame([("s", at(end), dt.date(2024, 1, 1))],
                                     "session_id string, session_end_ts timestamp, session_start_date date")

    facts.store_fact_sessions(session("2024-01-01 12:00:00"), path)
    facts.store_fact_sessions(session("2024-01-01 11:00:00"), path)
    assert [r["session_end_ts"].hour for r in tables.read_table(spark, path).collect()] == [11]


def test_repeated_natural_key_gets_one_surrogate(spark):
    ddl = "nk string, v int"
    first = dims.upsert_scd1(None, spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], ddl), "nk", "k")
    assert sorted((r["k"], r["nk"]) for r in first.collect()) == [(1, "a"), (2, "b")]
    again = dims.upsert_scd1(first, spark.createDataFrame([("a", 7), ("a", 7), ("c", 1), ("c", 2)], ddl), "nk", "k")
    assert sorted((r["k"], r["nk"]) for r in again.collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_seasons(spark):
    got = {r["month"]: r["season"] for r in dims.build_dim_date(spark).select("month", "season").distinct().collect()}
    assert [got[m] for m in (12, 1, 2, 3, 5, 6, 8, 9, 11)] == ["Winter"] * 3 + ["Spring"] * 2 + ["Summer"] * 2 + ["Fall"] * 2


def test_failed_checks_stop_the_mart(spark, path):
    import pytest

    from viewtide.plans import marts
    from viewtide.sources.metrics import CheckFailed

    failed = spark.createDataFrame([("rows", False, "0", ">= 1")], "check string, passed boolean, observed string, expected string")
    with pytest.raises(CheckFailed):
        marts.build_mart("genre_mix_daily", None, {"dim_title": None}, path, checks=failed)
    assert not tables.table_exists(spark, path)


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_checks_read_their_input_once(spark, path):
    spark.range(100).selectExpr("id as raw_count", "cast(id as double) as quarantine_pct", "1 as pct_of_day", "'g' as genre",
                                "date'2024-01-01' as engagement_date").write.parquet(path)
    df = spark.read.parquet(path)
    assert scans(quality.batch_gate(df)) == 1
    found = quality.mart_tests({"genre_mart": df})
    assert scans(found) == 1
    assert {r["check"]: (r["passed"], r["observed"]) for r in found.collect()} == {
        "genre_mart.engagement_date_not_null": (True, "0"), "genre_mart.genre_not_null": (True, "0"),
        "genre_mart.pct_of_day_in_range": (True, "0"), "genre_mart_unique_engagement_date_genre": (False, "1")}


def test_no_rate_ceiling_by_default():
    from viewtide.streaming.landing import source_limits

    assert source_limits("kafka") == {} and source_limits("parquet", max_files=3) == {"maxFilesPerTrigger": "3"}
