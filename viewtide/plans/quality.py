"""Data-quality checks. Each returns rows ``check, passed, observed, expected``.

A check reduces its tables to a few numbers inside Spark; nothing is collected. :func:`run_all` unions the checks that
apply to the tables at hand.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide import schema
from viewtide.functions.scalars import count_where, date_key
from viewtide.operators.aggregates import percentiles, unpivot_row
from viewtide.operators.joins import compare
from viewtide.operators.ordered import Ordered, previous
from viewtide.plans.facts import Roles
from viewtide.plans.raw import REASON

Tables = Mapping[str, DataFrame]


def verdict(row: DataFrame, name: str, passed: Column, observed: Column, expected: Column | str) -> DataFrame:
    """Turn one-row numbers into a check row."""
    want = F.lit(expected) if isinstance(expected, str) else expected.cast("string")
    return row.select(F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"),
                      observed.cast("string").alias("observed"), want.alias("expected"))


def verdicts(row: DataFrame, *checks: tuple[str, Column, Column, str]) -> DataFrame:
    """Several check rows, (name, passed, observed, expected) each, from one row of numbers read once."""
    rows = [F.struct(F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"),
                     observed.cast("string").alias("observed"), F.lit(want).alias("expected"))
            for name, passed, observed, want in checks]
    return row.select(F.inline(F.array(*rows)))


def _none(df: DataFrame, name: str, bad: Column) -> DataFrame:
    """Passes when no row matches ``bad``."""
    row = df.agg(F.coalesce(count_where(bad), F.lit(0)).alias("n"))
    return verdict(row, name, F.col("n") == 0, F.col("n"), "0")


def _side(df: DataFrame, value: Column, side: str) -> DataFrame:
    return df.agg(F.coalesce(value, F.lit(0)).cast("bigint").alias(side)).withColumn("__k", F.lit(0))


def _equal(name: str, left: DataFrame, left_value: Column, right: DataFrame, right_value: Column) -> DataFrame:
    """Two one-row aggregates side by side."""
    row = _side(left, left_value, "a").join(F.broadcast(_side(right, right_value, "b")), "__k")
    return verdict(row, name, F.col("a") == F.col("b"), F.col("a"), F.col("b"))


def _n() -> Column:
    return F.count(F.lit(1))


# --- reconciliation between zones ---

def check_fact_equals_raw(t: Tables) -> DataFrame:
    return _equal("fact_rows_equal_raw_rows", t["fact_events"], _n(), t["raw"], _n())


def check_title_key_known(t: Tables) -> DataFrame:
    return _none(t["fact_events"], "event_title_key_known", F.col("title_key").isNull())


def check_customer_key_known(t: Tables) -> DataFrame:
    return _none(t["fact_events"], "event_customer_key_known", F.col("customer_key").isNull())


def check_date_key_resolves(t: Tables, table: str = "fact_events") -> DataFrame:
    known = F.broadcast(t["dim_date"].select("date_key"))  # calendar, one row per day
    return _none(t[table].join(known, "date_key", "left_anti"), f"{table}_date_key_resolves", F.lit(True))


def check_date_key_matches(t: Tables) -> DataFrame:
    return _none(t["fact_events"], "date_key_matches_event_date",
                 ~F.col("date_key").eqNullSafe(date_key(F.col("event_date"))))


def check_sessions_equal_event_sessions(t: Tables) -> DataFrame:
    return _equal("sessions_equal_distinct_event_sessions", t["fact_sessions"], _n(), t["fact_events"],
                  F.countDistinct("session_id"))


def check_completion_range(t: Tables, upper: float = 1.001) -> DataFrame:
    pct = F.col("completion_pct").cast("double")
    return _none(t["fact_sessions"], "completion_pct_in_range", (pct < 0) | (pct > upper))


def check_end_after_start(t: Tables) -> DataFrame:
    return _none(t["fact_sessions"], "session_end_not_before_start",
                 F.coalesce(F.col("session_end_ts") < F.col("session_start_ts"), F.lit(True)))


def check_watch_within_span(t: Tables) -> DataFrame:
    span = (F.unix_micros("session_end_ts") - F.unix_micros("session_start_ts")) / F.lit(1_000_000.0)
    return _none(t["fact_sessions"], "watch_within_session_span", F.col("watch_duration_seconds") > span + 1)


def check_mart_sessions(t: Tables) -> DataFrame:
    return _equal("mart_sessions_equal_fact_sessions", t["content_mart"], F.sum("sessions_count"),
                  t["fact_sessions"], _n())


def check_device_equals_content(t: Tables) -> DataFrame:
    return _equal("device_watch_equals_content_watch", t["device_mart"], F.sum("total_watch_seconds"),
                  t["content_mart"], F.sum("total_watch_seconds"))


def check_genre_pct(t: Tables, lo: float = 99.0, hi: float = 101.0) -> DataFrame:
    """Every day, not only one."""
    per_day = t["genre_mart"].groupBy("engagement_date").agg(F.sum("pct_of_day").cast("double").alias("p"))
    return _none(per_day, "genre_pct_sums_to_100_each_day", ~F.col("p").between(lo, hi))


def check_raw_share_of_landing(t: Tables, lo: float = 0.95) -> DataFrame:
    row = _side(t["raw"], _n(), "a").join(F.broadcast(_side(t["landing"], _n(), "b")), "__k")
    share = F.try_divide(F.col("a").cast("double"), F.col("b").cast("double"))
    return verdict(row, "raw_within_landing", share.between(lo, 1.0), F.round(share, 6), f"{lo}..1.0")


def customer_coverage(t: Tables) -> DataFrame:
    """How many event customers the customer table knows."""
    ids = t["raw"].select("customer_id").distinct()
    known = t["customers"].select("customer_id", F.lit(True).alias("known"))
    return ids.join(known, "customer_id", "left").agg(
        _n().alias("event_customers"), count_where(F.col("known")).alias("known_customers"),
        count_where(F.col("known").isNull()).alias("unknown_customers"))


def title_coverage(t: Tables) -> DataFrame:
    known = F.count("title_key")
    return t["fact_events"].agg(_n().alias("events"), known.alias("events_with_title"),
                                F.try_divide(known * 100.0, _n()).cast("double").alias("pct_with_title"))


# --- audit of single tables ---

def check_no_duplicates(t: Tables, table: str = "raw", key: str = "event_id") -> DataFrame:
    """Rows minus distinct keys, from counts per key, so one key with many copies combines map-side."""
    per_key = t[table].groupBy(key).agg(_n().alias("n"))
    row = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
    return verdict(row, f"{table}_no_duplicate_{key}", F.col("n") == 0, F.col("n"), "0")


def check_leaks(t: Tables, pattern: str = schema.TITLE_ID_PATTERN) -> DataFrame:
    """Bad rows that reached raw, per rule."""
    future = F.unix_micros("event_timestamp") > F.unix_micros("server_received_at") + schema.CLOCK_SKEW_SECONDS * 10**6
    row = t["raw"].agg(count_where(future).alias("leaked_future"),
                       count_where(~F.col("title_id").rlike(pattern)).alias("leaked_bad_title"),
                       count_where(F.col("event_id").isNull()).alias("leaked_null_id"))
    return _zero_columns(row)


def _zero_columns(row: DataFrame) -> DataFrame:
    long = unpivot_row(row, row.columns, "check", "n")
    return long.select("check", (F.col("n") == 0).alias("passed"), F.col("n").cast("string").alias("observed"),
                       F.lit("0").alias("expected"))


def check_orphans(t: Tables) -> DataFrame:
    return _zero_columns(t["fact_events"].agg(*[count_where(F.col(f"{d}_key").isNull()).alias(f"orphan_{d}")
                                                for d in ("title", "device", "customer")]))


def check_orphan_rate(t: Tables, per_mille: int = 1) -> DataFrame:
    """Rows without each key stay below ``per_mille`` thousandths of the fact; no orphans always pass."""
    dims = ("title", "device", "customer")
    row = t["fact_events"].agg(_n().alias("rows"), *[count_where(F.col(f"{d}_key").isNull()).alias(d) for d in dims])
    return verdicts(row, *[(f"orphan_rate_{d}", (F.col(d) == 0) | (F.col(d) * 1000 < F.col("rows") * per_mille),
                            F.concat_ws(" of ", F.col(d).cast("string"), F.col("rows").cast("string")),
                            f"< {per_mille} per mille") for d in dims])


def check_positions(t: Tables) -> DataFrame:
    return _none(t["raw"], "position_not_negative", F.col("position_ms") < 0)


def check_mart_ratio(t: Tables, low: float = 0.01, high: float = 1.0) -> DataFrame:
    """The content mart has between ``low`` and ``high`` rows for each session it was built from."""
    row = _side(t["content_mart"], _n(), "m").join(F.broadcast(_side(t["fact_sessions"], _n(), "f")), "__k")
    return verdicts(row, ("mart_rows_per_session", F.col("m").between(F.ceil(F.col("f") * low), F.col("f") * high),
                          F.concat_ws(" of ", F.col("m").cast("string"), F.col("f").cast("string")), f"{low} .. {high}"))


def check_commits(table: DataFrame, as_of: Column, gap_seconds: int = 300, lag_seconds: int = 1800) -> DataFrame:
    """From the file times of a stored table: the longest gap between two writes, and the age of the newest one."""
    times = table.select(F.unix_seconds(F.col("_metadata.file_modification_time")).alias("at")).distinct()  # one a file
    gaps = times.withColumn("gap", F.col("at") - F.lag("at").over(Window.orderBy("at")))
    row = gaps.agg(F.coalesce(F.max("gap"), F.lit(0)).alias("commit_gap"), (F.unix_seconds(as_of) - F.max("at")).alias("snapshot_lag"))
    return verdicts(row, *[(c, F.col(c) <= limit, F.col(c), f"<= {limit} s")
                           for c, limit in (("commit_gap", gap_seconds), ("snapshot_lag", lag_seconds))])


def check_session_sanity(t: Tables) -> DataFrame:
    pct, watch = F.col("completion_pct"), F.col("watch_duration_seconds")
    return _zero_columns(t["fact_sessions"].agg(
        count_where(watch < 0).alias("negative_watch"),
        count_where((pct < 0) | (pct > 1)).alias("bad_completion_pct"),
        count_where(F.col("session_end_ts") < F.col("session_start_ts")).alias("end_before_start"),
        count_where(watch > 86400).alias("watch_over_24h")))


def mart_mismatches(t: Tables) -> DataFrame:
    """Mart rows against a recomputation from the fact; missing rows count on either side."""
    recomputed = (t["fact_sessions"].groupBy(F.col("session_start_date").alias("engagement_date"), "title_key")
                  .agg(_n().alias("sessions_count")))
    return compare(t["content_mart"], recomputed, ["engagement_date", "title_key"], ["sessions_count"])


def check_mart_recompute(t: Tables) -> DataFrame:
    return _none(mart_mismatches(t), "mart_equals_recomputation", F.lit(True))


def check_rate_bounds(t: Tables) -> DataFrame:
    rate = F.col("completion_rate")
    return _none(t["content_mart"], "completion_rate_in_range", (rate < 0) | (rate > 1))


def landing_freshness(t: Tables) -> DataFrame:
    future = F.unix_micros("event_timestamp") > F.unix_micros("server_received_at") + schema.CLOCK_SKEW_SECONDS * 10**6
    return t["landing"].agg(_n().alias("landing_rows"), F.max("server_received_at").alias("latest_arrival"),
                            count_where(future).alias("future_dated"))


# --- gate and scorecard ---

def batch_metrics(raw: DataFrame, bad: DataFrame, exact_lag: bool = True) -> DataFrame:
    """Rows, quarantine share and p99 lag of a batch in one row."""
    lag = raw.select((F.unix_micros("server_received_at") - F.unix_micros("event_timestamp")).alias("lag"))
    if exact_lag:
        p99 = percentiles(lag, [], "lag", {"p99": 0.99})
    else:
        p99 = lag.agg(F.percentile_approx("lag", 0.99).alias("p99"))
    one = F.lit(0).alias("__k")
    row = (_side(raw, _n(), "raw_count").join(F.broadcast(_side(bad, _n(), "quarantine_count")), "__k")
           .join(F.broadcast(p99.select("p99", one)), "__k", "left").drop("__k"))
    total = F.col("raw_count") + F.col("quarantine_count")
    return row.select(
        "raw_count", "quarantine_count",
        F.coalesce(F.round(F.try_divide(F.col("quarantine_count") * F.lit(100.0), total).cast("double"), 3),
                   F.lit(0.0)).alias("quarantine_pct"),
        F.coalesce(F.round(F.col("p99") / 1_000_000.0, 1), F.lit(0.0)).alias("lag_p99_seconds"))


def batch_gate(metrics: DataFrame, min_rows: int = 1, max_quarantine_pct: float = 5.0) -> DataFrame:
    """The two gating checks of a batch; ``assert_checks`` raises when one fails."""
    rows, share = F.col("raw_count"), F.col("quarantine_pct")
    return verdicts(metrics, ("raw_count", rows >= min_rows, rows, f">= {min_rows}"),
                    ("quarantine_pct", share <= max_quarantine_pct, share, f"<= {max_quarantine_pct}"))


def scorecard(t: Tables, metrics: DataFrame, as_of: Column) -> DataFrame:
    """Daily overview: 24-h volume, quarantine share, orphans, newest mart day, trends from the run metrics."""
    day_ago = as_of - F.expr("interval 1 day")
    recent = (F.col("server_received_at") >= day_ago) & (F.col("server_received_at") < as_of)
    k = F.lit(0).alias("__k")
    parts = [
        t["raw"].agg(count_where(recent).alias("raw_24h")),
        t["quarantine"].agg(count_where(recent).alias("quarantined_24h")),
        t["fact_events"].agg(count_where(F.col("title_key").isNull()).alias("orphan_titles"),
                             count_where(F.col("device_key").isNull()).alias("orphan_devices")),
        t["content_mart"].agg(F.max("engagement_date").alias("latest_mart_day")),
        metrics.agg(
            F.avg(F.when((F.col("metric_name") == "quarantine_pct")
                         & (F.col("recorded_at") >= as_of - F.expr("interval 7 days")), F.col("metric_value")))
            .alias("quarantine_pct_7d"),
            F.max(F.when((F.col("metric_name") == "lag_p99_seconds") & (F.col("recorded_at") >= day_ago),
                         F.col("metric_value"))).alias("lag_p99_24h")),
    ]
    keyed = [p.select("*", k) for p in parts]  # five one-row aggregates
    row = reduce(lambda a, b: a.join(F.broadcast(b), "__k"), keyed).drop("__k")
    total = F.col("raw_24h") + F.col("quarantined_24h")
    pct = F.round(F.try_divide(F.col("quarantined_24h") * F.lit(100.0), total).cast("double"), 2)
    return row.select("raw_24h", "quarantined_24h", F.coalesce(pct, F.lit(0.0)).alias("quarantine_pct"),
                      F.round("quarantine_pct_7d", 3).alias("quarantine_pct_7d"),
                      F.round("lag_p99_24h", 1).alias("lag_p99_24h"), "orphan_titles", "orphan_devices",
                      "latest_mart_day")


# --- declarative column tests ---

def expect_not_null(df: DataFrame, table: str, col: str) -> DataFrame:
    return _none(df, f"{table}.{col}_not_null", F.col(col).isNull())


def expect_range(df: DataFrame, table: str, col: str, lo: float, hi: float) -> DataFrame:
    return _none(df, f"{table}.{col}_in_range", (F.col(col) < lo) | (F.col(col) > hi))


def expect_unique(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    repeated = df.groupBy(*cols).agg(_n().alias("n")).where(F.col("n") > 1)
    return _none(repeated, f"{table}_unique_{'_'.join(cols)}", F.lit(True))


# Tests of the four marts: columns without NULL, ranges, unique keys.
MART_TESTS: Mapping[str, tuple[Sequence[str], Sequence[tuple[str, float, float]], Sequence[str]]] = {
    "content_mart": (("engagement_date", "title_key"), (("completion_rate", 0, 1),),
                     ("engagement_date", "title_key")),
    "device_mart": (("engagement_date",), (("completion_rate", 0, 1),),
                    ("engagement_date", "device_type", "platform")),
    "genre_mart": (("engagement_date", "genre"), (("pct_of_day", 0, 100),), ("engagement_date", "genre")),
    "funnel_mart": (("engagement_date",), (("bucket", 0, 9),), ("engagement_date", "title_key", "bucket")),
}


def mart_tests(t: Tables) -> DataFrame:
    """Every test of a mart in one pass over it: its rows are counted per key first, then over all keys."""
    found = []
    for table, (required, ranges, unique) in MART_TESTS.items():
        if table not in t:
            continue
        bad = {f"{table}.{c}_not_null": F.col(c).isNull() for c in required}
        bad |= {f"{table}.{c}_in_range": (F.col(c) < lo) | (F.col(c) > hi) for c, lo, hi in ranges}
        names = [f"b{i}" for i in range(len(bad))]
        per_key = t[table].groupBy(*unique).agg(_n().alias("rows"), *[
            count_where(test).alias(n) for n, test in zip(names, bad.values())])
        row = per_key.agg(count_where(F.col("rows") > 1).alias("repeated"), *[F.sum(n).alias(n) for n in names])
        counted = {**dict(zip(bad, names)), f"{table}_unique_{'_'.join(unique)}": "repeated"}
        found.append(verdicts(row, *[(check, F.coalesce(n, F.lit(0)) == 0, F.coalesce(n, F.lit(0)), "0")
                                     for check, n in ((check, F.col(n)) for check, n in counted.items())]))
    return reduce(DataFrame.unionByName, found)


# --- event stream properties ---

def required_fields(lines: DataFrame, payload: str, fields: Mapping[str, str]) -> DataFrame:
    """Per required JSON field: rows without it and rows whose value does not have the type."""
    doc = F.from_json(F.col(payload), "map<string,string>")
    aggs, names = [], []
    for field, kind in fields.items():
        value = F.col("__doc")[field]
        aggs += [count_where(value.isNull()).alias(f"m_{field}"),
                 count_where(value.isNotNull() & value.try_cast(kind).isNull()).alias(f"b_{field}")]
        names.append(F.struct(F.lit(field).alias("field"), F.col(f"m_{field}").alias("missing"),
                              F.col(f"b_{field}").alias("mistyped")))
    return lines.select(doc.alias("__doc")).agg(*aggs).select(F.inline(F.array(*names)))


def enum_violations(events: DataFrame, types: Sequence[str], version: int = schema.SCHEMA_VERSION) -> DataFrame:
    known = F.coalesce(F.col("event_type").isin(list(types)), F.lit(False))
    return _zero_columns(events.agg(count_where(~known).alias("invalid_event_type"),
                                    count_where(~F.col("schema_version").eqNullSafe(F.lit(version)))
                                    .alias("invalid_schema_version")))


def session_sequencing(events: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Sessions that do not open with a play at 0 or do not close with an end event."""
    at = F.struct("event_timestamp", "event_id")
    ends = events.groupBy("session_id").agg(
        F.min_by(F.struct("event_type", "position_ms"), at).alias("first"),
        F.max_by("event_type", at).alias("last"))

    def is_(c: Column, types: Sequence[str]) -> Column:
        return F.coalesce(c.isin(list(types)), F.lit(False))

    return ends.agg(
        _n().alias("sessions"),
        count_where(~is_(F.col("first.event_type"), roles.play)).alias("first_not_play"),
        count_where(~F.col("first.position_ms").eqNullSafe(F.lit(0))).alias("first_not_at_zero"),
        count_where(~is_(F.col("last"), roles.end)).alias("last_not_end"))


def position_drops(events: DataFrame, roles: Roles = Roles(), hot_rows: int | None = None) -> DataFrame:
    """Events other than seeks whose position is below the one before them in the session."""
    seen = Ordered.split(events, ["session_id"], ["event_timestamp", "event_id"], hot_rows=hot_rows).scan(
        __prev=previous("position_ms")).df
    drop = (~F.col("event_type").isin(list(roles.seek))
            & (F.col("position_ms") < F.coalesce(F.col("__prev"), F.lit(0))))
    return seen.where(drop).withColumnRenamed("__prev", "previous_position_ms")


def fk_violations(events: DataFrame, titles: DataFrame, customers: DataFrame, title_nk: str,
                  customer_nk: str) -> DataFrame:
    """Events whose title or customer is unknown."""
    t = titles.select(F.col(title_nk).alias("title_id"), F.lit(True).alias("__t"))
    c = customers.select(F.col(customer_nk).alias("customer_id"), F.lit(True).alias("__c"))
    by_pair = events.groupBy("title_id", "customer_id").agg(_n().alias("n"))
    joined = by_pair.join(t, "title_id", "left").join(c, "customer_id", "left")
    return _zero_columns(joined.agg(
        F.coalesce(F.sum(F.when(F.col("__t").isNull(), F.col("n"))), F.lit(0)).alias("unknown_title"),
        F.coalesce(F.sum(F.when(F.col("__c").isNull(), F.col("n"))), F.lit(0)).alias("unknown_customer")))


def hourly_distribution(events: DataFrame) -> DataFrame:
    """Mean events of the peak hours (19-21) against the night hours (0-5), over hours that have events."""
    by_hour = events.groupBy(F.hour("event_timestamp").alias("h")).agg(_n().alias("n"))
    row = by_hour.agg(F.avg(F.when(F.col("h").between(19, 21), F.col("n"))).alias("peak"),
                      F.avg(F.when(F.col("h").between(0, 5), F.col("n"))).alias("night"))
    holds = F.col("peak").isNull() | F.col("night").isNull() | (F.col("peak") >= F.col("night"))
    return verdict(row, "peak_hours_not_below_night", holds, F.round("peak", 3), F.round("night", 3))


def event_profile(events: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Volume, actives and rates of completed and exited sessions."""
    per_session = events.groupBy("session_id").agg(
        _n().alias("n"), F.bool_or(F.col("event_type").isin(list(roles.complete))).alias("completed"),
        F.bool_or(F.col("event_type").isin([e for e in roles.end if e not in roles.complete] or [""]))
        .alias("exited"))
    k = F.lit(0).alias("__k")
    sessions = per_session.agg(F.sum("n").alias("events"), _n().alias("sessions"),
                               count_where(F.col("completed")).alias("completed"),
                               count_where(F.col("exited")).alias("exited")).select("*", k)
    people = events.agg(F.countDistinct("customer_id").alias("customers"),
                        F.countDistinct("title_id").alias("titles"),
                        F.countDistinct("device_id").alias("devices")).select("*", k)
    row = sessions.join(F.broadcast(people), "__k").drop("__k")
    return row.withColumns({
        "completion_rate": F.try_divide(F.col("completed").cast("double"), F.col("sessions").cast("double")),
        "exit_rate": F.try_divide(F.col("exited").cast("double"), F.col("sessions").cast("double"))})


# --- thresholds of the design ---

def graded(name: str, value: Column, warn: float, alert: float) -> tuple[str, Column, Column, str]:
    """A value against a warning and an alert limit, for :func:`verdicts`."""
    level = F.when(value >= alert, "alert").when(value >= warn, "warn").otherwise("ok")
    return name, level == "ok", F.concat_ws(" ", level, F.round(value, 6).cast("string")), f"< {warn}"


def batch_thresholds(landing_marked: DataFrame, deduplicated: DataFrame, required: Sequence[str]) -> DataFrame:
    """Deduplication ratio, quarantine share and schema conformity of a batch.

    ``landing_marked`` carries the quarantine reason of every input row.
    """
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    side = landing_marked.agg(_n().alias("rows"), F.count(REASON).alias("bad"),
                              count_where(complete).alias("complete")).withColumn("__k", F.lit(0))
    row = side.join(F.broadcast(_side(deduplicated, _n(), "kept")), "__k").drop("__k")

    def ratio(a: Column, b: Column) -> Column:
        return F.try_divide(a.cast("double"), b.cast("double"))

    share = ratio(F.col("complete"), F.col("rows"))
    return verdicts(row, graded("dedup_ratio", ratio(F.col("rows") - F.col("bad"), F.col("kept")), 1.05, 1.10),
                    graded("quarantine_rate", ratio(F.col("bad"), F.col("rows")), 0.01, 0.05),
                    ("schema_conformity", share > 0.999, F.round(share, 6), "> 0.999"))


def volume_anomalies(events: DataFrame, ts_col: str, tolerance: float = 0.5, weeks: int = 4) -> DataFrame:
    """Hours whose row count differs by more than the tolerance from the mean of the same hour of the week in the
    ``weeks`` weeks before, as far as the data reaches.

    The counts shrink to one row per hour first. Every hour between the first and the last is there, so an hour without
    rows is reported itself and lowers the baseline of later ones.
    """
    counts = events.where(F.col(ts_col).isNotNull()).groupBy(F.date_trunc("hour", ts_col).alias("hour_start")).agg(
        _n().alias("rows"))
    span = counts.agg(F.min("hour_start").alias("lo"), F.max("hour_start").alias("hi")).where("lo is not null")
    every = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour"))).alias("hour_start"))
    hours = every.join(counts, "hour_start", "left").fillna(0, ["rows"])
    earlier = hours.select(F.explode(F.sequence(F.lit(1), F.lit(weeks))).alias("w"), "hour_start", "rows").select(
        (F.col("hour_start") + F.make_dt_interval(days=F.col("w") * 7)).alias("hour_start"),
        F.col("rows").alias("earlier_rows"))
    base = earlier.groupBy("hour_start").agg(F.avg("earlier_rows").alias("baseline"))
    return (hours.join(base, "hour_start")
            .withColumn("deviation", F.try_divide(F.col("rows") - F.col("baseline"), F.col("baseline")))
            .where(F.abs("deviation") > tolerance))


# Lag targets in seconds.
LAG_TARGETS = {"p50": (0.50, 5.0), "p95": (0.95, 30.0), "p99": (0.99, 120.0)}


def lag_sla(events: DataFrame, targets: Mapping[str, tuple[float, float]] = LAG_TARGETS) -> DataFrame:
    lag = events.select((F.unix_micros("server_received_at") - F.unix_micros("event_timestamp")).alias("lag"))
    row = percentiles(lag, [], "lag", {n: p for n, (p, _) in targets.items()})
    return verdicts(row, *[(f"lag_{n}", F.col(n) / 1_000_000.0 < limit, F.round(F.col(n) / 1_000_000.0, 3), f"< {limit}")
                           for n, (_, limit) in targets.items()])


def zone_score(checks: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Weighted share of passed checks, 0-100: below 70 halts, below 90 flags. Unlisted checks weigh 1."""
    weight = F.lit(1.0)
    if weights:
        mapped = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        weight = F.coalesce(mapped[F.col("check")], F.lit(1.0))
    row = checks.agg((F.sum(F.when(F.col("passed"), weight).otherwise(F.lit(0.0))) * 100
                      / F.sum(weight)).alias("score"))
    action = F.when(F.col("score") < 70, "halt").when(F.col("score") < 90, "flag").otherwise("green")
    return row.select(F.round("score", 3).alias("score"), action.alias("action"))


def check_within(name: str, left: DataFrame, left_value: Column, right: DataFrame, right_value: Column,
                 tolerance: float) -> DataFrame:
    """Two totals that may differ by a relative tolerance."""
    row = _side(left, left_value, "a").join(F.broadcast(_side(right, right_value, "b")), "__k")
    off = F.abs(F.col("a") - F.col("b")) / F.greatest(F.abs("b"), F.lit(1))
    return verdict(row, name, off <= tolerance, F.col("a"), F.col("b"))


def check_fact_vs_raw(t: Tables, tolerance: float = 0.02) -> DataFrame:
    return check_within("fact_rows_near_raw_rows", t["fact_events"], _n(), t["raw"], _n(), tolerance)


def check_mart_vs_fact(t: Tables, tolerance: float = 0.005) -> DataFrame:
    return check_within("mart_sessions_near_fact_sessions", t["content_mart"], F.sum("sessions_count"),
                        t["fact_sessions"], _n(), tolerance)


def check_daily_watch(t: Tables) -> DataFrame:
    return _equal("daily_watch_equals_session_watch", t["fact_daily"], F.sum("total_watch_seconds"),
                  t["fact_sessions"], F.sum("watch_duration_seconds"))


def check_event_session_unique(t: Tables) -> DataFrame:
    return expect_unique(t["fact_events"], "fact_events", ["event_id", "session_id"])


def smoke_checks(t: Tables, retention: DataFrame, genre_shares: DataFrame) -> DataFrame:
    viewers = t["content_mart"].agg(F.coalesce(F.sum("distinct_viewers"), F.lit(0)).alias("n"))
    rows = t["landing"].agg(_n().alias("n"))
    per_day = genre_shares.groupBy("engagement_date").agg(F.sum("share_of_watch_pct").cast("double").alias("s"))
    return (verdict(viewers, "distinct_viewers_positive", F.col("n") > 0, F.col("n"), "> 0")
            .unionByName(verdict(rows, "input_rows_positive", F.col("n") > 0, F.col("n"), "> 0"))
            .unionByName(_none(per_day, "genre_share_sums_to_one", F.abs(F.col("s") - 1.0) > 0.01))
            .unionByName(_none(retention, "retention_rate_in_range",
                               (F.col("retention_rate") < 0) | (F.col("retention_rate") > 1))))


def vendor_load(current: DataFrame, prior: DataFrame, key: str, max_delta: float = 0.2) -> DataFrame:
    """Key uniqueness, missing keys and row-count change of a vendor snapshot against the one before."""
    repeated = current.where(F.col(key).isNotNull()).groupBy(key).agg(_n().alias("n")).where(F.col("n") > 1)
    return (_none(repeated, f"{key}_unique", F.lit(True))
            .unionByName(_none(current, f"{key}_not_null", F.col(key).isNull()))
            .unionByName(check_within("row_count_delta", current, _n(), prior, _n(), max_delta)))


def check_dau(t: Tables) -> DataFrame:
    """Distinct customers of each day in the daily fact against the sessions of that day."""
    a = t["fact_daily"].groupBy("engagement_date").agg(F.countDistinct("customer_key").alias("dau"))
    b = (t["fact_sessions"].groupBy(F.col("session_start_date").alias("engagement_date"))
         .agg(F.countDistinct("customer_key").alias("dau")))
    return _none(compare(a, b, ["engagement_date"], ["dau"]), "daily_customers_equal_dau", F.lit(True))


@dataclass(frozen=True)
class Check:
    needs: frozenset[str]
    build: Callable[[Tables], DataFrame]


RECONCILIATION: Sequence[Check] = tuple(Check(frozenset(needs.split()), build) for needs, build in (
    ("fact_events raw", check_fact_equals_raw),
    ("fact_events", check_title_key_known),
    ("fact_events", check_customer_key_known),
    ("fact_events dim_date", check_date_key_resolves),
    ("fact_events", check_date_key_matches),
    ("fact_sessions fact_events", check_sessions_equal_event_sessions),
    ("fact_sessions", check_completion_range),
    ("fact_sessions", check_end_after_start),
    ("fact_sessions", check_watch_within_span),
    ("content_mart fact_sessions", check_mart_sessions),
    ("device_mart content_mart", check_device_equals_content),
    ("genre_mart", check_genre_pct),
    ("fact_daily dim_date", lambda t: check_date_key_resolves(t, "fact_daily")),
))


def run_all(t: Tables, checks: Sequence[Check] = RECONCILIATION) -> DataFrame:
    """All checks whose tables are present, as one frame."""
    return reduce(DataFrame.unionByName, [c.build(t) for c in checks if c.needs <= set(t)])

