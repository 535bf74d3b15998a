"""Report queries over facts and marts. Every ordering ends in a unique tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.functions.scalars import count_where, epoch_seconds, exact_ratio
from viewtide.operators.aggregates import latest_day, percentiles, rollup_days, top_k
from viewtide.operators.joins import attach, by_list_member

DAY = "engagement_date"


def top_titles(mart: DataFrame, n: int = 10, since: Column | None = None) -> DataFrame:
    rows = mart if since is None else mart.where(F.col(DAY) >= since)
    total = rows.groupBy("tconst", "primary_title").agg(
        F.sum("total_watch_seconds").alias("total_watch_seconds"), F.sum("sessions_count").alias("sessions_count"))
    return top_k(total, "total_watch_seconds", ["tconst"], n)


def top_genres(mart: DataFrame, n: int = 10) -> DataFrame:
    total = mart.groupBy("genre").agg(F.sum("watch_seconds").alias("watch_seconds"))
    return top_k(total, "watch_seconds", ["genre"], n)


def device_breakdown(mart: DataFrame) -> DataFrame:
    total = mart.groupBy("device_type", "platform").agg(
        F.sum("sessions_count").alias("sessions_count"), F.sum("total_watch_seconds").alias("total_watch_seconds"))
    return total.orderBy(F.desc("total_watch_seconds"), "device_type", "platform")


def completion_by_type(sessions: DataFrame, titles: DataFrame) -> DataFrame:
    by_title = sessions.groupBy("title_key").agg(F.count(F.lit(1)).alias("n"),
                                                 count_where(F.col("was_completed")).alias("done"))
    return (attach(by_title, titles, "title_key", ["title_type"], "inner").groupBy("title_type")
            .agg(F.sum("n").alias("sessions"), F.sum("done").alias("completed"))
            .withColumn("completion_rate", exact_ratio(F.col("completed"), F.col("sessions"), 4, 3)))


def completion_by_genre(sessions: DataFrame, titles: DataFrame, genres: DataFrame, since: Column) -> DataFrame:
    """Mean completion per genre of the sessions that start at or after ``since``."""
    recent = sessions.where((F.col("session_start_ts") >= since) & F.col("was_completed").isNotNull())
    by_title = recent.groupBy("title_key").agg(F.sum("completion_pct").alias("pct"),
                                               F.count("completion_pct").alias("known"),
                                               F.count(F.lit(1)).alias("n"))
    named = attach(by_title, titles, "title_key", ["genres"], "inner")
    return (by_list_member(named, "genres", genres.select("genre_name"), "genre_name").groupBy("genre_name")
            .agg(F.sum("pct").alias("pct"), F.sum("known").alias("known"), F.sum("n").alias("sessions"))
            .select("genre_name", F.try_divide(F.col("pct").cast("double"), F.col("known").cast("double"))
                    .alias("avg_completion"), "sessions"))


def active_users(daily: DataFrame, as_of: Column) -> DataFrame:
    """Distinct customers active on the day before ``as_of`` and in the 7 and 30 days before it.

    Each customer is first reduced to the last active day, so the three counts need one shuffle.
    """
    last = (daily.where((F.col(DAY) < as_of) & F.col("customer_key").isNotNull())
            .groupBy("customer_key").agg(F.max(DAY).alias("last")))

    def within(days: int) -> Column:
        return count_where(F.col("last") >= F.date_sub(as_of, days))

    return last.agg(within(1).alias("dau"), within(7).alias("wau"), within(30).alias("mau"))


# Dashboard panels: columns shown, metric, tie-break.
PANELS: dict[str, tuple[Sequence[str], str, Sequence[str]]] = {
    "content_engagement_daily": (("primary_title", "title_type", "distinct_viewers", "sessions_count",
                                  "total_watch_seconds", "completion_rate"), "total_watch_seconds", ("title_key",)),
    "device_engagement_daily": (("device_type", "platform", "sessions_count", "distinct_viewers",
                                 "total_watch_seconds", "completion_rate"), "total_watch_seconds",
                                ("device_type", "platform")),
    "genre_mix_daily": (("genre", "watch_seconds", "pct_of_day"), "watch_seconds", ("genre",)),
    "title_completion_funnel": (("primary_title", "title_type", "bucket", "sessions_in_bucket"),
                                "sessions_in_bucket", ("title_key", "bucket")),
}


def panel(name: str, mart: DataFrame, day: str | None = None, n: int = 20) -> DataFrame:
    """A dashboard panel for the given or the newest day; no rows when the mart has none."""
    cols, metric, tie = PANELS[name]
    return top_k(latest_day(mart, DAY, day), metric, tie, n).select(*cols)


def most_engaged(daily: DataFrame, as_of: Column, days: int, n: int = 20) -> DataFrame:
    recent = daily.where((F.col(DAY) >= F.date_sub(as_of, days)) & (F.col(DAY) < as_of)
                         & F.col("customer_key").isNotNull())
    total = recent.groupBy("customer_key").agg(F.sum("total_watch_seconds").alias("watch_seconds"),
                                               F.sum("sessions_count").alias("sessions_count"))
    return top_k(total, "watch_seconds", ["customer_key"], n)


def watch_by(sessions: DataFrame, dim: DataFrame, key: str, col: str) -> DataFrame:
    by_key = sessions.groupBy(key).agg(F.sum("watch_duration_seconds").cast("bigint").alias("watch"),
                                       F.count(F.lit(1)).alias("n"))
    return attach(by_key, dim, key, [col]).groupBy(col).agg(F.sum("watch").alias("watch_seconds"),
                                                            F.sum("n").alias("sessions"))


def bitrate_by_platform(events: DataFrame, devices: DataFrame) -> DataFrame:
    named = attach(events.select("device_key", "bitrate_kbps"), devices, "device_key", ["platform"], "inner")
    counts = named.groupBy("platform").agg(F.count("bitrate_kbps").alias("events"),
                                           F.avg("bitrate_kbps").alias("avg_kbps"))
    spread = percentiles(named, ["platform"], "bitrate_kbps", {"p50_kbps": 0.5, "p90_kbps": 0.9})
    return counts.join(spread, "platform")


def premiere_lift(daily: DataFrame, dates: DataFrame) -> DataFrame:
    """Mean daily sessions and watch seconds on premiere Fridays against the other days."""
    per_day = daily.groupBy(DAY).agg(F.sum("sessions_count").alias("sessions"),
                                     F.sum("total_watch_seconds").alias("watch"))
    flag = F.broadcast(dates.select(F.col("full_date").alias(DAY), "is_premiere_friday"))  # one row per calendar day
    friday = F.col("is_premiere_friday")
    rows = per_day.join(flag, DAY).agg(
        F.avg(F.when(friday, F.col("sessions"))).alias("friday_sessions"),
        F.avg(F.when(~friday, F.col("sessions"))).alias("other_sessions"),
        F.avg(F.when(friday, F.col("watch"))).alias("friday_watch_seconds"),
        F.avg(F.when(~friday, F.col("watch"))).alias("other_watch_seconds"))
    return rows.withColumns({
        "sessions_lift": F.try_divide("friday_sessions", "other_sessions"),
        "watch_lift": F.try_divide("friday_watch_seconds", "other_watch_seconds")})


def counts_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def daily_totals(mart: DataFrame) -> DataFrame:
    return rollup_days(mart, DAY, ["sessions_count", "total_watch_seconds"])


def peak_concurrency(sessions: DataFrame) -> DataFrame:
    """Largest number of sessions open at once, per day; a session is open from its start to its end, both included.

    Start and end steps collapse to one row per second. The running sum works inside each day, and each day from the
    first start to the last end opens with the sessions left open by the days before; those that end in the last second
    of a day are gone at midnight. Days are one row each.
    """
    start, end = epoch_seconds(F.col("session_start_ts")), epoch_seconds(F.col("session_end_ts")) + 1
    steps = (sessions.select(F.inline(F.array(F.struct(start.alias("sec"), F.lit(1).alias("step")),
                                              F.struct(end.alias("sec"), F.lit(-1).alias("step")))))
             .groupBy("sec").agg(F.sum("step").alias("step"))
             .withColumn("day", F.to_date(F.timestamp_seconds("sec"))))
    inside = F.sum("step").over(Window.partitionBy("day").orderBy("sec").rowsBetween(Window.unboundedPreceding, 0))
    counted = steps.withColumn("inside", inside).groupBy("day").agg(
        F.sum("step").alias("net"), F.max("inside").alias("inside"), F.bool_or(F.col("sec") % 86400 == 0).alias("midnight"))
    days = sessions.agg(F.to_date(F.min("session_start_ts")).alias("lo"), F.to_date(F.max("session_end_ts")).alias("hi"))
    per_day = days.where("lo <= hi").select(F.explode(F.sequence("lo", "hi")).alias("day")).join(counted, "day", "left")
    carried = per_day.select("day", "inside", "midnight", F.coalesce(
        F.sum("net").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("open"))
    # A step at midnight is part of the running sum; otherwise the day starts with what was open.
    most = F.when(F.coalesce("midnight", F.lit(False)), F.col("inside")).otherwise(
        F.greatest(F.coalesce("inside", F.lit(0)), F.lit(0)))
    return carried.select("day", (F.col("open") + most).alias("peak_sessions"))


def agg_user_daily(daily: DataFrame) -> DataFrame:
    return daily.groupBy(DAY, "customer_key").agg(
        F.sum("total_watch_seconds").alias("total_watch_seconds"), F.sum("sessions_count").alias("sessions_count"),
        F.countDistinct("title_key").alias("distinct_titles_watched"))


def agg_country_daily(daily: DataFrame, customers: DataFrame) -> DataFrame:
    by_customer = daily.groupBy(DAY, "customer_key").agg(F.sum("total_watch_seconds").alias("watch"))
    named = attach(by_customer, customers, "customer_key", ["country"])
    return named.groupBy(DAY, "country").agg(F.sum("watch").alias("total_watch_seconds"),
                                             F.count("customer_key").alias("unique_users"))


def title_reach(daily: DataFrame) -> DataFrame:
    week = F.to_date(F.date_trunc("week", DAY))
    pairs = daily.select(week.alias("week"), "title_key", "customer_key").distinct()
    return pairs.groupBy("week", "title_key").agg(F.count("customer_key").alias("distinct_viewers"))

