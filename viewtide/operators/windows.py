"""Window patterns over event tables (rows per key in time order)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide import schema
from viewtide.functions.scalars import elapsed_seconds
from viewtide.operators.joins import null_safe_join
from viewtide.operators.ordered import Ordered, following, previous, running_max, running_sum


def _desc(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key; ``order`` must be total within a key.

    Catalyst keeps one row per key and task before the shuffle (WindowGroupLimit), so a key with many copies is cheap.
    """
    w = Window.partitionBy(*keys).orderBy(*_desc(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def dedup_latest(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Newest row per composite key; ties by a hash of the whole row."""
    marked = df.withColumn("__tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    return latest_per_key(marked, keys, [ts, "__tie"]).drop("__tie")


def next_value(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, out: str,
               hot_rows: int | None = None) -> DataFrame:
    return Ordered.split(df, part, order, hot_rows=hot_rows).scan(**{out: following(col)}).df


def seconds_since_prev(df: DataFrame, part: Sequence[str], order: Sequence[str], ts: str,
                       out: str = "seconds_since_prev", hot_rows: int | None = None) -> DataFrame:
    scanned = Ordered.split(df, part, order, hot_rows=hot_rows).scan(__prev=previous(ts)).df
    return scanned.withColumn(out, elapsed_seconds(F.col(ts), F.col("__prev"))).drop("__prev")


def running_total(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, out: str,
                  hot_rows: int | None = None) -> DataFrame:
    return Ordered.split(df, part, order, hot_rows=hot_rows).scan(**{out: running_sum(col)}).df


def running_maximum(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, out: str,
                    hot_rows: int | None = None) -> DataFrame:
    return Ordered.split(df, part, order, hot_rows=hot_rows).scan(**{out: running_max(col)}).df


def moving_avg(daily: DataFrame, part: Sequence[str], order: Sequence[str], col: str, n: int, out: str) -> DataFrame:
    """Mean of the current and the ``n-1`` earlier rows. The input is already one row per key and day."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(-(n - 1), 0)
    return daily.withColumn(out, F.avg(col).over(w))


def pct_of_group(df: DataFrame, part: Sequence[str], col: str, total: str, out: str) -> DataFrame:
    """Share of the group total. Totals are aggregated and joined, so a large group is never one task."""
    totals = df.groupBy(*part).agg(F.sum(col).alias(total))
    return (null_safe_join(df, totals, part, "left")
            .withColumn(out, F.try_divide(F.col(col).cast("double"), F.col(total).cast("double"))))


def group_mean_flag(df: DataFrame, part: Sequence[str], col: str, mean: str, flag: str) -> DataFrame:
    """Group mean beside every row and whether the row is above it."""
    means = df.groupBy(*part).agg(F.avg(F.col(col).cast("double")).alias(mean))
    return null_safe_join(df, means, part, "left").withColumn(flag, F.col(col) > F.col(mean))


def first_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, first: str,
               last: str) -> DataFrame:
    """First and last value per key as aggregates with map-side combine."""
    at = F.struct(*order)
    return df.groupBy(*keys).agg(F.min_by(col, at).alias(first), F.max_by(col, at).alias(last))


def top_n(df: DataFrame, part: Sequence[str], metric: str, tie: Sequence[str], n: int) -> DataFrame:
    """The ``n`` largest rows per group; ties by ``tie`` ascending."""
    w = Window.partitionBy(*part).orderBy(F.col(metric).desc_nulls_last(), *[F.col(t).asc() for t in tie])
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def sessionize(df: DataFrame, part: Sequence[str], order: Sequence[str], ts: str,
               gap_seconds: int = schema.SESSION_GAP_SECONDS, out: str = "session_num",
               hot_rows: int | None = None, probe: DataFrame | None = None) -> DataFrame:
    """Number a user's sessions 1, 2, ...; a silence longer than the gap starts a new one."""
    scanned = Ordered.split(df, part, order, hot_rows=hot_rows, probe=probe).scan(__prev=previous(ts))
    since = F.unix_micros(F.col(ts)) - F.unix_micros(F.col("__prev"))
    starts = F.when(F.col("__prev").isNull() | (since > gap_seconds * 1_000_000), 1).otherwise(0).cast("bigint")
    return scanned.transform(__start=starts).scan(**{out: running_sum("__start")}).df.drop("__prev", "__start")


def day_over_day(daily: DataFrame, day: str, col: str) -> DataFrame:
    """Previous day's value, delta and relative change. The input holds one row per day, so one task is enough."""
    w = Window.orderBy(day)
    prev = F.lag(col).over(w)
    return (daily.withColumn(f"prev_{col}", prev)
            .withColumn("delta", F.col(col) - F.col(f"prev_{col}"))
            .withColumn("pct_change", F.try_divide(F.col("delta").cast("double"), F.col(f"prev_{col}").cast("double"))))


def silent_gaps(daily: DataFrame, key: str, day: str, days: int = 7, sustained: int = 1) -> DataFrame:
    """Silences longer than ``days`` between two active days of a key that was active ``sustained`` days before."""
    active = daily.select(key, day).distinct()
    w = Window.partitionBy(key).orderBy(day)
    return (active.withColumn("last_active", F.lag(day).over(w))
            .withColumn("active_days_before", (F.row_number().over(w) - 1).cast("bigint"))
            .withColumn("silent_days", F.datediff(F.col(day), F.col("last_active")))
            .where((F.col("silent_days") > days) & (F.col("active_days_before") >= sustained)))


def rolling_actives(daily: DataFrame, user: str, day: str, days: int, out: str = "actives") -> DataFrame:
    """Distinct users active in the ``days`` days ending on each day from the first active one to the last.

    Each user's active days become the intervals of days they count for; overlapping intervals of a user are merged
    first, so a user contributes one +1 and one -1 per interval instead of ``days`` rows per active day.
    """
    active = daily.select(F.col(user).alias("__u"), F.col(day).alias("__d")).where(
        F.col("__u").isNotNull() & F.col("__d").isNotNull()).distinct()
    w = Window.partitionBy("__u").orderBy("__d")
    # The interval of an active day ends where the user's next active day takes over.
    spans = active.withColumn("__next", F.lead("__d").over(w)).select(
        F.col("__d").alias("lo"),
        F.least(F.date_add("__d", days), F.coalesce(F.col("__next"), F.date_add("__d", days))).alias("hi"))
    deltas = (spans.select(F.inline(F.array(F.struct(F.col("lo").alias(day), F.lit(1).alias("step")),
                                            F.struct(F.col("hi").alias(day), F.lit(-1).alias("step")))))
              .groupBy(day).agg(F.sum("step").alias("step")))
    span = active.agg(F.min("__d").alias("lo"), F.max("__d").alias("hi")).where("lo is not null")
    by_day = span.select(F.explode(F.sequence("lo", "hi")).alias(day)).join(deltas, day, "left")  # one row per day
    return by_day.select(day, F.sum(F.coalesce("step", F.lit(0))).over(Window.orderBy(day)).alias(out))


def watch_deltas(events: DataFrame, session: str, ts: str, tie: str, event_type: str,
                 active_types: Sequence[str], out: str = "watch_seconds_delta",
                 hot_rows: int | None = None) -> DataFrame:
    """Seconds to the session's next event while playing; 0 after a pause and for the last event."""
    scanned = Ordered.split(events, [session], [ts, tie], hot_rows=hot_rows).scan(__next=following(ts)).df
    delta = elapsed_seconds(F.col("__next"), F.col(ts))
    playing = F.col(event_type).isin(list(active_types)) & F.col("__next").isNotNull()
    return scanned.withColumn(out, F.when(playing, delta).otherwise(F.lit(0.0))).drop("__next")
