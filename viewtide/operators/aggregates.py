"""Grouped aggregates, reshaping and exact order statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.operators.joins import null_safe_join
from viewtide.operators.ordered import Ordered, running_sum


def group_stats(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    c = F.col(col)
    return df.groupBy(*by).agg(F.sum(c).alias(f"sum_{col}"), F.avg(c).alias(f"avg_{col}"),
                               F.count(F.lit(1)).alias("n"), F.min(c).alias(f"min_{col}"), F.max(c).alias(f"max_{col}"))


def distinct_count(df: DataFrame, by: Sequence[str], col: str, approximate: bool = False) -> DataFrame:
    agg = F.approx_count_distinct(col) if approximate else F.countDistinct(col)
    return df.groupBy(*by).agg(agg.alias(f"distinct_{col}"))


def groups_over(df: DataFrame, by: Sequence[str], n: int, out: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > n)


def percentiles(df: DataFrame, by: Sequence[str], col: str, ps: Mapping[str, float],
                hot_rows: int | None = None) -> DataFrame:
    """Exact interpolated percentiles per group.

    Rows shrink to distinct values with counts, a running count locates the one or two values each percentile lies
    between, and an aggregate interpolates; no group is ever gathered in one buffer.
    """
    if not by:
        whole = df.withColumn("__all", F.lit(0))
        return percentiles(whole, ["__all"], col, ps, hot_rows).drop("__all")
    by = list(by)
    present = df.where(F.col(col).isNotNull())
    values = (present.groupBy(*by, F.col(col).cast("double").alias("__v"))
              .agg(F.count(F.lit(1)).alias("__n")))
    totals = present.groupBy(*by).agg(F.count(F.lit(1)).alias("__total"))
    probe = present.select(*by, F.col(col).cast("double").alias("__v"))
    ranked = Ordered.split(values, by, ["__v"], hot_rows=hot_rows, probe=probe).scan(__cum=running_sum("__n")).df
    placed = null_safe_join(ranked, totals, by, "left")
    before = F.col("__cum") - F.col("__n")

    def at(rank: Column) -> Column:
        return F.max(F.when((before <= rank) & (rank < F.col("__cum")), F.col("__v")))

    aggs = []
    for name, p in ps.items():
        pos = F.lit(p) * (F.col("__total") - 1)
        aggs += [at(F.floor(pos)).alias(f"__lo_{name}"), at(F.ceil(pos)).alias(f"__hi_{name}")]
    picked = placed.groupBy(*by).agg(*aggs, F.max("__total").alias("__total"))

    def between(name: str, p: float) -> Column:
        pos = F.lit(p) * (F.col("__total") - 1)
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        return (lo + (hi - lo) * (pos - F.floor(pos))).alias(name)

    return picked.select(*by, *[between(n, p) for n, p in ps.items()])


def approx_percentiles(df: DataFrame, by: Sequence[str], col: str, ps: Mapping[str, float],
                       accuracy: int = 10_000) -> DataFrame:
    """Mergeable quantile sketch; each result is a value of the data."""
    return df.groupBy(*by).agg(*[F.percentile_approx(col, p, accuracy).alias(n) for n, p in ps.items()])


def compare_counts(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Row counts of two frames in one row."""
    sides = (left.select(F.lit(1).cast("bigint").alias(left_name), F.lit(0).cast("bigint").alias(right_name))
             .unionByName(right.select(F.lit(0).cast("bigint").alias(left_name),
                                       F.lit(1).cast("bigint").alias(right_name))))
    return sides.agg(F.coalesce(F.sum(left_name), F.lit(0)).alias(left_name),
                     F.coalesce(F.sum(right_name), F.lit(0)).alias(right_name))


def rollup_days(mart: DataFrame, day: str, cols: Sequence[str]) -> DataFrame:
    return mart.groupBy(day).agg(*[F.sum(c).alias(c) for c in cols])


def unpivot_row(row: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    """Columns of a frame as (label, value) rows."""
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias(label), F.col(n).alias(value)) for n in names])))


def threshold_funnel(df: DataFrame, pct: str, steps: Mapping[str, tuple[str, float]], out: str) -> DataFrame:
    """Rows reaching each step in one pass; a step is ``(">" or ">=", threshold)``."""
    aggs = [F.count_if(F.col(pct) > t if op == ">" else F.col(pct) >= t).alias(n) for n, (op, t) in steps.items()]
    return unpivot_row(df.agg(*aggs), list(steps), "step", out)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return unpivot_row(counted, cols, "col_name", "null_count")


def null_flags(df: DataFrame, cols: Sequence[str], out: str = "has_null") -> DataFrame:
    flag = F.lit(False)
    for c in cols:
        flag = flag | F.col(c).isNull()
    return df.withColumn(out, flag)


def pivot_sum(df: DataFrame, row: str, col: str, val: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(row).pivot(col, list(values)).agg(F.sum(val))


def unpivot_nonnull(df: DataFrame, ids: Sequence[str], cols: Sequence[str], label: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(cols), label, value).where(F.col(value).isNotNull())


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def top_k(df: DataFrame, metric: str, tie: Sequence[str], k: int) -> DataFrame:
    """The ``k`` largest rows, ties by ``tie`` ascending (TakeOrderedAndProject)."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in tie]).limit(k)


def latest_day(df: DataFrame, col: str, day: str | None = None) -> DataFrame:
    """Rows of the given day, else of the newest day present. The newest day is a one-row aggregate."""
    if day is not None:
        return df.where(F.col(col) == F.lit(day).cast("date"))
    newest = df.agg(F.max(col).alias("__day"))
    return df.join(F.broadcast(newest), F.col(col) == F.col("__day"), "left_semi")


def sorted_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(*keys)


def stack_metrics(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def hot_cold(hot: DataFrame, cold: DataFrame, day: str, cutoff: Column) -> DataFrame:
    """One view over two tiers: hot rows from the cut-off on, cold rows before it."""
    return hot.where(F.col(day) >= cutoff).unionByName(cold.where(F.col(day) < cutoff))
