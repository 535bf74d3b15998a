"""Run metrics and check results as small append-only tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from viewtide.sources import tables


def metric_rows(row: DataFrame, dag_id: str, run_id: str, start: Column, end: Column, recorded_at: Column,
                ids: Sequence[str] = ()) -> DataFrame:
    """One row per numeric column of ``row``; values that are not numbers are skipped."""
    names = [c for c in row.columns if c not in ids]
    pairs = F.array(*[F.struct(F.lit(n).alias("metric_name"),
                               F.col(n).cast("string").try_cast("double").alias("metric_value")) for n in names])
    return (row.select(*ids, F.inline(pairs)).where(F.col("metric_value").isNotNull())
            .withColumns({"dag_id": F.lit(dag_id), "run_id": F.lit(run_id), "data_interval_start": start,
                          "data_interval_end": end, "recorded_at": recorded_at})
            .select(*ids, "dag_id", "run_id", "metric_name", "metric_value", "data_interval_start",
                    "data_interval_end", "recorded_at"))


def observed(df: DataFrame, write: Callable[[DataFrame], None], **values: Column) -> dict[str, int | float]:
    """Run ``write`` and return aggregates of the rows that passed through it, gathered by the write itself: nothing is read
    a second time. ``write`` must run one action over its argument."""
    seen = Observation()
    write(df.observe(seen, *[c.alias(n) for n, c in values.items()]))
    return seen.get


def write_metrics(rows: DataFrame, path: str) -> None:
    tables.append(rows.repartition(1), path)


def save_checks(checks: DataFrame, path: str, recorded_at: Column) -> None:
    tables.append(checks.withColumn("recorded_at", recorded_at).repartition(1), path)


class CheckFailed(RuntimeError):
    """A gating check did not hold."""


def assert_checks(checks: DataFrame) -> None:
    """Raise when a check failed. A check table has one row per check, so it is small."""
    failed = [r.asDict() for r in checks.where(~F.col("passed")).collect()]
    if failed:
        raise CheckFailed("; ".join(f"{r['check']}: observed {r['observed']}, expected {r['expected']}"
                                    for r in failed))
