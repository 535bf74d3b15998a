"""Surrogate keys and whole-table ranks without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.operators.ordered import Ordered, running_count, running_sum


def assign_keys(df: DataFrame, natural: str, key: str, offset: int | Column = 0, hot_rows: int | None = None,
                probe: DataFrame | None = None) -> DataFrame:
    """``offset + 1, 2, ...`` in the order of a unique natural key; ``probe`` holds the same keys, repeated or not."""
    scanned = Ordered.split(df, [], [natural], hot_rows=hot_rows, probe=probe).scan(**{key: running_count()})
    return scanned.df.withColumn(key, F.col(key) + (offset if isinstance(offset, Column) else F.lit(offset)))


def hash_keys(df: DataFrame, natural: str, key: str) -> DataFrame:
    """Surrogate key as a hash of the natural key: no shuffle, stable under re-runs."""
    return df.withColumn(key, F.xxhash64(natural))


def key_collisions(dim: DataFrame, natural: str, key: str) -> DataFrame:
    """Surrogate keys that stand for more than one natural key."""
    return (dim.groupBy(key).agg(F.countDistinct(natural).alias("natural_keys"))
            .where(F.col("natural_keys") > 1))


def rank_all(df: DataFrame, col: str, rank: str = "rank", dense: str = "dense_rank",
             hot_rows: int | None = None) -> DataFrame:
    """``rank`` and ``dense_rank`` over the whole table, largest numeric value first; NULL values get no rank.

    Rows are first reduced to distinct values with counts; the scan runs over those and the ranks are joined back.
    """
    values = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("__v"))
              .agg(F.count(F.lit(1)).alias("__n")).withColumn("__neg", -F.col("__v")))
    probe = df.where(F.col(col).isNotNull()).select((-F.col(col)).alias("__neg"))
    ranked = (Ordered.split(values, [], ["__neg"], hot_rows=hot_rows, probe=probe)
              .scan(__cum=running_sum("__n"), **{dense: running_count()}).df
              .select("__v", (F.col("__cum") - F.col("__n") + 1).alias(rank), dense))
    return df.join(ranked, F.col(col) == F.col("__v"), "left").drop("__v")
