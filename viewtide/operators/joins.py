"""Equi-joins of facts, dimensions and aggregates.

A dimension is broadcast only while the tables it is computed from are small (:func:`small_side`). Beyond that Spark
sorts and merges, or broadcasts by its own statistics, and AQE splits skewed partitions of the fact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.functions.scalars import explode_list


BROADCAST_BYTES = 8 << 20  # stored bytes behind a dimension up to which it is broadcast


def input_bytes(df: DataFrame) -> int:
    """Size of the tables a frame reads, by the optimizer's statistics."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def small_side(dim: DataFrame) -> DataFrame:
    """The dimension with a broadcast hint if its inputs are small. The optimizer's own estimate multiplies the sides of
    a join inside the dimension and would miss it."""
    return F.broadcast(dim) if input_bytes(dim) <= BROADCAST_BYTES else dim


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join that matches NULL keys; the result holds the left keys once."""
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    joined = left.join(other, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{k}" for k in keys])


def attach(fact: DataFrame, dim: DataFrame, key: str, cols: Sequence[str], how: str = "left") -> DataFrame:
    """Bring dimension columns to the fact on a shared key; ``how="inner"`` drops unresolved rows."""
    return fact.join(small_side(dim.select(key, *cols)), key, how)


def resolve_keys(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Star join on natural keys: ``{fact column: (dim, natural key, surrogate key)}``.

    Unresolved rows keep a NULL surrogate. Each dimension must be unique on its natural key.
    """
    out = fact
    for fk, (dim, natural, surrogate) in dims.items():
        lookup = dim.select(F.col(natural).alias("__nk"), surrogate)
        out = out.join(small_side(lookup), F.col(fk) == F.col("__nk"), "left").drop("__nk")
    return out


def touched_rows(events: DataFrame, key: str, ts_col: str, start: Column, end: Column) -> DataFrame:
    """All rows of the keys that have a row in ``[start, end)``."""
    touched = (events.where((F.col(ts_col) >= start) & (F.col(ts_col) < end))
               .select(F.col(key).alias("__k")).distinct())
    return events.join(touched, F.col(key) == F.col("__k"), "left_semi")


def new_keys(src: DataFrame, existing: DataFrame, natural: str) -> DataFrame:
    """Source rows whose natural key the existing table does not have."""
    known = existing.select(F.col(natural).alias("__nk"))
    return src.join(known, F.col(natural) == F.col("__nk"), "left_anti")


def parent_key(child: DataFrame, parent: DataFrame, natural: str, key: str, how: str = "left") -> DataFrame:
    """Give the child dimension its parent's surrogate key."""
    return child.join(small_side(parent.select(natural, key)), natural, how)


def by_list_member(df: DataFrame, col: str, dim: DataFrame, member: str, sep: str = ",") -> DataFrame:
    """Join through membership in a delimited list: explode, then an equi-join."""
    return explode_list(df, col, sep, out=member).join(dim, member, "inner")


def enrich(events: DataFrame, dim: DataFrame, on: str, cols: Sequence[str]) -> DataFrame:
    return attach(events, dim, on, cols, how="inner")


def share_of_total(df: DataFrame, part: Sequence[str], col: str, total: str) -> DataFrame:
    """Add the partition total of an already aggregated frame."""
    totals = df.groupBy(*part).agg(F.sum(col).alias(total))
    return null_safe_join(df, totals, part, "left")


def compare(left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Full-outer comparison on a composite key: rows that are missing on a side or differ in a column."""
    a = left.select(*keys, *[F.col(c).alias(f"left_{c}") for c in cols], F.lit(True).alias("__a"))
    b = right.select(*[F.col(k).alias(f"__b_{k}") for k in keys], *[F.col(c).alias(f"right_{c}") for c in cols],
                     F.lit(True).alias("__b"))
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__b_{k}")) for k in keys])
    both = a.join(b, on, "full")
    differs = reduce(lambda x, y: x | y,
                     [~F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}")) for c in cols], F.lit(False))
    status = (F.when(F.col("__a").isNull(), "only_right").when(F.col("__b").isNull(), "only_left")
              .when(differs, "differs"))
    key_cols = [F.when(F.col("__a").isNull(), F.col(f"__b_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    pairs = [c for name in cols for c in (f"left_{name}", f"right_{name}")]
    return both.select(*key_cols, *pairs, status.alias("status")).where(F.col("status").isNotNull())


def partition_digests(df: DataFrame, part: str, cols: Sequence[str]) -> DataFrame:
    """``rows`` and an order-free digest of every partition: the sum of its row hashes, added before the shuffle."""
    h = F.xxhash64(*cols).cast("decimal(38,0)")
    return df.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), F.sum(h).alias("digest"))


def differing_partitions(left: DataFrame, right: DataFrame, part: str, cols: Sequence[str]) -> list:
    """The values of ``part`` whose rows differ between two tables, by count or digest; one row per partition is compared."""
    a, b = (partition_digests(df, part, cols) for df in (left, right))
    return [r[0] for r in compare(a, b, [part], ["rows", "digest"]).select(part).collect()]


def compare_partitioned(left: DataFrame, right: DataFrame, part: str, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """:func:`compare` of two tables partitioned by ``part``, one of the keys: digests find the partitions that differ, and
    the row by row comparison reads those alone."""
    differing = differing_partitions(left, right, part, [*keys, *cols])
    known = [v for v in differing if v is not None]
    here = F.col(part).isin(known) if known else F.lit(False)
    here = here | F.col(part).isNull() if None in differing else here
    return compare(left.where(here), right.where(here), keys, cols)


def zero_activity(titles: DataFrame, title_key: str, release_col: str, daily: DataFrame, day_col: str,
                  days: int = 30) -> DataFrame:
    """Title-days without activity in the first ``days`` days after release.

    The dense grid comes from exploding ``days`` dates per title, so it grows with the titles only.
    """
    first = F.col(release_col)
    grid = titles.select(title_key, F.explode(F.sequence(first, F.date_add(first, days - 1))).alias(day_col))
    active = daily.select(title_key, day_col).distinct()
    return grid.join(active, [title_key, day_col], "left_anti")
