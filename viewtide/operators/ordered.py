"""Ordered scans that do not depend on one key fitting into one task.

``Window.partitionBy(key)`` sends all rows of a key to one task. That is the right plan until a key holds more rows than
a task should take. :class:`Ordered` splits every such key into consecutive chunks of its ordering: the window then runs per
``(key, chunk)``, each chunk is summarised by one row, and the value carried over from the earlier chunks is joined back.

Nothing runs while a plan is built. The chunk limits are a part of the plan: rows are picked by a hash of their order
columns, so every evaluation picks the same ones, and every ``SAMPLE_PER_CHUNK``-th of a key's picked rows is a limit. A
key without limits is one chunk. Where no key has any, which is known once the limits have been computed, adaptive
execution drops the summaries, the carries and their joins, and what is left is the plain window. The detail is shuffled once.
Neither the number of split keys nor of chunks is limited.

With no key at all the same scan numbers or accumulates a whole table without the single task of ``Window.orderBy``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.operators.joins import null_safe_join

HOT_ROWS = 2_000_000          # rows of one key that one task takes without splitting
SAMPLE_PER_CHUNK = 30

_CHUNK = "__chunk"
_FIRST = "__first"
_LAST = "__last"
_ONE = "__one"


@dataclass(frozen=True)
class Scan:
    """One running value: its form inside a window, the summary of a chunk, and how the carry enters."""

    local: Callable[[Window], Column]
    summary: Callable[[list[str]], Column]
    carry: Callable[[Column, Window], Column]
    combine: Callable[[Column, Column], Column]
    edge: str | None = None  # "first"/"last": the carry replaces the value of that row only


def previous(col: str) -> Scan:
    return Scan(
        local=lambda w: F.lag(col).over(w),
        summary=lambda order: F.max_by(F.col(col), F.struct(*order)),
        carry=lambda s, w: F.lag(s).over(w),
        combine=lambda _, carried: carried,
        edge="first",
    )


def following(col: str) -> Scan:
    return Scan(
        local=lambda w: F.lead(col).over(w),
        summary=lambda order: F.min_by(F.col(col), F.struct(*order)),
        carry=lambda s, w: F.lead(s).over(w),
        combine=lambda _, carried: carried,
        edge="last",
    )


def _before(w):
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _upto(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_sum(col: str | Column) -> Scan:
    c = F.col(col) if isinstance(col, str) else col

    def add(local: Column, carried: Column) -> Column:
        return F.when(local.isNull() | carried.isNull(), F.coalesce(local, carried)).otherwise(local + carried)

    return Scan(
        local=lambda w: F.sum(c).over(_upto(w)),
        summary=lambda _: F.sum(c),
        carry=lambda s, w: F.sum(s).over(_before(w)),
        combine=add,
    )


def running_count() -> Scan:
    return running_sum(F.lit(1).cast("bigint"))


def running_max(col: str) -> Scan:
    return Scan(
        local=lambda w: F.max(col).over(_upto(w)),
        summary=lambda _: F.max(col),
        carry=lambda s, w: F.max(s).over(_before(w)),
        combine=F.greatest,
    )


def _locate(limits: Column, value: Column) -> Column:
    """How many of the ascending ``limits`` are <= ``value``, by bisection over up to 2**31 limits."""
    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        right = F.get(limits, mid) <= value
        return (F.when(acc["lo"] >= acc["hi"], acc)
                .when(right, F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi")))
                .otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi"))))

    start = F.struct(F.lit(0).alias("lo"), F.size(limits).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), (F.ceil(F.log2(F.size(limits) + 1)) + 1).cast("int")), start, step, lambda acc: acc["lo"])


@dataclass(frozen=True)
class Ordered:
    """A frame with a partition key, a total order inside it and a chunk number."""

    frame: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    limits: DataFrame

    @classmethod
    def split(cls, df: DataFrame, keys: Sequence[str], order: Sequence[str], *, hot_rows: int | None = None,
              probe: DataFrame | None = None) -> Ordered:
        """Number the chunks of every row's key; a key with about ``hot_rows`` rows or fewer is chunk -1.

        ``probe`` is a cheaper frame with the same key and order columns (for example the input before deduplication);
        it only decides where to cut. The limits that are sent to all tasks are one value for every ``hot_rows`` rows.
        """
        keys, order = tuple(keys) or (_ONE,), tuple(order)
        if keys == (_ONE,):
            df = df.withColumn(_ONE, F.lit(0))
            probe = probe.withColumn(_ONE, F.lit(0)) if probe is not None else None
        limits = _chunk_limits(df if probe is None else probe, keys, order, hot_rows or HOT_ROWS)
        joined = null_safe_join(df, F.broadcast(limits), keys, "left")
        chunk = F.when(F.col("__limits").isNull(), F.lit(-1)).otherwise(_locate(F.col("__limits"), F.struct(*order)))
        return cls(joined.withColumn(_CHUNK, chunk).drop("__limits"), keys, order, limits)

    def transform(self, **columns: Column) -> Ordered:
        return replace(self, frame=self.frame.withColumns(columns))

    def scan(self, **scans: Scan) -> Ordered:
        group = [*self.keys, _CHUNK]
        w = Window.partitionBy(*group).orderBy(*self.order)
        local = {n: s.local(w) for n, s in scans.items()}
        edges = {s.edge for s in scans.values()}
        if "first" in edges:
            local[_FIRST] = F.row_number().over(w) == 1
        if "last" in edges:
            local[_LAST] = F.lead(F.lit(1)).over(w).isNull()
        detail = self.frame.withColumns(local)

        # One row for about every HOT_ROWS rows of the hot keys, so it is broadcast and the detail keeps its partitioning
        # for the next scan. Ordinary keys need no carry; the semi-join lets all of this vanish where there are no others.
        split = null_safe_join(self.frame, F.broadcast(self.limits), self.keys, "left_semi")
        sums = (split.groupBy(*group)
                .agg(*[s.summary(list(self.order)).alias(f"__s_{n}") for n, s in scans.items()]))
        over = Window.partitionBy(*self.keys).orderBy(_CHUNK)
        carries = sums.select(*group, *[s.carry(F.col(f"__s_{n}"), over).alias(f"__c_{n}") for n, s in scans.items()])

        joined = null_safe_join(detail, F.broadcast(carries), group, "left")
        out: dict[str, Column] = {}
        for n, s in scans.items():
            value, carried = F.col(n), F.col(f"__c_{n}")
            if s.edge:
                at_edge = F.col(_FIRST if s.edge == "first" else _LAST) & (F.col(_CHUNK) >= 0)
                out[n] = F.when(at_edge, s.combine(value, carried)).otherwise(value)
            else:
                out[n] = s.combine(value, carried)
        joined = joined.withColumns(out).drop(_FIRST, _LAST, *[f"__c_{n}" for n in scans])
        return replace(self, frame=joined)

    @property
    def df(self) -> DataFrame:
        return self.frame.drop(_CHUNK, _ONE)


def _chunk_limits(probe: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], hot_rows: int) -> DataFrame:
    """One row per hot key with the ascending limits of its chunks.

    A row is picked with probability ``SAMPLE_PER_CHUNK / hot_rows`` by a hash of its order columns, before anything is
    shuffled; of a key's picks every ``SAMPLE_PER_CHUNK``-th is a limit, so a key with fewer picks is not hot.
    """
    step = min(SAMPLE_PER_CHUNK, hot_rows)
    picked = F.pmod(F.xxhash64(*order), F.lit(hot_rows)) < step
    each = F.filter(F.array_sort(F.collect_set(F.struct(*order))), lambda _, i: (i + 1) % step == 0)
    return probe.where(picked).groupBy(*keys).agg(each.alias("__limits")).where(F.size("__limits") > 0)
