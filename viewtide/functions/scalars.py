"""Column helpers built only from Spark functions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide import schema


def date_key(day: Column) -> Column:
    """20240131 for 2024-01-31, by integer arithmetic."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def exact_ratio(num: Column, den: Column, precision: int, scale: int, times: int = 1) -> Column:
    """``num * times / den`` as a decimal rounded half up; NULL when ``den`` is 0 or NULL.

    Both sides are integers, so the division runs on decimals and ties are exact.
    """
    wide = (num.cast("decimal(20,0)") * F.lit(times)).cast("decimal(24,0)")
    return F.try_divide(wide, den.cast("decimal(20,0)")).cast(f"decimal({precision},{scale})")


def completion_pct(max_position_ms: Column, runtime_minutes: Column) -> Column:
    """Share of the runtime reached, capped at 1; NULL without a positive runtime (``least`` would skip the NULL)."""
    runtime = F.when(runtime_minutes > 0, runtime_minutes)
    share = F.try_divide(max_position_ms.cast("decimal(20,0)"), (runtime * 60000).cast("decimal(20,0)"))
    return F.when(share.isNotNull(), F.least(share, F.lit(1)).cast("decimal(4,3)"))


def decile(pct: Column) -> Column:
    """Bucket 0..9 by floor; NULL stays NULL."""
    return F.when(pct.isNotNull(), F.least(F.floor(pct * 10), F.lit(9)).cast("int"))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch."""
    return F.unix_timestamp(ts)


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Difference in seconds that keeps fractions (``unix_timestamp`` drops them)."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def any_event(type_col: str | Column, value: str) -> Column:
    col = F.col(type_col) if isinstance(type_col, str) else type_col
    return F.coalesce(F.bool_or(col == value), F.lit(False))


def first_known(col: str, order: Sequence[str]) -> Column:
    """Aggregate: the earliest non-null value of ``col``, ties broken by the later entries of ``order``."""
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.struct(*order)))


def value_at_last(col: str, order: Sequence[str]) -> Column:
    """Aggregate: value of ``col`` in the latest row."""
    return F.max_by(F.col(col), F.struct(*order))


def null_sentinels(df: DataFrame, sentinel: str = schema.NULL_SENTINEL) -> DataFrame:
    """Turn the sentinel into NULL in every string column, in one projection."""
    kinds = dict(df.dtypes)
    return df.select(*[F.nullif(F.col(c), F.lit(sentinel)).alias(c) if kinds[c] == "string" else F.col(c)
                       for c in df.columns])


def hash_attributes(df: DataFrame, id_col: str) -> DataFrame:
    """Pseudonymous attributes cut from the SHA-256 of an id: plan tier, age band, household size."""
    digest = F.sha2(F.col(id_col).cast("string"), 256)

    def byte(start: int) -> Column:
        return F.conv(F.substring("email_hash", start, 2), 16, 10).cast("int")

    def pick(values: Sequence[str], start: int) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), byte(start) % len(values) + 1)

    return df.withColumn("email_hash", digest).withColumns({
        "plan_tier": pick(schema.PLAN_TIERS, 1),
        "age_band": pick(schema.AGE_BANDS, 3),
        "household_size": byte(5) % 5 + 1,
    })


def mask_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """View for restricted readers: letters and digits of the named columns are masked."""
    hidden = set(cols)
    return df.select(*[F.mask(F.col(c)).alias(c) if c in hidden else F.col(c) for c in df.columns])


def extra_fields(payload: Column, known: Iterable[str]) -> Column:
    """Fields of a JSON object that the schema does not know, as ``map<string,string>``."""
    names = F.array(*[F.lit(k) for k in known])
    return F.map_filter(F.from_json(payload, "map<string,string>"), lambda k, _: ~F.array_contains(names, k))


def fix_encoding(df: DataFrame, cols: Sequence[str], flag: str = "encoding_warning") -> DataFrame:
    """Replace invalid UTF-8 in ``cols`` by ``?`` and flag the row."""
    broken = F.lit(False)
    fixed: dict[str, Column] = {}
    for c in cols:
        valid = F.coalesce(F.is_valid_utf8(F.col(c)), F.lit(True))
        broken = broken | ~valid
        fixed[c] = F.when(valid, F.col(c)).otherwise(F.translate(F.make_valid_utf8(F.col(c)), "�", "?"))
    return df.withColumns({flag: broken, **fixed})


def explode_list(df: DataFrame, col: str, sep: str = ",", out: str | None = None) -> DataFrame:
    """One row per trimmed, non-empty member of a delimited column; rows with a NULL list disappear."""
    out = out or col
    members = F.filter(F.transform(F.split(F.col(col), sep), lambda m: F.trim(m)), lambda m: m != "")
    return df.withColumn(out, F.explode(members))


def plain_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cast each column to one of four portable kinds: ``i`` bigint, ``d`` double rounded to 6, ``s`` string,
    ``t`` timestamp text with microseconds."""
    def cast(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == "i":
            return c.cast("bigint").alias(name)
        if kind == "d":
            return F.round(c.cast("double"), 6).alias(name)
        if kind == "t":
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
        return c.cast("string").alias(name)

    return df.select(*[cast(n, k) for n, k in kinds.items()])
