"""Helpers the operators share: intermediate tables, batch functions, the fold of a document."""

from __future__ import annotations

import functools
import uuid
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.session import work_path
from viewtide.sources.fs import Files


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives the loss of executors."""
    path = work_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables written by :func:`store` that no later step reads."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path:
            Files(df.sparkSession, path).delete(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever columns it brings."""
    names = {c.lower() for c in df.columns}
    return stem if stem not in names else f"{stem}_{uuid.uuid4().hex[:8]}"


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def fold_of(doc_id, folds: int) -> int:
    """The same fold in Python, for tests."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row; maps are excluded, because Spark does not hash them."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()])


def is_empty(df: DataFrame) -> bool:
    return len(df.take(1)) == 0


def words_of(text: str | None) -> list[bytes]:
    """Words between the ASCII white space 0x20 and 0x09-0x0D, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def join_counted(rows: DataFrame, facts: DataFrame, keys: list[str], count: str, share: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with one fact a key, where ``count`` says how many rows have the key (nulls are equal).

    Keys with more than a ``share``-th of all rows would each be one task; there are fewer than ``share`` of them, which
    bounds what is broadcast. All others are joined by a shuffle.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    names = [f"{k}_{uuid.uuid4().hex[:8]}" for k in keys]
    facts = facts.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[c for c in facts.columns if c not in keys])
    same = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    hot = F.broadcast(facts.where(F.col(count) * share > total))
    cold = facts.where(F.col(count) * share <= total)
    others = rows.join(hot.select(*names), same, "left_anti")
    return rows.join(hot, same).drop(*names).unionByName(others.join(cold, same).drop(*names))
