"""Registry of queries: a Spark plan over the bound tables and, where SQL can say it, the same in DuckDB SQL.

Each query declares its columns as ``name:kind`` (see ``plain_columns``); both sides are cast by that one declaration,
so types never differ between the engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from viewtide.bind import Playback
from viewtide.catalog.relations import RELATIONS
from viewtide.functions.scalars import plain_columns


@dataclass(frozen=True)
class Query:
    name: str
    kinds: dict[str, str]
    plan: Callable[[Playback], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain_columns(self.plan(Playback(spark, folder)), self.kinds)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts = {"i": "CAST({c} AS BIGINT)", "d": "ROUND(CAST({c} AS DOUBLE), 6)", "s": "CAST({c} AS VARCHAR)",
                 "t": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"}
        cols = ", ".join(casts[k].format(c=f'"{c}"') + f' AS "{c}"' for c, k in self.kinds.items())
        return f"{with_clause(self.sql)}SELECT {cols} FROM ({self.sql.strip()}) AS q"


QUERIES: dict[str, Query] = {}


def query(name: str, kinds: str, sql: str | None = None):
    """Register a plan under a name. ``sql`` may use any relation of :mod:`viewtide.catalog.relations`."""
    declared = dict(part.split(":") for part in kinds.split())

    def add(plan: Callable[[Playback], DataFrame]) -> Callable[[Playback], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, declared, plan, sql)
        return plan

    return add


def with_clause(sql: str) -> str:
    """WITH clause holding the relations the text needs, in the order they are declared."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & set(RELATIONS) - needed:
            needed.add(name)
            pending.append(RELATIONS[name])
    parts = [f"{n} AS ({RELATIONS[n].strip()})" for n in RELATIONS if n in needed]
    return f"WITH {', '.join(parts)} " if parts else ""
