"""What the two vector searches share: valid vectors, distinct vectors with their ids, blocks, the final ranking.

Equal vectors are one candidate that carries its smallest ids, as many as any query can return and one more for the query
itself; a group of copies of any size therefore costs one distance, and no neighbour is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.common import store

PART_ROWS = 65_536      # distinct vectors of a part, at most on average
QUERY_ROWS = 65_536     # queries of a block
LEAST_PARTS = 16


def usable(table: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """``vec_id``, ``v`` (doubles) of the rows that take part, equal rows once: an id, and a vector that is not null or empty
    and has finite components only, not all zero unless ``zero``; of several lengths the most frequent one (the smaller
    of equals)."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = "size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).where("vec_id is not null").where(fine)
    if not zero:
        rows = rows.where("exists(v, x -> x != 0)")
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length.n if length else 0))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """``v`` and its ``ids`` smallest ids, ascending. Only those of each task are shuffled."""
    first = Window.partitionBy("v").orderBy("vec_id")
    few = rows.distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= ids)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def blocks(distinct: DataFrame, queries: DataFrame, part=None, part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``part`` and ``block``: every part of the vectors meets every block of the queries once."""
    n, q = distinct.count(), queries.count()
    parts, groups = max(1, -(-n // part_rows)), max(1, -(-q // QUERY_ROWS))
    left = (distinct if part is not None else distinct.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(parts)).cast("int")))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = (queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit((part or parts) - 1)))))
    return left, right


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def best_ids(order: np.ndarray, scores: np.ndarray, ids, query_id: int, k: int) -> list[tuple[int, float]]:
    """The first ``k`` (id, score) of distinct vectors in ``order`` (best first, equal scores together), ties by id."""
    out: list[tuple[int, float]] = []
    i = 0
    while i < len(order) and len(out) < k:
        j, tied = i, []
        while j < len(order) and scores[order[j]] == scores[order[i]]:
            tied += [int(x) for x in ids[order[j]] if x != query_id]
            j += 1
        out += [(x, scores[order[i]]) for x in sorted(tied)]
        i = j
    return out[:k]


def ranked(found: DataFrame, k: int, largest: bool, kind: str) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the best ``k`` of every query over all parts."""
    score = F.desc("score") if largest else F.asc("score")
    own = Window.partitionBy("query_id").orderBy(score, "vec_id")
    return (found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast(kind).alias("score")))


def stored_queries(rows: DataFrame, step: int) -> DataFrame:
    return store(rows.where(F.col("vec_id") % step == 0).distinct().select(F.col("vec_id").alias("query_id"), "v"), "queries")
