"""Exact top-k inner products by a pivot-distance index.

The largest inner product is a nearest neighbour after one more coordinate: with M the largest norm, x becomes
(x, sqrt(M*M - |x|*|x|)) and a query (q, 0), and the squared distance is |q|*|q| + M*M - 2 q.x. Every vector is keyed by its
nearest pivot and its distance to it; the table is range-partitioned by that key, so a part holds annuli around few pivots,
sorted by distance, and a crowded pivot is cut into several parts. A query knows a lower bound of its k-th score from a
bounded sample; in a part it starts at the annulus that its own distance to the pivot falls in and expands inwards and
outwards. By the triangle inequality an annulus at pivot distances [a, b] holds nothing nearer than the gap between [a, b]
and the query's pivot distance, so the expansion stops where that gap passes the radius of the k-th score so far.

Components are floor(64 * x) as integers; inner products are computed in doubles where they are exact there, else in 64-bit
integers. Bounds are taken with a margin, so rounding never drops a result.

Defined results: see ``vectors.usable`` for the rows that take part (zero vectors do); with fewer candidates than ``k`` all
are returned; equal integer vectors rank by id; equal rows count once; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from viewtide.llm.common import store
from viewtide.llm.vectors import (LEAST_PARTS, PART_ROWS, best_ids, blocks, distinct_vectors, matrix, ranked,
                                  stored_queries, usable)

SCALE = 64
PIVOTS = 32
SAMPLE_ROWS = 4096      # distinct vectors that pivots and first thresholds come from, at most
ANNULUS = 256           # vectors of an annulus inside a part
AT_ONCE = 512
MARGIN = 1e-7           # relative


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """The further coordinate of vectors with norms up to ``top``."""
    return np.column_stack([x, np.sqrt(np.maximum(top * top - (x * x).sum(axis=1), 0.0))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def choose_pivots(sample: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Farthest-first points of the sample."""
    chosen = [0]
    gap = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(count, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def products(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    return q @ x.T if exact else q.astype(np.int64) @ x.astype(np.int64).T


KEY = StructType([StructField("pivot", IntegerType()), StructField("dist", DoubleType())])


def search(k: int, pivots: np.ndarray, top: float, sample: np.ndarray, exact: bool):
    """Function of a part (sorted into annuli) and a block of queries: scores of the part that can be among the ``k`` best."""
    def thresholds(q: np.ndarray, names: np.ndarray) -> np.ndarray:
        scores = products(q, sample, exact)
        out = np.full(len(q), -np.inf)
        if len(sample) > k:  # one may be the query itself
            out = np.partition(scores, len(sample) - k - 1, axis=1)[:, len(sample) - k - 1].astype(float)
        return out

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            left = left.sort_values(["pivot", "dist"], kind="stable")
            x, ids, dist = matrix(left["v"]), left["ids"].to_numpy(), left["dist"].to_numpy()
            annuli = []
            for p, rows in left.groupby("pivot", sort=True).indices.items():
                low, high = rows.min(), rows.max() + 1
                annuli += [(int(p), s, min(s + ANNULUS, high)) for s in range(low, high, ANNULUS)]
            own, first, last = (np.array(c) for c in zip(*annuli))
            inner, outer = dist[first], dist[last - 1]
            queries, names = matrix(right["v"]), right["query_id"].to_numpy()
            for start in range(0, len(names), AT_ONCE):
                q, name = queries[start:start + AT_ONCE], names[start:start + AT_ONCE]
                norm = (q * q).sum(axis=1) + top * top
                at = distances(np.column_stack([q, np.zeros(len(q))]), pivots)[:, own]
                gap = np.maximum(np.maximum(inner[None] - at, at - outer[None]), 0.0)
                least = thresholds(q, name)
                best = np.full((len(q), k + 1), -np.inf)
                kept: list[list] = [[] for _ in range(len(q))]
                for step in np.argsort(gap.min(axis=0), kind="stable"):
                    radius = np.sqrt(np.maximum(norm - 2 * least, 0.0)) if k else np.zeros(len(q))
                    live = np.nonzero(gap[:, step] <= radius * (1 + MARGIN) + MARGIN)[0]
                    if not len(live):
                        continue
                    a, b = first[step], last[step]
                    scores = products(q[live], x[a:b], exact)
                    hit = scores >= least[live][:, None]
                    for row in np.nonzero(hit.any(axis=1))[0]:
                        i, cols = live[row], np.nonzero(hit[row])[0]
                        kept[i].append((cols + a, scores[row, cols]))
                        merged = np.concatenate([best[i], scores[row, cols]])
                        best[i] = np.partition(merged, len(merged) - k - 1)[-k - 1:]
                        least[i] = max(least[i], best[i].min())
                for i, parts in enumerate(kept):
                    if parts:
                        rows, s = (np.concatenate(c) for c in zip(*parts))
                        good = s >= least[i]
                        rows, s = rows[good], s[good]
                        out += [(int(name[i]), v, int(c)) for v, c in
                                best_ids(np.argsort(-s, kind="stable"), s, ids[rows], int(name[i]), k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def top_products(table: DataFrame, k: int = 20, step: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
                 scale: int = SCALE) -> DataFrame:
    """The ``k`` largest inner products of every row whose id is divisible by ``step`` with all other rows: ``query_id``,
    ``rank``, ``vec_id``, ``score`` (long)."""
    whole = usable(table, id_col, vector_col, zero=True).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"))
    queries = stored_queries(whole, step)
    distinct = store(distinct_vectors(whole, k + 1), "vectors")
    size = distinct.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    n, square = size.n, size.m or 0.0
    if not n:
        return distinct.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    picked = distinct.orderBy(F.xxhash64("v"), "v").limit(SAMPLE_ROWS).collect()
    sample = np.array([r.v for r in picked], np.float64)
    top = float(np.sqrt(square)) * (1 + 1e-12)
    pivots = choose_pivots(lifted(sample, top))

    @F.pandas_udf(KEY)
    def key(v: pd.Series) -> pd.DataFrame:
        d = distances(lifted(matrix(v), top), pivots)
        near = d.argmin(axis=1)
        return pd.DataFrame({"pivot": near.astype("int32"), "dist": d[np.arange(len(d)), near]})

    parts = max(LEAST_PARTS, -(-n // PART_ROWS))
    keyed = store(distinct.withColumn("key", key("v")), "keyed").select("v", "ids", "key.*")
    index = store(keyed.repartitionByRange(parts, "pivot", "dist", F.xxhash64("v"))
                  .withColumn("part", F.spark_partition_id()), "annuli")
    found_parts = (index.agg(F.max("part")).first()[0] or 0) + 1
    left, right = blocks(index, queries, part=found_parts)
    keys = ["part", "block"]
    run = search(k, pivots, top, sample, square < 2.0 ** 52)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        run, "query_id bigint, vec_id bigint, score bigint")
    return ranked(found, k, largest=True, kind="bigint")
