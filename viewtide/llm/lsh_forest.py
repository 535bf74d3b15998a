"""Approximate nearest neighbours by a forest of hash prefixes.

Each tree gives a vector a string of 64 bits, the sides of 64 hyperplanes through the median of the data, orthogonal as far as the
dimension allows. A tree is the sorted array of its strings. A query descends every tree to its longest prefix match; then
all trees ascend together, one bit at a time, and every vector that shares the prefix in any tree becomes a candidate,
until there are enough. Candidates are ranked by their exact distance.

The vectors are dealt over parts of bounded size by hash, each with its own forest; every query searches every part,
in blocks, and the best of all parts are merged. A part's number of candidates is ``SHARE`` of its vectors (one more than ``k``
at least), whatever its size: embeddings without cluster structure put true neighbours barely nearer than the rest, so a fixed number would lose
recall as the table grows. All vectors at the depth where the ascent ends are candidates; there is no cap.

Defined results: see ``vectors.usable`` for the rows that take part; a query with fewer candidates than ``k`` returns all of
them; equal vectors have distance 0 and rank by id; equal rows count once; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from viewtide.llm.common import store
from viewtide.llm.vectors import best_ids, blocks, distinct_vectors, matrix, ranked, stored_queries, usable

TREES = 160
BITS = 64
SHARE = 0.25
PART_ROWS = 8_192       # distinct vectors of a part, at most on average
SEED = 5
AT_ONCE = 256           # queries of one pass over a part


def planes(tree: int, dimension: int) -> np.ndarray:
    """``BITS`` directions, orthogonal in groups of ``dimension``."""
    rng = np.random.default_rng([SEED, tree])
    groups = [np.linalg.qr(rng.standard_normal((dimension, dimension)))[0] for _ in range(-(-BITS // dimension))]
    return np.concatenate(groups, axis=1)[:, :BITS]


def strings(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


class Forest:
    """Sorted strings of one part's vectors, a sorted array for each tree."""

    def __init__(self, x: np.ndarray, trees: int = TREES):
        self.x, self.trees = x, []
        for t in range(trees):
            h = planes(t, x.shape[1])
            side = x @ h
            middle = np.median(side, axis=0)
            keys = strings(side > middle)
            order = np.argsort(keys, kind="stable")
            self.trees.append((h, middle, keys[order], order))

    def candidates(self, q: np.ndarray, enough: int) -> np.ndarray:
        """Boolean (query, vector): the synchronous ascent from the longest matches."""
        n = len(self.x)
        chosen = np.zeros((len(q), n), bool)
        if enough >= n:
            chosen[:] = True
            return chosen
        found = [strings(q @ h > middle) for h, middle, _, _ in self.trees]
        open_ = np.arange(len(q))
        last: list = [None] * len(self.trees)
        for depth in range(BITS, 0, -1):
            rest = np.uint64(BITS - depth)
            full = (np.uint64(1) << rest) - np.uint64(1)
            for t, (_, _, keys, order) in enumerate(self.trees):
                low = np.searchsorted(keys, found[t] & ~full, "left")
                high = np.searchsorted(keys, found[t] | full, "right")
                before = last[t]
                grown = open_[(high - low)[open_] > (0 if before is None else (before[1] - before[0])[open_])]
                for i in grown:
                    chosen[i, order[low[i]:high[i]]] = True
                last[t] = (low, high)
            open_ = open_[chosen[open_].sum(axis=1) < enough]
            if not len(open_):
                return chosen
        chosen[open_] = True
        return chosen


def search(k: int, trees: int = TREES, share: float = SHARE):
    """Function of a part's vectors and a block of queries: the part's ``k`` best candidates of each query."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x, ids = matrix(left["v"]), left["ids"].to_numpy()
            forest = Forest(x, trees)
            enough = max(k + 1, int(np.ceil(share * len(x))))
            queries, names = matrix(right["v"]), right["query_id"].to_numpy()
            for start in range(0, len(names), AT_ONCE):
                q = queries[start:start + AT_ONCE]
                for i, mask in enumerate(forest.candidates(q, enough)):
                    rows = np.nonzero(mask)[0]
                    d = np.sqrt(((x[rows] - q[i]) ** 2).sum(axis=1))
                    near = np.argsort(d, kind="stable") if len(d) <= k + 1 else _nearest(d, k + 1)
                    name = int(names[start + i])
                    out += [(name, v, s) for v, s in best_ids(near, d, ids[rows], name, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def _nearest(d: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` smallest values and of all that equal the last, in order."""
    limit = np.partition(d, k - 1)[k - 1]
    rows = np.nonzero(d <= limit)[0]
    return rows[np.argsort(d[rows], kind="stable")]


def nearest(table: DataFrame, k: int = 10, step: int = 100, id_col: str = "vec_id", vector_col: str = "embedding",
            trees: int = TREES, share: float = SHARE) -> DataFrame:
    """The ``k`` nearest rows found of every row whose id is divisible by ``step``: ``query_id``, ``rank``, ``vec_id``,
    ``score`` (Euclidean distance)."""
    rows = usable(table, id_col, vector_col, zero=False)
    queries = stored_queries(rows, step)
    left, right = blocks(store(distinct_vectors(rows, k + 1), "vectors"), queries, part_rows=PART_ROWS)
    keys = ["part", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search(k, trees, share), "query_id bigint, vec_id bigint, score double")
    return ranked(found, k, largest=False, kind="double")
