"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Each text becomes a short vector of statistics (shares of kinds of characters, word and line shapes, repetition), moved by
logarithms to scales on which the two classes are closer to Gaussian. Class means and covariances are sums over all
labelled rows, added up per partition and then on the driver (two classes of d + d*d numbers, whatever the input). Each
covariance is shrunk towards the pooled one, a share of the pooled variances is added to its diagonal, and its Cholesky factor
is kept with the model; a document's score is the logistic of the difference of its two log-densities and the log prior odds.

Defined results: a null text counts as an empty one; an empty text has the vector of zeros and is scored like any other; labels
other than 0 and 1 and null labels are not learned from; repeated rows count as often as they occur; with a class
missing in the learned rows (empty table) the score is the share of label 1 among them, or 0.5 without any; ties at the
threshold are 1. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from viewtide.llm.common import fold, fresh, store

POOL = 0.1         # shrinkage of a class covariance towards the pooled one
RIDGE = 0.02       # share of the pooled variances that is added to the diagonal
THRESHOLD = 0.3
FIT_ROWS = 50_000  # labelled rows that the pipeline's stage fits on, at most, by hash of the id
FOLDS = 5

_END = re.compile(r"[.!?](?=\s|$)")
_PUNCTUATION = ".,;:?!\"'()-"
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 0xC2)  # beyond ASCII, a lead byte is one letter
_MARK = (_BYTES > 32) & (_BYTES < 127) & ~(_LETTER | _DIGIT) & ~np.isin(_BYTES, list(b"_.,;:'\"()-"))

STATISTICS = (
    "log_words", "log_word_length", "word_length_spread", "upper", "marks", "digits", "letters", "distinct", "repeats",
    "top_word", "sentence_words", "line_words", "same_lines", "loose_marks", "ends_marked")


def _log_share(part: float, whole: float) -> float:
    return math.log1p(100.0 * part / whole) if whole else 0.0


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text, all zero for an empty one."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    counts = Counter(words)
    chars = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    lengths = np.fromiter(map(len, words), np.int64, n)
    repeats = sum(map(str.__eq__, words[1:], words))
    lines = [x for x in text.split("\n") if x.strip()]
    odd = [(w, c) for w, c in counts.items() if not w[-1].isalnum()]
    return [
        math.log1p(n),
        math.log1p(float(lengths.mean())),
        math.log1p(float(lengths.std())),
        _log_share(int(chars[_UPPER].sum()), size),
        _log_share(int(chars[_MARK].sum()), size),
        _log_share(int(chars[_DIGIT].sum()), size),
        _log_share(int(chars[_LETTER].sum()), size),
        math.log(len(counts) / n ** 0.8),
        _log_share(repeats, n),
        _log_share(max(counts.values()), n),
        math.log1p(n / (1 + len(_END.findall(text)))),
        math.log1p(n / max(1, len(lines))),
        _log_share(len(lines) - len(set(lines)), len(lines)),
        _log_share(sum(c for w, c in odd if not any(map(str.isalnum, w))), n),
        _log_share(sum(c for w, c in odd if w[-1] not in _PUNCTUATION), n),
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def statistics_of(text: pd.Series) -> pd.Series:
    return pd.Series([statistics(t) for t in text], dtype=object)


@dataclass(frozen=True)
class Model:
    """Means, inverse Cholesky factors and log-determinants of both classes, and the prior log odds."""

    means: tuple
    factors: tuple
    logdets: tuple
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), 1 / (1 + math.exp(-self.prior)))
        log = []
        for mean, factor, logdet in zip(self.means, self.factors, self.logdets):
            z = (x - mean) @ factor.T
            log.append(-0.5 * (np.einsum("ij,ij->i", z, z) + logdet))
        return 1 / (1 + np.exp(-np.clip(log[1] - log[0] + self.prior, -60, 60)))


def class_sums(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products of ``x`` for each ``y`` in 0 and 1."""
    d = len(STATISTICS)

    def partial(batches):
        total = {}
        for pdf in batches:
            for y, part in pdf.groupby("y"):
                x = np.stack(part["x"].to_numpy())
                n, s, q = total.get(y, (0, np.zeros(d), np.zeros((d, d))))
                total[y] = (n + len(x), s + x.sum(0), q + x.T @ x)
        for y, (n, s, q) in total.items():
            yield pd.DataFrame({"y": [int(y)], "k": [0], "v": [[float(n), *s.tolist(), *q.ravel().tolist()]]})

    parts = rows.mapInPandas(partial, "y int, k int, v array<double>")
    added = (parts.selectExpr("y", "posexplode(v) as (i, v)").groupBy("y", "i").agg(F.sum("v").alias("v")).collect())
    out = {}
    for y in (0, 1):
        v = np.array([r.v for r in sorted((r for r in added if r.y == y), key=lambda r: r.i)])
        if len(v):
            out[y] = (v[0], v[1:d + 1], v[d + 1:].reshape(d, d))
    return out


def fit(rows: DataFrame, pool: float = POOL, ridge: float = RIDGE) -> Model:
    """``rows``: ``x`` (statistics) and ``y`` (0 or 1). All rows count; only sums reach the driver."""
    sums = class_sums(rows)
    if len(sums) < 2:
        return Model((), (), (), 0.0 if not sums else (5.0 if 1 in sums else -5.0))
    d = len(STATISTICS)
    means = {y: s / n for y, (n, s, _) in sums.items()}
    scatter = {y: q - n * np.outer(means[y], means[y]) for y, (n, _, q) in sums.items()}
    total = sum(n for n, _, _ in sums.values())
    pooled = (scatter[0] + scatter[1]) / total
    variances = np.diag(pooled).clip(1e-6)
    factors, logdets = [], []
    for y in (0, 1):
        cov = (1 - pool) * scatter[y] / sums[y][0] + pool * pooled + ridge * np.diag(variances)
        root = np.linalg.cholesky(cov + 1e-6 * np.eye(d))
        factors.append(np.linalg.inv(root))
        logdets.append(2 * np.log(np.diag(root)).sum())
    return Model((means[0], means[1]), tuple(factors), tuple(logdets), math.log(sums[1][0] / sums[0][0]))


def scored(rows: DataFrame, model: Model, x_col: str, to: str) -> DataFrame:
    @F.pandas_udf(DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

    return rows.withColumn(to, score(F.col(x_col)))


def learned(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> DataFrame:
    """``x``, ``y`` of the labelled rows outside the held-out fold. ``stats``: the id and ``x``."""
    y = labels.select(F.col("doc_id").alias("y_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    return (stats.where(fold(F.col(id_col), FOLDS) != 0).join(y, F.col(id_col) == F.col("y_id")).select("x", "y"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row; statistics are computed once and stored."""
    stats = store(docs.select(F.col(id_col).alias("doc_id"), statistics_of(F.col(text_col)).alias("x")), "statistics")
    model = fit(learned(stats, labels))
    out = scored(stats, model, "x", "score")
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their columns.

    It is fitted on at most ``FIT_ROWS`` labelled rows; their ids are sent to all tasks, so no text is shuffled, and only
    those texts are read twice.
    """
    chosen = (labels.select(F.col("doc_id").alias("y_id"), F.col("quality").cast("int").alias("y"))
              .where("y in (0, 1) and y_id is not null").where(fold(F.col("y_id"), FOLDS) != 0).select("y_id").distinct()
              .orderBy(F.xxhash64("y_id"), "y_id").limit(FIT_ROWS))
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("y_id"), "left_semi")
    stats = store(known.select("doc_id", statistics_of(F.col("t")).alias("x")), "statistics")
    model = fit(learned(stats, labels))
    x, s = fresh(docs, "__x"), fresh(docs, "__score")
    out = scored(docs.withColumn(x, statistics_of(F.col(text_col))), model, x, s)
    return out.where(F.col(s) >= threshold).drop(x, s)
