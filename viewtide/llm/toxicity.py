"""Toxicity by a weighted finite-state grammar over clauses.

A text is cut into clauses at sentence marks and line ends. Every word of a clause is read by five transducers: insults,
threats, targets, negations and reported speech. The insult transducer is a prefix automaton (a set of word stems) learned
from labelled texts on top of a fixed list; the others are fixed lists. Their outputs feed one automaton whose state holds what the
clause has said so far: a negation holds for the next few words, reported speech to the end of the clause, a target for
the whole clause. What the clause matches is a set of patterns (a targeted insult, a plain one, a negated or reported
one, a threat with a target ...); a document is the sum of its clauses' patterns, weighed by a logistic model whose weights
are learned from the same labelled texts. Words are never scored outside a clause.

Learning uses labelled rows outside the held-out fold, at most ``FIT_ROWS`` of them, by hash of the id; each group of
near copies counts once for the stems (smallest hash of its 5-word shingles), so that the words of a much copied text do not
look like evidence. Scoring is a map over rows: the model is a few thousand stems at most.

Defined results: a null or empty text has no clause and gets the base score, below the threshold; labels other than 0 and
1 are not learned from; without both classes among the learned rows the fixed weights are used; repeated rows count as
they occur; texts of any length are read whole, clause by clause; other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from viewtide.llm.common import fold, fresh, store

FOLDS = 5
THRESHOLD = 0.5
FIT_ROWS = 20_000       # labelled rows that stems and weights are learned from, at most
STEM_LENGTHS = range(3, 13)
STEM_SUPPORT = 8        # toxic texts, near copies aside, that a stem must occur in
STEM_ODDS = 12.0        # least ratio of its smoothed rates in toxic and other texts
STEMS = 4_000           # stems kept, best supported first
KEEP_SUPPORT = 0.9      # a stem grows while this share of its texts stays
NEGATION_REACH = 3      # words after a negation

# Starting lists of the transducers, in the corpus's languages.
INSULTS = ("clown", "disgusting", "dumb", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless",
           "dumm", "trottel", "versager", "imbécile", "débile", "estúpido", "imbécil")
THREATS = ("kill", "hurt", "destroy", "attack", "töten", "vernichten", "tuer", "détruire", "matar", "destruir")
TARGETS = ("you", "your", "he", "she", "they", "them", "du", "ihr", "sie", "er", "tu", "vous", "il", "elle", "usted", "él",
           "ella", "ellos")
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie", "pas", "jamais", "non",
             "nunca", "jamás")
REPORTS = ("said", "says", "called", "wrote", "claimed", "sagte", "nannte", "schrieb", "dit", "appelé", "écrit", "dijo",
           "llamó", "escribió")

_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]")
_BREAKS = frozenset(".!?;\n")
PATTERNS = ("insult_plain", "insult_targeted", "insult_negated", "insult_reported", "threat_targeted", "threat_plain")
#: Weights of the fixed model, for tables without labels: bias, then log1p of each pattern's count, then of its share.
DEFAULT = (-3.0, 4.0, 5.0, 1.0, 1.0, 4.0, 1.0, 0.5, 0.5, 0.0, 0.0, 0.5, 0.0)


def stem_of(word: str, stems: frozenset | set) -> str | None:
    """Run the prefix automaton over a word: the shortest stem that accepts it, a whole word ending in ``$``."""
    for n in STEM_LENGTHS:
        if n > len(word):
            break
        if word[:n] in stems:
            return word[:n]
    return word + "$" if word + "$" in stems else None


class Grammar:
    """The five transducers and the automaton of a clause."""

    INSULT, THREAT, TARGET, NEGATION, REPORT = 1, 2, 4, 8, 16

    def __init__(self, stems):
        self.stems = frozenset(stems) | {w + "$" for w in INSULTS}
        self.fixed: dict[str, int] = {}
        for bit, words in ((self.THREAT, THREATS), (self.TARGET, TARGETS), (self.NEGATION, NEGATIONS),
                           (self.REPORT, REPORTS)):
            for w in words:
                self.fixed[w] = self.fixed.get(w, 0) | bit
        self.seen: dict[str, int] = {}

    def output(self, word: str) -> int:
        """The union of the transducers' outputs for a word."""
        out = self.seen.get(word)
        if out is None:
            if len(self.seen) > 500_000:
                self.seen.clear()
            out = self.fixed.get(word, 0) | (self.INSULT if stem_of(word, self.stems) else 0)
            self.seen[word] = out
        return out

    def clause(self, outputs: list[int], counts: list[int]) -> None:
        """Run one clause through the automaton and add the patterns it accepts."""
        targeted = any(o & self.TARGET for o in outputs)
        reported, negated = False, 0
        for o in outputs:
            if o & self.REPORT:
                reported = True
            if o & self.NEGATION:
                negated = NEGATION_REACH + 1
            if o & self.INSULT:
                counts[2 if negated else 3 if reported else 1 if targeted else 0] += 1
            if o & self.THREAT and not negated and not reported:
                counts[4 if targeted else 5] += 1
            negated -= negated > 0

    def features(self, text: str | None) -> list[float]:
        """log1p of every pattern's count and of its share per 1000 words; all zero without a match."""
        counts = [0] * len(PATTERNS)
        tokens = _TOKEN.findall((text or "").lower())
        outputs = list(map(self.output, tokens))
        if any(o & (self.INSULT | self.THREAT) for o in outputs):
            start = 0
            for end in [i for i, t in enumerate(tokens) if t in _BREAKS] + [len(tokens)]:
                clause = outputs[start:end]
                if any(o & (self.INSULT | self.THREAT) for o in clause):
                    self.clause(clause, counts)
                start = end + 1
        return [math.log1p(c) for c in counts] + [math.log1p(1000 * c / max(1, len(tokens))) for c in counts]


@dataclass(frozen=True)
class Model:
    stems: tuple
    weights: tuple

    def score(self, features) -> np.ndarray:
        x = np.asarray(features, float).reshape(-1, 2 * len(PATTERNS))
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ np.array(self.weights[1:]), -60, 60)))


# --- learning ---

def copy_key(words: list[str]) -> int:
    """Smallest hash of the 5-word shingles: near copies mostly share it."""
    shingles = {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))}
    return min(xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) for s in shingles) >> 1


def candidates(text: str) -> set[str]:
    words = set(_TOKEN.findall(text.lower())) - _BREAKS
    out = {w + "$" for w in words}
    for w in words:
        out.update(w[:n] for n in STEM_LENGTHS if n <= len(w))
    return out


def fit_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, limit: int = FIT_ROWS) -> DataFrame:
    """``t``, ``y``: at most ``limit`` labelled rows outside the held-out fold, by hash of the id."""
    y = labels.select(F.col("doc_id").alias("y_id"), F.col("toxic").cast("int").alias("y")).where("y in (0, 1)")
    chosen = (y.where(fold(F.col("y_id"), FOLDS) != 0).where("y_id is not null").distinct()
              .orderBy(F.xxhash64("y_id"), "y_id", "y").limit(limit))
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null")
    return rows.join(F.broadcast(chosen), F.col("i") == F.col("y_id")).select("t", "y")  # limit rows of two numbers


def learn_stems(rows: DataFrame) -> tuple[list[str], float]:
    """Stems that speak for toxic texts. Counted over texts, each group of near copies once; sums are added in Spark."""

    def keyed(batches):
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["y"], "t": pdf["t"],
                                "k": [copy_key(_TOKEN.findall(t.lower())) for t in pdf["t"]]})

    one_each = (rows.mapInPandas(keyed, "y int, t string, k bigint").groupBy("y", "k")
                .agg(F.min_by("t", F.xxhash64("t")).alias("t")))

    def counted(batches):
        seen = {0: Counter(), 1: Counter()}
        size = Counter()
        for pdf in batches:
            for t, y in zip(pdf["t"], pdf["y"]):
                seen[y].update(candidates(t))
                size[y] += 1
        stems = list(seen[0].keys() | seen[1].keys())
        yield pd.DataFrame({"stem": [*stems, ""], "a": [*(seen[1][s] for s in stems), size[1]],
                            "b": [*(seen[0][s] for s in stems), size[0]]})

    sums = store(one_each.mapInPandas(counted, "stem string, a bigint, b bigint")
                 .groupBy("stem").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "stems")
    total = sums.where("stem = ''").first()
    if total is None or not total.a or not total.b:
        return [], 0.0
    rate = f"((a + 0.5) / {total.a + 1}) / ((b + 0.5) / {total.b + 1})"
    found = (sums.where(f"stem != '' and a >= {STEM_SUPPORT} and {rate} >= {STEM_ODDS}")
             .orderBy(F.desc("a"), F.length("stem"), "stem").limit(STEMS).collect())
    return choose_stems({r.stem: r.a for r in found}), total.a / (total.a + total.b)


def choose_stems(support: dict[str, int]) -> list[str]:
    """The shortest stems of the qualifying ones, each grown while it keeps its support.

    A stem that all its texts carry as one word becomes that whole word, so that it accepts no other words by chance.
    """
    kept: set[str] = set()
    for stem in sorted(support, key=lambda s: (len(s), s)):
        if stem_of(stem.removesuffix("$"), kept) is None:
            kept.add(stem)
    grown = {}
    for stem in kept:
        longer = [s for s in support if s.startswith(stem.removesuffix("$")) and support[s] >= KEEP_SUPPORT * support[stem]]
        grown[stem] = max(longer, key=lambda s: (len(s), s))
    return sorted(set(grown.values()))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton's method; the bias is not penalised."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * len(x) ** 0.5)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    rows = store(fit_rows(docs, labels, id_col, text_col), "toxic-fit")
    stems, share = learn_stems(rows)
    if not share:
        return Model((), DEFAULT)
    grammar = Grammar(stems)

    def features(batches):
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["y"], "x": [grammar.features(t) for t in pdf["t"]]})

    got = rows.mapInPandas(features, "y int, x array<double>").collect()  # FIT_ROWS short vectors at most
    x, y = np.array([r.x for r in got]), np.array([r.y for r in got], float)
    return Model(tuple(stems), tuple(logistic(x, y).tolist()))


# --- scoring ---

def scores(text_col, model: Model):
    """Column of scores of whole texts."""
    grammar = Grammar(model.stems)

    @F.pandas_udf(DoubleType())
    def run(text: pd.Series) -> pd.Series:
        return pd.Series(model.score([grammar.features(t) for t in text]) if len(text) else [], dtype="float64")

    return run(text_col)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` (1: toxic) for every row."""
    model = fit(docs, labels, id_col, text_col)
    out = docs.select(F.col(id_col).alias("doc_id"), scores(F.col(text_col), model).alias("score"))
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with their columns."""
    s = fresh(docs, "__toxic")
    model = fit(docs, labels, id_col, text_col)
    return docs.withColumn(s, scores(F.col(text_col), model)).where(F.col(s) < threshold).drop(s)
