"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A source's share of all tokens is raised to an exponent between 0 (all sources alike) and 1 (as they are) and normalised.
The exponent is the smallest, found by bisection, at which the mixture's entropy does not exceed a target and no source is
repeated more often than a limit relative to the least repeated one. The weights are then realised: a source whose quota is
2.3 times its tokens is passed over twice in full, and a third pass takes 0.3 of its tokens. Every pass is a permutation of
the source's documents by a hash of row and pass; equal ranges of that hash are its blocks (about ``BLOCK_ROWS`` rows each).
The last, partial pass takes whole blocks in order while the budget lasts and ends inside one block, after the document
that reaches it.

Without a ``budget`` the total is the smallest with which every source is passed over at least once, so no document is
left out. Cuts are found from sums over (source, block) and the rows of one block per source; emitting is a join with
the table of sources and a generator, without moving texts.

Defined results: a null source is a source of its own; a null or empty text has no tokens and is in every full pass; a source
without tokens is passed over once; repeated rows are permuted together and all stay; an empty table gives an empty
result; other columns may have any names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.common import forget, row_hash, store

MAX_REPEATS = 1.5
BLOCK_ROWS = 4096
HALVINGS = 32
SEED = 11
UNITS = 1 << 53


@dataclass(frozen=True)
class Targets:
    """``entropy``: share of the largest possible entropy, not to be exceeded; ``repeats``: most passes over a source
    for one over the least repeated; ``budget``: total tokens."""

    entropy: float | None = None
    repeats: float | None = MAX_REPEATS
    budget: float | None = None


def token_count(text: Column) -> Column:
    """Words between white space; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def exponent(sources: DataFrame, targets: Targets) -> float:
    """Smallest exponent in [0, 1] that meets the targets. ``sources``: ``share``, positive. Four halvings a pass."""
    low, high = 0.0, 1.0

    def meets(points: list[float]) -> list[bool]:
        sums = []
        for a in points:
            w = F.pow("share", F.lit(a))
            sums += [F.sum(w), F.sum(w * F.log("share") * a), F.max(w / F.col("share")) / F.min(w / F.col("share"))]
        row = sources.agg(F.count("*").cast("double"), *[s.alias(f"s{i}") for i, s in enumerate(sums)],
                          F.log(F.count("*").cast("double")).alias("most")).first()
        out = []
        for i in range(len(points)):
            z, s, spread = row[1 + 3 * i:4 + 3 * i]
            if z is None:
                return [True] * len(points)
            entropy = math.log(z) - s / z
            out.append((targets.entropy is None or entropy <= targets.entropy * row["most"] + 1e-12)
                       and (targets.repeats is None or spread <= targets.repeats * (1 + 1e-12)))
        return out

    if meets([low])[0]:
        return low
    for _ in range(HALVINGS // 4):
        points = [low + (high - low) * k / 16 for k in range(1, 16)]
        ok = meets(points)
        first = ok.index(True) if True in ok else 15
        low, high = ([low] + points)[first], (points + [high])[first]
    return high


def permuted(row: Column, epoch: Column) -> Column:
    """Place of a row in the permutation of a pass, of ``UNITS`` places."""
    return F.shiftrightunsigned(F.xxhash64(row, epoch, F.lit(SEED)), 11)


def block_of(place: Column, blocks: Column) -> Column:
    return F.floor(place / F.lit(float(UNITS)) * blocks).cast("bigint")


def plan(narrow: DataFrame, targets: Targets) -> DataFrame:
    """A row per source: ``source``, ``tokens``, ``weight``, ``passes`` (real), ``whole`` (full passes), ``blocks`` and
    ``cut`` (last place of the partial pass, -1 for none). ``narrow``: ``source``, ``row``, ``tokens``."""
    counted = store(narrow.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "sources")
    total = counted.agg(F.sum("tokens")).first()[0] or 0
    some = counted.where("tokens > 0").withColumn("share", F.col("tokens") / float(max(total, 1)))
    power = exponent(some, targets)
    norm = some.agg(F.sum(F.pow("share", F.lit(power))), F.max(F.col("share") / F.pow("share", F.lit(power)))).first()
    z, most = norm[0] or 1.0, norm[1] or 1.0
    budget = targets.budget if targets.budget is not None else total * most * z
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / float(max(total, 1)), F.lit(power)) / z).otherwise(0.0)
    passes = F.when(F.col("tokens") > 0, F.round(F.col("weight") * float(budget) / F.col("tokens"), 9)).otherwise(1.0)
    sources = (counted.withColumn("weight", weight).withColumn("passes", passes)
               .withColumn("whole", F.floor("passes").cast("int"))
               .withColumn("rest", (F.col("passes") - F.col("whole")) * F.col("tokens"))
               .withColumn("blocks", F.ceil(F.col("rows") / BLOCK_ROWS)))
    sources = store(sources, "weights")
    placed = _at_sources(narrow, sources.where("rest > 0").select("source", "whole", "rest", "blocks"))
    placed = placed.withColumn("place", permuted(F.col("row"), F.col("whole")))
    placed = placed.withColumn("block", block_of(F.col("place"), F.col("blocks")))
    sums = placed.groupBy("source", "block").agg(F.sum("tokens").alias("t"), F.first("rest").alias("rest"))
    run = Window.partitionBy("source").orderBy("block")
    before = F.sum("t").over(run) - F.col("t")
    last = (sums.withColumn("before", before).where((F.col("before") < F.col("rest")) &
                                                    (F.col("before") + F.col("t") >= F.col("rest")))
            .select("source", "block", "before"))
    inside = (placed.join(last.withColumnsRenamed({"source": "s", "block": "b"}),
                          F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))))
    within = Window.partitionBy("source", "block").orderBy("place").rangeBetween(Window.unboundedPreceding, -1)
    cut = (inside.withColumn("ahead", F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
           .where("ahead < rest").groupBy(F.col("source").alias("c_source")).agg(F.max("place").alias("cut")))
    out = sources.join(cut, F.col("source").eqNullSafe(F.col("c_source")), "left")
    out = store(out.select("source", "tokens", "weight", "passes", "whole", "blocks",
                           F.coalesce("cut", F.lit(-1).cast("bigint")).alias("cut")), "mixture")
    forget(counted, sources)
    return out


def _at_sources(rows: DataFrame, sources: DataFrame, source_col: str = "source") -> DataFrame:
    own = sources.withColumnRenamed("source", "m_source")
    return rows.join(own, rows[source_col].eqNullSafe(own["m_source"])).drop("m_source")


def narrow_rows(docs: DataFrame, source_col: str, text_col: str, id_col: str = "doc_id") -> DataFrame:
    return store(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                             row_hash(docs).alias("row"), token_count(F.col(text_col)).alias("tokens")), "lengths")


def passes_of(rows: DataFrame, sources: DataFrame, row: str, source_col: str, epoch: str) -> DataFrame:
    """``rows`` once for every pass that takes them, with the columns of ``sources`` and ``epoch``."""
    partial = F.when(permuted(F.col(row), F.col("m.whole")) <= F.col("m.cut"), 1).otherwise(0)
    own = sources.select(F.struct("whole", "cut", "weight", "passes", "blocks").alias("m"), "source")
    joined = _at_sources(rows, own, source_col)
    times = F.col("m.whole") + partial
    return joined.where(times > 0).withColumn(epoch, F.explode(F.sequence(F.lit(0), times - 1)))


def mixture(docs: DataFrame, targets: Targets = Targets(), source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The order of the mixture: ``doc_id``, ``source``, ``tokens``, ``weight``, ``epoch``, ``block`` and ``place``, by
    which sorting interleaves all sources in proportion (0 to 1)."""
    narrow = narrow_rows(docs, source_col, text_col)
    out = passes_of(narrow, plan(narrow, targets), "row", "source", "epoch")
    at = permuted(F.col("row"), F.col("epoch"))
    return out.select("doc_id", "source", "tokens", F.col("m.weight").alias("weight"), "epoch",
                      block_of(at, F.col("m.blocks")).alias("block"),
                      ((F.col("epoch") + at / F.lit(float(UNITS))) / F.col("m.passes")).alias("place"))


def mixed(docs: DataFrame, targets: Targets = Targets(), source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, each row as often as the mixture takes it."""
    sources = plan(narrow_rows(docs, source_col, text_col, source_col), targets)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                         F.col(source_col).alias("source"), row_hash(docs).alias("row"))
    return passes_of(packed, sources, "row", "source", "epoch").select("doc.*")
