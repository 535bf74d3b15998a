"""K-d tree partitioning into shards of nearly equal bytes.

The items are groups of equal texts, with their bytes as weight, in a space of metadata dimensions (size, row id, language
and source). The tree starts with all items and all shards at the root. A node is split along its widest dimension at a
weighted median, or at the quantile that fits an odd number of shards, until every leaf is one shard, whose bytes are then
close to the target (all bytes over the number of shards). A group stays whole in one shard unless it alone is above
``SPLIT_SHARE`` of the target; such a group is cut into equal pieces by a hash of its rows, which may go to several shards.

The cut of a node is found exactly and without sorting: sums of bytes per node and bucket of the cut coordinate (16 bits a
pass, combined before the shuffle) give the bucket that holds the median, and the next pass looks into that bucket only.
What reaches the driver is one row for each node and pass, at most the number of shards. All work is DataFrame
expressions.

Defined results: size is the UTF-8 bytes of the text plus 16, a null text counts as an
empty one; null metadata is the lowest coordinate; repeated rows stay, each with its own slot; an empty table gives an
empty result; other columns are not looked at. With fewer items than shards some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.common import forget, store

SHARDS = 40
OVERHEAD = 16
SPLIT_SHARE = 0.25
SLOT_ROWS = 20_000      # rows of a shard that are numbered together
RADIX = 16
DIMENSIONS = ("c_size", "c_id", "c_lang", "c_source")
TOP = 2**31 - 1


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + OVERHEAD


def text_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Narrow rows: the text is read once, and only its size and hashes go on."""
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("group_hash"),
        F.crc32(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).cast("binary")).alias("lang_code"),
        F.crc32(F.coalesce(F.col(source_col).cast("string"), F.lit("")).cast("binary")).alias("source_code"))
    return store(rows, "shard-rows")


def _scaled(value: str, low: str, high: str) -> Column:
    """The value's place between two bounds, 0 to ``TOP``; nulls are lowest."""
    span = F.greatest(F.col(high) - F.col(low), F.lit(1.0))
    return F.coalesce((F.col(value) - F.col(low)) / span * F.lit(float(TOP)), F.lit(0.0)).cast("bigint")


def items(rows: DataFrame, target: float) -> tuple[DataFrame, DataFrame]:
    """(items with weight, coordinates and tie; rows with the item's key ``g``, ``piece``).

    Size and id coordinates are those of the group's first id, language and source of its smallest code; ``tie`` orders
    items of equal coordinates.
    """
    keyed = rows.withColumn("g", F.xxhash64("group_hash", "text_crc32", "size"))
    groups = keyed.groupBy("g").agg(
        F.sum("size").alias("bytes"), F.max("size").cast("double").alias("s"), F.min("doc_id").cast("double").alias("i"),
        F.min("lang_code").cast("double").alias("l"), F.min("source_code").cast("double").alias("o"))
    groups = store(groups.withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("bytes") / (target * SPLIT_SHARE))).cast("int")),
                   "shard-groups")
    large = groups.where("pieces > 1").select("g", "pieces")
    keyed = (keyed.join(large, "g", "left")
             .withColumn("piece", F.when(F.col("pieces").isNull(), 0).otherwise(
                 F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("pieces"))).cast("int")).drop("pieces"))
    keyed = store(keyed, "shard-keyed")
    weights = keyed.where(F.col("piece").isNotNull()).groupBy("g", "piece").agg(F.sum("size").alias("w"))
    bounds = groups.agg(*[f(c).alias(f"{n}_{c}") for c in "silo" for n, f in (("lo", F.min), ("hi", F.max))]).first()
    spread = groups
    for c in "silo":
        for n in ("lo", "hi"):
            spread = spread.withColumn(f"{n}_{c}", F.lit(float(bounds[f"{n}_{c}"] or 0.0)))
    placed = spread.select("g", *[_scaled(c, f"lo_{c}", f"hi_{c}").alias(d) for c, d in zip("silo", DIMENSIONS)])
    out = weights.join(placed, "g").withColumn("tie", F.xxhash64("g", "piece").bitwiseAND(0xFFFFFFFF))
    out = store(out, "shard-items")
    forget(groups)
    return out, keyed


def key_of(dim: str) -> Column:
    """Cut coordinate: 31 bits of the dimension, then 32 bits of the tie."""
    return F.shiftleft(F.col(dim), 32).bitwiseOR(F.col("tie"))


def _case(nodes: dict, value, default=None) -> Column:
    """Column of ``value(nodes[n])`` where the column ``node`` is n; at most one branch for each shard."""
    out = None
    for n, x in nodes.items():
        out = (F.when if out is None else out.when)(F.col("node") == n, value(x))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def cut_keys(level: DataFrame, open_nodes: dict[int, dict]) -> dict[int, int]:
    """For every node the largest key that goes left. ``level``: ``node``, ``key``, ``w``; a node holds ``goal`` bytes."""
    state = {n: {"prefix": 0, "before": 0.0, "goal": x["goal"]} for n, x in open_nodes.items()}
    for done in range(0, 64, RADIX):
        bits = 64 - RADIX - done
        inside = level
        if done:
            inside = level.where(F.shiftrightunsigned("key", 64 - done) == _case(state, lambda x: F.lit(x["prefix"]), -1))
        bucket = F.shiftrightunsigned("key", bits)
        sums = inside.groupBy("node", bucket.alias("bucket")).agg(F.sum("w").alias("w"))
        run = Window.partitionBy("node").orderBy("bucket")
        reached = F.sum("w").over(run) + _case(state, lambda x: F.lit(float(x["before"])), 0.0)
        goal = _case(state, lambda x: F.lit(float(x["goal"])), 0.0)
        found = (sums.withColumn("upto", reached)
                 .groupBy("node").agg(F.min(F.when(F.col("upto") >= goal, F.struct("bucket", "upto", "w"))).alias("hit"),
                                      F.max(F.struct("bucket", "upto", "w")).alias("last")).collect())
        for r in found:
            hit = r.hit or r.last
            state[r.node].update(prefix=hit.bucket, before=hit.upto - hit.w, at=hit.upto)
    out = {}
    for n, x in state.items():
        if "at" in x:  # the item at the median goes to the side that leaves the smaller error
            out[n] = x["prefix"] if x["at"] - x["goal"] <= x["goal"] - x["before"] else x["prefix"] - 1
    return out


def grow(weighted: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The items with ``node``, the shard of their leaf.

    A node is the number of its first shard; its left child keeps it, its right child starts where the left ends. The
    items are written once a level, so that a level's plan does not hold the levels above.
    """
    sizes = {0: shards}
    current = weighted.withColumn("node", F.lit(0))
    while any(s > 1 for s in sizes.values()):
        splitting = [n for n, s in sizes.items() if s > 1]
        measured = current.where(F.col("node").isin(splitting)).groupBy("node").agg(
            F.sum("w").alias("w"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).collect()
        open_nodes = {r.node: {"goal": r.w * (sizes[r.node] // 2) / sizes[r.node],
                               "dim": max(DIMENSIONS, key=lambda d: r[d])} for r in measured}
        if open_nodes:
            dims = {n: x["dim"] for n, x in open_nodes.items()}
            keyed = current.where(F.col("node").isin(list(dims))).select("node", "w", _case(dims, key_of).alias("key"))
            deeper = store(descend(current, dims, cut_keys(keyed, open_nodes), sizes), "shard-level")
            forget(current)
            current = deeper
        sizes = {m: k for n, s in sizes.items() for m, k in
                 (((n, s // 2), (n + s // 2, s - s // 2)) if s > 1 else ((n, s),))}
    return current


def descend(rows: DataFrame, dims: dict, cuts: dict, sizes: dict) -> DataFrame:
    """Move rows from their node to the child on their side of its cut."""
    step = _case({n: n for n in cuts}, lambda n: F.when(key_of(dims[n]) > F.lit(cuts[n]), sizes[n] // 2).otherwise(0), 0)
    return rows.withColumn("node", F.col("node") + step)


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` for every row."""
    rows = text_rows(docs, id_col, text_col, lang_col, source_col)
    total = rows.agg(F.sum("size")).first()[0] or 0
    weighted, keyed = items(rows, max(total / shards, 1.0))
    placed = grow(weighted, shards)
    # A group in one piece joins by its key; the pieces of a large group spread its rows over several keys.
    owner = placed.select("g", "piece", F.col("node").alias("shard"))
    assigned = store(keyed.join(owner, ["g", "piece"]).select("doc_id", "size", "text_crc32", "shard"), "shard-assigned")
    out = numbered(assigned)
    forget(rows, weighted, keyed, placed)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def numbered(assigned: DataFrame) -> DataFrame:
    """``slot`` from 0 without gaps in every shard: rows are numbered in sections of about ``SLOT_ROWS`` rows by hash of
    the id, and a section starts where the sections before it end."""
    most = assigned.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    sections = -(-most // SLOT_ROWS) or 1
    cut = assigned.withColumn("section", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(sections)).cast("int"))
    counts = cut.groupBy("shard", "section").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("section").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "section", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("shard", "section").orderBy("doc_id", "text_crc32", "size")
    return (cut.withColumn("at", F.row_number().over(own)).join(starts, ["shard", "section"])
            .withColumn("slot", (F.col("start") + F.col("at") - 1).cast("bigint")))
