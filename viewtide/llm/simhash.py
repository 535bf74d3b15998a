"""Near-duplicates: SimHash fingerprints, a binary-trie self-join under a Hamming budget, and the groups it links; for the
pipeline's stage also every two texts whose sets of five-word shingles have Jaccard similarity 0.8 or more.

The set of distinct fingerprints is a binary trie, never materialised: a node is a prefix, and below a task's size it is
a range of a sorted array. The self-join starts with the pair (root, root) and descends both nodes of a pair together.
A pair carries the number of bits in which its prefixes differ and is dropped as soon as that exceeds the budget. The top
levels are a Spark job over (prefix, count) tables, which ends for a pair when its two nodes together are small enough for
a task; each such pair is then finished inside one task over two sorted arrays.

SimHash cannot find the latter: at Jaccard 0.8 two fingerprints differ in about 10 of 64 bits, and a trie join at that
budget prunes nothing. ``keep_one`` therefore adds MinHash: distinct shingle sets meet in buckets of ``BANDS`` bands of
``BAND_ROWS`` values, which is expected to miss 0.04 % of the pairs at 0.8 and fewer above. A bucket's sets are first compared along a
chain by size, so a large group of copies costs one pair a copy. Where a bucket still holds several groups, blocks of its
sets meet in tasks, which find all sets with a likely neighbour in another group (signatures agree in at least ``LIKELY``) and
then decide every two of these on the shingles of their whole texts. They emit links that join groups, as a forest, and
nothing else. A bucket of k blocks is sent k - 1 times, and compared in k * (k - 1) / 2 tasks.

Defined results: a null or empty text has fingerprint zero, which is linked like any other; rows with equal fingerprints are
linked without a join; repeated rows stay, one result row for each; a null id takes part and yields a null component only
if its whole component has no id; an empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StructType

from viewtide.llm.common import forget, fresh, is_empty, row_hash, store, words_of

SEED = 42
BITS = 64
BUDGET = 3
SHINGLE = 3
STRIDE = 4              # trie levels that one Spark step descends
LEAF_ROWS = 131_072     # fingerprints below both nodes of a pair that one task takes
FRONTIER = 1 << 19      # node pairs a task expands at once

WORDS = 5               # shingles of the pipeline's stage
BANDS, BAND_ROWS = 20, 5
BLOCK = 1_024           # sets of a bucket that are compared with each other or with another block in one task
DENSE = 64              # sets with a shingle from which a task counts it by a matrix product
LIKELY = 0.6            # least agreement of two signatures; at Jaccard 0.8 it is lower once in a million pairs
_RNG = np.random.default_rng(SEED)
_FLIP, _ODD = (_RNG.integers(0, 2**64, (BANDS * BAND_ROWS, 1), np.uint64) for _ in range(2))
_ODD |= np.uint64(1)
_PLACE = _RNG.integers(0, 2**64, WORDS, np.uint64) | np.uint64(1)


# --- fingerprints ---

def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of the word shingles as a signed 64-bit number."""
    words = words_of(text)
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 65_536):
        part = hashes[start:start + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


@F.pandas_udf(LongType())
def fingerprints(text: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in text], dtype="int64")


def hex_of(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# --- the join inside a task ---

class Trie:
    """Sorted distinct fingerprints; a node at depth k is a range of equal k-bit prefixes."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values.astype(np.uint64))
        self._ones: dict[int, np.ndarray] = {}

    def middle(self, low: np.ndarray, high: np.ndarray, depth: int) -> np.ndarray:
        """Where the child 1 of each node starts: the node's end less its values with that bit set."""
        if depth not in self._ones:
            bit = (self.values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            self._ones[depth] = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
        ones = self._ones[depth]
        return high - (ones[high] - ones[low])


def trie_join(left: Trie, right: Trie, depth: int, differing: int, same: bool, budget: int = BUDGET):
    """Yield (i, j) index arrays of the linked values of two nodes; with ``same`` each unordered pair once."""
    if not len(left.values) or not len(right.values):
        return
    start = [np.array([v], np.int64) for v in (0, len(left.values), 0, len(right.values), differing)]
    stack = [(depth, start)]
    while stack:
        depth, frontier = stack.pop()
        a0, a2, b0, b2, d = frontier
        if len(d) > FRONTIER:
            half = len(d) // 2
            stack += [(depth, [x[half:] for x in frontier]), (depth, [x[:half] for x in frontier])]
            continue
        single = (a2 - a0 == 1) & (b2 - b0 == 1)
        if single.any():
            i, j = a0[single], b0[single]
            near = np.bitwise_count(left.values[i] ^ right.values[j]) <= budget
            if same:
                near &= i != j
            if near.any():
                yield i[near], j[near]
            a0, a2, b0, b2, d = (x[~single] for x in (a0, a2, b0, b2, d))
        if not len(d):
            continue
        a1, b1 = left.middle(a0, a2, depth), right.middle(b0, b2, depth)
        twin = (a0 == b0) if same else np.zeros(len(d), bool)  # a node with itself: its two mixed pairs are one
        parts = []
        for al, ah, bl, bh, more, skip in ((a0, a1, b0, b1, 0, None), (a1, a2, b1, b2, 0, None),
                                           (a0, a1, b1, b2, 1, None), (a1, a2, b0, b1, 1, twin)):
            keep = (ah > al) & (bh > bl) & (d + more <= budget)
            if skip is not None:
                keep &= ~skip
            if keep.any():
                parts.append([al[keep], ah[keep], bl[keep], bh[keep], d[keep] + more])
        if parts:
            stack.append((depth + 1, [np.concatenate(x) for x in zip(*parts)]))


def forest(left: np.ndarray, right: np.ndarray, chunks) -> tuple[list[int], list[int]]:
    """A spanning forest of links between positions of the concatenated arrays, as values; keeps every connection."""
    values = np.concatenate([left, right])
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    src, dst = [], []
    for i, j in chunks:
        for x, y in zip(i.tolist(), j.tolist()):
            p, q = root(x), root(y)
            if p != q:
                parent[p] = q
                src.append(x)
                dst.append(y)
    return values[src].view(np.int64).tolist(), values[dst].view(np.int64).tolist()


def join_pair(pdf: pd.DataFrame) -> pd.DataFrame:
    """Finish one pair of trie nodes. Columns depth, a, b (prefixes) and fp, the fingerprints below either."""
    depth, a, b = (int(pdf[c].iloc[0]) for c in ("depth", "a", "b"))
    fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
    prefix = (fp >> np.uint64(BITS - depth)) if depth else np.zeros(len(fp), np.uint64)
    left = Trie(fp[prefix == np.uint64(a)])
    right = left if a == b else Trie(fp[prefix == np.uint64(b)])
    pairs = trie_join(left, right, depth, (a ^ b).bit_count(), a == b)
    if a == b:
        links = forest(left.values, left.values[:0], pairs)
    else:
        shift = len(left.values)
        links = forest(left.values, right.values, ((i, j + shift) for i, j in pairs))
    return pd.DataFrame({"x": links[0], "y": links[1]}, dtype="int64")


# --- the descent in Spark ---

def prefix_of(fp, depth: int):
    return F.shiftrightunsigned(fp, BITS - depth) if depth else F.lit(0).cast("bigint")


def node_pairs(fps: DataFrame, budget: int = BUDGET, leaf_rows: int = LEAF_ROWS) -> list[tuple[int, DataFrame]]:
    """(depth, table of pairs a <= b) for every depth at which some pair is small enough. ``fps``: distinct ``fp``."""
    spark = fps.sparkSession
    pending = spark.sql("select 0L as a, 0L as b, 0 as d")
    ready, depth = [], 0
    while depth < BITS:
        depth += STRIDE
        nodes = fps.groupBy(prefix_of(F.col("fp"), depth).alias("node")).count()
        fan = 1 << STRIDE
        children = (pending.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(fan - 1))))
                    .withColumn("j", F.explode(F.sequence(F.when(F.col("a") == F.col("b"), F.col("i")).otherwise(F.lit(0)),
                                                          F.lit(fan - 1))))
                    .withColumn("d", F.col("d") + F.bit_count(F.col("i").bitwiseXOR(F.col("j"))))
                    .where(F.col("d") <= budget)
                    .select((F.col("a") * fan + F.col("i")).alias("a"), (F.col("b") * fan + F.col("j")).alias("b"), "d"))
        sized = (children.join(nodes.select(F.col("node").alias("a"), F.col("count").alias("na")), "a")
                 .join(nodes.select(F.col("node").alias("b"), F.col("count").alias("nb")), "b"))
        level = store(sized, f"trie-{depth}")
        small = F.lit(True) if depth == BITS else (F.col("na") + F.col("nb") <= leaf_rows)
        ready.append((depth, level.where(small).select("a", "b")))
        pending = level.where(~small).select("a", "b", "d")
        if is_empty(pending):
            break
    return ready


def fingerprint_links(fps: DataFrame, budget: int = BUDGET, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Links ``x``, ``y`` between distinct fingerprints with at most ``budget`` differing bits, as a spanning forest of
    each pair of trie nodes: every two linked fingerprints are connected in the result."""
    sides = []
    for depth, pairs in node_pairs(fps, budget, leaf_rows):
        pairs = pairs.withColumn("depth", F.lit(depth))
        at = fps.withColumn("node", prefix_of(F.col("fp"), depth))
        sides.append(at.join(pairs.withColumn("node", F.col("a")), "node").select("depth", "a", "b", "fp"))
        sides.append(at.join(pairs.where("a != b").withColumn("node", F.col("b")), "node").select("depth", "a", "b", "fp"))
    rows = sides[0]
    for more in sides[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("depth", "a", "b").applyInPandas(join_pair, "x bigint, y bigint")


# --- components ---

def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``links`` (``x``, ``y``).

    Alternating large-star and small-star steps over a stored edge table; each halves the depth of the trees, so the
    number of rounds is logarithmic. All sums and minima are combined before the shuffle.
    """
    edges = store(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u != v").distinct(),
                  "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))).distinct()
        after = store(small, "links")
        now = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        forget(edges)
        edges = after
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def fingerprint_groups(narrow: DataFrame) -> DataFrame:
    """``fp``, ``root`` (smallest fingerprint of its group) and ``first`` (smallest ``doc_id`` of the fingerprint's rows)."""
    per_fp = store(narrow.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    comp = components(fingerprint_links(per_fp.select("fp")))
    return (per_fp.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root"), "first"))


# --- shingle sets ---

def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles; a shorter text is one shingle, one without words none."""
    words = words_of(text)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    if len(words) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] * bool(words), np.uint64)
    h = np.zeros(len(words) - WORDS + 1, np.uint64)
    for k in range(WORDS):
        h += hashes[k:k + len(h)] * _PLACE[k]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(h ^ (h >> np.uint64(31)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values, the upper half of each."""
    low = np.full(len(_ODD), 2**64 - 1, np.uint64)
    for start in range(0, len(shingles), 1024):
        low = np.minimum(low, ((shingles[start:start + 1024] ^ _FLIP) * _ODD).min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets have Jaccard similarity 0.8 or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


@F.pandas_udf(StructType().add("fp", LongType()).add("sh", LongType()).add("n", IntegerType()).add("sig", BinaryType()))
def marks(text: pd.Series) -> pd.DataFrame:
    """Fingerprint; hash and size of the shingle set, and its signature."""
    found = []
    for t in text:
        s = shingle_set(t)
        sh = int.from_bytes(xxhash.xxh64_digest(s.tobytes(), SEED), "big", signed=True)
        found.append((fingerprint(t), sh, len(s), signature(s).tobytes()))
    return pd.DataFrame(found, columns=["fp", "sh", "n", "sig"])


@F.pandas_udf(BinaryType())
def shingle_bytes(text: pd.Series) -> pd.Series:
    return pd.Series([shingle_set(t).tobytes() for t in text], dtype=object)


@F.pandas_udf(BooleanType())
def likely(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([bool((np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)).mean() >= LIKELY)
                      for x, y in zip(a, b)], dtype=bool)


@F.pandas_udf(BooleanType())
def confirmed(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b)], dtype=bool)


def unlinked_sets(pdf: pd.DataFrame) -> pd.DataFrame:
    """The sets of a block beside which a set of another group has a likely similar signature."""
    group = pdf["root"].to_numpy()
    sig = np.stack([np.frombuffer(x, np.uint32) for x in pdf["sig"]])
    near = np.zeros(len(sig), bool)
    for i in range(len(sig)):
        others = np.flatnonzero(group != group[i])
        near[i] = bool(((sig[others] == sig[i]).mean(axis=1) >= LIKELY).any())
    return pdf.loc[near, ["bucket", "a", "b", "sh", "root"]]


def shared_changes(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Against the set of all shingles that most of ``sets`` hold: in how many shingles each differs, and how many of
    these differences each two have in common. Sets of one template differ from it in few."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, shingle, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count * 2 > m
    changes = np.bincount(owner[~common[shingle]], minlength=m) + common.sum() - np.bincount(owner[common[shingle]], minlength=m)
    shared = np.zeros((m, m), np.int32)
    order = np.argsort(shingle, kind="stable")
    ends = np.cumsum(count)
    few = (count > 1) & ~common & (count < DENSE)
    for e in np.flatnonzero(few):
        who = owner[order[ends[e] - count[e]:ends[e]]]
        shared[np.ix_(who, who)] += 1
    for kind in (common, ~common & (count >= DENSE)):
        places = np.flatnonzero(kind)
        for start in range(0, len(places), 1024):
            some = places[start:start + 1024]
            held = np.zeros((len(some), m), np.float32)
            for k, e in enumerate(some):
                held[k, owner[order[ends[e] - count[e]:ends[e]]]] = 1
            if kind is common:
                held = 1 - held
            shared += np.rint(held.T @ held).astype(np.int32)
    return changes, shared


def similar_sets(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between the sets of a block with Jaccard similarity 0.8 or more, as a spanning forest of those that join groups.

    x and y differ in changes(x) + changes(y) - 2 * shared(x, y) shingles, which decides for all pairs at once.
    """
    sh, root = pdf["sh"].to_numpy(), pdf["root"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
    size = np.array([len(s) for s in sets])
    changes, shared = shared_changes(sets)
    linked = 9 * (changes[:, None] + changes - 2 * shared) <= size[:, None] + size
    parent, fresh_ = np.full(len(sh), -1), np.ones(len(sh), bool)
    for start in range(len(sh)):
        if not fresh_[start]:
            continue
        fresh_[start], edge = False, np.array([start])
        while len(edge):
            reach = linked[edge] & fresh_
            new = np.flatnonzero(reach.any(axis=0))
            parent[new] = edge[reach[:, new].argmax(axis=0)]
            fresh_[new], edge = False, new
    child = np.flatnonzero(parent >= 0)
    child = child[root[child] != root[parent[child]]]
    x, y = sh[child], sh[parent[child]]
    return pd.DataFrame({"x": np.minimum(x, y), "y": np.maximum(x, y)}, dtype="int64")


def blocked(rows: DataFrame) -> DataFrame:
    """``rows`` of buckets with ``a``, ``b``: a bucket is cut into blocks of about ``BLOCK`` sets by a hash, and each two of its
    blocks, or its only one, are a task's share. A row of a bucket with k blocks comes k - 1 times."""
    sizes = rows.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("sh"), F.col("blocks")).cast("int")
    return (rows.join(sizes, "bucket").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .where("blocks = 1 or other != own")
            .withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other")).drop("own", "other", "blocks"))


def both_ends(pairs: DataFrame, sets: DataFrame, col: str) -> DataFrame:
    """``x``, ``y`` with ``col`` of either set as ``a`` and ``b``."""
    return (pairs.join(sets.select(F.col("sh").alias("x"), F.col(col).alias("a")), "x")
            .join(sets.select(F.col("sh").alias("y"), F.col(col).alias("b")), "y"))


def whole_sets(some: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``sh``, ``shingles`` of the distinct ``sh`` of ``some``, by the whole text of one row of each, stored."""
    rows = some.select("sh").distinct().join(sets, "sh").select("sh", F.col("w.doc_id").alias("w_id"), F.col("w.row").alias("w_row"))
    texts = docs.select(F.col(id_col).alias("d_id"), row_hash(docs).alias("d_row"), F.col(text_col).alias("text"))
    found = rows.join(texts, F.col("w_id").eqNullSafe(F.col("d_id")) & (F.col("w_row") == F.col("d_row")))
    return store(found.dropDuplicates(["sh"]).select("sh", shingle_bytes("text").alias("shingles")), "shingles")


def confirmed_links(pairs: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs ``x``, ``y`` of shingle sets with Jaccard similarity 0.8 or more."""
    near = store(both_ends(pairs, sets, "sig").where(likely("a", "b")).select("x", "y"), "likely")
    if is_empty(near):
        return near
    ends = near.select(F.col("x").alias("sh")).unionByName(near.select(F.col("y").alias("sh")))
    whole = whole_sets(ends, sets, docs, id_col, text_col)
    links = store(both_ends(near, whole, "shingles").where(confirmed("a", "b")).select("x", "y"), "similar")
    forget(near, whole)
    return links


def block_links(mixed: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Links ``x``, ``y`` that join groups within the buckets ``mixed`` (``bucket``, ``sh``, ``root``).

    No pair leaves a task unless it is such a link: the first pass over a block's signatures leaves sets, not pairs, and the
    second compares their shingles.
    """
    share = ["bucket", "a", "b"]
    near = store(blocked(mixed).join(sets.select("sh", "sig"), "sh").groupBy(*share).applyInPandas(
        unlinked_sets, "bucket bigint, a int, b int, sh bigint, root bigint"), "unlinked")
    if is_empty(near):
        return near.select(F.col("sh").alias("x"), F.col("sh").alias("y"))
    whole = whole_sets(near, sets, docs, id_col, text_col)
    links = store(near.join(whole, "sh").groupBy(*share).applyInPandas(similar_sets, "x bigint, y bigint").distinct(), "similar")
    forget(near, whole)
    return links


def set_groups(narrow: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node``, ``root`` of every shingle set that is linked with another, by fingerprint or by similarity."""
    of_fp = store(narrow.select("fp", "sh").distinct(), "sets-of-fingerprints")
    first = store(of_fp.groupBy("fp").agg(F.min("sh").alias("first")), "distinct")
    links = of_fp.join(first, "fp").select(F.col("sh").alias("x"), F.col("first").alias("y")).where("x != y")
    by_bits = (fingerprint_links(first.select("fp"))
               .join(first.select(F.col("fp").alias("x"), F.col("first").alias("a")), "x")
               .join(first.select(F.col("fp").alias("y"), F.col("first").alias("b")), "y"))
    links = links.unionByName(by_bits.select(F.col("a").alias("x"), F.col("b").alias("y")))

    width = BAND_ROWS * 4
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", k * width + 1, width)) for k in range(BANDS)])
    chain = Window.partitionBy("bucket").orderBy("n", "sh")
    dealt = sets.where("n > 0").select("sh", "n", F.explode(keys).alias("bucket"))
    shared = store(dealt.withColumn("before", F.lag("sh").over(chain)).withColumn("after", F.lead("sh").over(chain))
                   .where("before is not null or after is not null").select("bucket", "sh", "before"), "buckets")
    pairs = store(shared.where("before is not null")
                  .select(F.least("before", "sh").alias("x"), F.greatest("before", "sh").alias("y")).distinct(), "chains")
    comp = components(links.unionByName(confirmed_links(pairs, sets, docs, id_col, text_col)))

    named = shared.join(comp, F.col("sh") == F.col("node"), "left").select("bucket", "sh", F.coalesce("root", "sh").alias("root"))
    mixed = named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    more = block_links(named.join(mixed, "bucket", "left_semi"), sets, docs, id_col, text_col)
    if not is_empty(more):
        comp = components(comp.select(F.col("node").alias("x"), F.col("root").alias("y")).unionByName(more))
    forget(of_fp, first, shared, pairs)
    return comp


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``row`` (hash) and ``fp`` (signed) of every document, stored."""
    return store(docs.select(F.col(id_col).alias("doc_id"), row_hash(docs).alias("row"),
                             fingerprints(F.col(text_col)).alias("fp")), "fingerprints")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id of the group) for every document.

    The group of a fingerprint is found on distinct fingerprints; documents meet it in one join, which Spark may split.
    """
    narrow = near_duplicates(docs, id_col, text_col)
    per_fp = fingerprint_groups(narrow)
    smallest = per_fp.groupBy("root").agg(F.min("first").alias("component_id"))
    named = per_fp.join(smallest, "root").select("fp", "component_id")
    return narrow.join(named, "fp").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but the first of each group, by id (nulls last) and then by row hash. A group is
    linked by fingerprints or by Jaccard similarity of five-word shingles, as the module says.

    Winners are chosen on narrow rows; the texts are shuffled for the semi-join, and those of similar sets for comparison.
    Of rows equal in every column one stays.
    """
    narrow = store(docs.select(F.col(id_col).alias("doc_id"), row_hash(docs).alias("row"), marks(F.col(text_col)).alias("m"))
                   .select("doc_id", "row", "m.*"), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    sets = store(narrow.groupBy("sh").agg(F.min(order).alias("w"), F.min("n").alias("n"), F.min("sig").alias("sig")),
                 "sets")  # combined before any shuffle, whatever a group's size
    comp = set_groups(narrow, sets, docs, id_col, text_col).withColumnRenamed("node", "sh")
    first = (sets.select("sh", "w").join(comp, "sh", "left").groupBy(F.coalesce("root", "sh").alias("root"))
             .agg(F.min("w").alias("w"))
             .select(F.col("w.doc_id").alias("w_id"), F.col("w.row").alias("w_row")))
    row, n = fresh(docs, "__row"), fresh(docs, "__n")
    wide = docs.withColumn(row, row_hash(docs))
    kept = wide.join(first, wide[id_col].eqNullSafe(first["w_id"]) & (wide[row] == first["w_row"]), "left_semi")
    same = Window.partitionBy(row, id_col).orderBy(row)
    return kept.withColumn(n, F.row_number().over(same)).where(F.col(n) == 1).drop(row, n)
