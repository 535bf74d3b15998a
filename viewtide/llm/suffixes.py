"""Removal of long repeated byte strings: a logarithmic family of sparse suffix arrays.

Every window of ``LENGTH`` bytes has an anchor: the place in it whose ``HEAD`` bytes have the least hash. Anchors depend on the
window's bytes alone, so equal windows have equal anchors, and about one byte in 85 is one. The suffixes that start at
anchors form a sparse suffix array: distinct contexts (the bytes of all windows that share the anchor) with their counts, as
fingerprints, ordered by head and context. A new batch of texts gets such an array, is merge-scanned against all levels of
the family and becomes a level itself; before that, levels of equal size are merged, so n batches leave about log2(n)
levels and every suffix is rewritten about log2(n) times.

A scan finds contexts that occur again (the interior of any long match) and heads that occur in different contexts (its ends).
After the last batch the texts are read once more to place the former and to take the bytes of the latter, which are compared in
one go: a task builds the suffix array of the contexts that share heads and marks every window whose ``LENGTH`` bytes
equal a neighbour's. Contexts of a head with more than ``CROWD`` of them are compared by 128-bit fingerprints of their
windows instead, which Spark sums before the shuffle, so no head is collected in one task. Equal contexts are those with
equal 64-bit fingerprints and equal 64-bit heads; they are not compared again.

Defined results: null and empty texts have no bytes and nothing is removed; texts shorter than ``LENGTH`` are left alone; equal texts
lose everything from that length on; repeated rows and ids have a row each; texts of any length are read whole, in overlapping
pieces of at most ``PIECE`` bytes. What is removed depends on neither batches nor pieces. An empty table gives an empty
result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from viewtide.llm.common import forget, is_empty, join_counted, store
from viewtide.llm.phrases import Filter, Polynomial, Powers, mix

LENGTH = 200            # bytes of a repeated string
HEAD = 32
REACH = LENGTH - HEAD + 1
PIECE = 1 << 18
CROWD = 4_096           # contexts of a head that one task compares
BATCHES = 4
TEXT = ["t1", "t2"]     # 128-bit name of a text
CONTEXT = ["key", "c"]

_U = np.uint64
_RNG = np.random.default_rng(12)
_BYTE = _RNG.integers(0, 2**64, (3, 256), _U)
_POWERS = [Powers(int(b) | 1) for b in _RNG.integers(2**32, 2**63, 3, _U)]
_PLACE = _U((1 << 21) - 1)


# --- suffixes of a piece ---

def pieces(column: pa.Array):
    """Yield (bytes, starts, rows, offsets): runs of whole texts, or overlapping parts of one, of about ``PIECE`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"").cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + PIECE, "right")) - 1)
        if ends[b] - ends[a] <= PIECE:
            yield data[ends[a]:ends[b]], ends[a:b] - ends[a], np.arange(a, b), np.zeros(b - a, np.int64)
        else:
            for at in range(0, ends[b] - ends[a] - LENGTH + 1, PIECE):
                part = data[ends[a] + at:min(ends[b], ends[a] + at + PIECE + LENGTH - 1)]
                yield part, np.zeros(1, np.int64), np.array([a]), np.array([at], np.int64)
        a = b


def windows(size: int, starts: np.ndarray) -> np.ndarray:
    """Places of a piece at which a window starts that ends in the same text."""
    p = np.arange(max(0, size - LENGTH + 1))
    text = np.searchsorted(starts, p, "right") - 1
    ends = np.append(starts[1:], size)
    return p[p + LENGTH <= ends[text]]


def anchors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and last window, head and context fingerprint of every anchor of a piece."""
    p = windows(len(data), starts)
    if not len(p):
        return p, p, p, p
    at = np.arange(len(data) - HEAD + 1)
    heads = mix(Polynomial(_BYTE[0][data], _POWERS[0]).of(at, at + HEAD))
    ranked = (heads & ~_PLACE) | at.astype(_U)
    padded = np.full(-(-(len(at) + REACH) // REACH) * REACH, np.iinfo(_U).max, _U)
    padded[:len(at)] = ranked
    rows = padded.reshape(-1, REACH)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(onward[p], upto[p + REACH - 1]) & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1))))
    first, last = p[new], p[np.append(new[1:], len(p)) - 1]
    context = mix(Polynomial(_BYTE[1][data], _POWERS[1]).of(first, last + LENGTH))
    return first, last, heads[anchor[new]].view(np.int64), context.view(np.int64)


def contexts(first, last, key, context, text):
    """Of the anchors of a piece: one of each distinct context of a text, how often the text has it (at most 2), and the
    windows of those it has twice, joined where they touch (text, first, last)."""
    order = np.lexsort((first, context, key, text))
    cols = np.stack([c[order] for c in (text, key, context)])
    new = np.concatenate(([True], (cols[:, 1:] != cols[:, :-1]).any(axis=0)))
    size = np.diff(np.append(np.flatnonzero(new), len(order)))
    again = np.sort(order[np.repeat(size > 1, size)])
    apart = np.flatnonzero(np.concatenate((np.ones(min(1, len(again)), bool), (first[again][1:] > last[again][:-1] + 1)
                                           | (text[again][1:] != text[again][:-1]))))
    ends = last[again[np.append(apart[1:], len(again)) - 1]] if len(again) else again
    return order[new], np.minimum(size, 2), (text[again[apart]], first[again[apart]], ends)


def suffix_rows(batches):
    """``key``, ``c``, ``n`` of every context of a text."""
    for batch in batches:
        for data, starts, _, _ in pieces(batch.column("text")):
            first, last, key, context = anchors(data, starts)
            if len(first):
                one, n, _ = contexts(first, last, key, context, np.searchsorted(starts, first, "right") - 1)
                yield pa.RecordBatch.from_arrays([pa.array(key[one]), pa.array(context[one]), pa.array(n)], names=[*CONTEXT, "n"])


PLACED = pa.schema([*[(c, pa.int64()) for c in [*TEXT, "first", "last", *CONTEXT]], ("known", pa.bool_()), ("bytes", pa.binary())])


def placed_rows(again: Filter, disputed: Filter):
    """Function of batches of texts: the places of contexts that may be repeated, with their bytes where the head may be
    disputed; windows a text is known to repeat have no context."""
    def run(batches):
        for batch in batches:
            names = [batch.column(c).to_numpy() for c in TEXT]
            for data, starts, rows, offsets in pieces(batch.column("text")):
                first, last, key, context = anchors(data, starts)
                if not len(first):
                    continue
                text = np.searchsorted(starts, first, "right") - 1
                one, _, (t, f, e) = contexts(first, last, key, context, text)
                open_ = disputed.has(key[one])
                keep = again.has(context[one]) | open_
                one, open_ = one[keep], open_[keep]
                held = [data[first[i]:last[i] + LENGTH].tobytes() if o else None for i, o in zip(one, open_)]
                shift, none = offsets - starts, pa.nulls(len(t), pa.int64())
                for at, lo, hi, k, c, known, taken in (
                        (text[one], first[one], last[one], pa.array(key[one]), pa.array(context[one]), False, held),
                        (t, f, e, none, none, True, [None] * len(t))):
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(c_[rows[at]]) for c_ in names), pa.array(lo + shift[at]), pa.array(hi + shift[at]), k, c,
                         pa.array(np.full(len(at), known)), pa.array(taken, pa.binary())], schema=PLACED)

    return run


# --- the family ---

def named_texts(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({"t1": F.xxhash64(text), "t2": F.xxhash64(F.lit(LENGTH), text), "text": text})


def suffixes(texts: DataFrame) -> DataFrame:
    return texts.select("text").mapInArrow(suffix_rows, "key bigint, c bigint, n bigint")


@dataclass
class Level:
    """A sparse suffix array: distinct contexts with their counts, ordered by head and context."""
    batches: int
    rows: DataFrame


def merged(*arrays: DataFrame) -> DataFrame:
    """One suffix array of several (or of raw suffixes), counts added up."""
    rows = arrays[0]
    for more in arrays[1:]:
        rows = rows.unionByName(more)
    return store(rows.groupBy(*CONTEXT).agg(F.sum("n").alias("n")).sortWithinPartitions(*CONTEXT), "suffix-array")


def sieved(rows: DataFrame, column: str, held: Filter) -> DataFrame:
    """The rows whose ``column`` may be in a set; no row of the set is lost."""
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(held.has(batch.column(column).to_numpy())))

    return rows.mapInArrow(run, rows.schema)


class Family:
    """An index of all batches added so far: levels of geometrically growing size."""

    def __init__(self):
        self.levels: list[Level] = []

    def add(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Add the suffixes of a batch of texts. ``key``, ``c``, ``n`` of the contexts now known to occur more than once,
        and ``key`` of the heads in different contexts; both of this batch with itself or with earlier ones."""
        self.settle()
        array = merged(batch)
        rows = array.withColumn("new", F.col("n"))
        for level in self.levels:
            rows = rows.unionByName(level.rows.withColumn("new", F.lit(0).cast("bigint")))
        # The merge scan: first by heads alone, then the contexts of heads that are met again.
        heads = store(rows.groupBy("key").agg(F.sum("n").alias("n"), F.sum("new").alias("new"))
                      .where("n > 1 and new > 0").select("key"), "heads")
        met = store(sieved(rows, "key", Filter(heads, "key")).groupBy(*CONTEXT).agg(
            F.sum("n").alias("n"), F.sum("new").alias("new")), "scan")
        disputed = met.groupBy("key").agg(F.count("*").alias("contexts"), F.sum("new").alias("new"))
        self.levels.append(Level(1, array))
        forget(heads)
        return (met.where("n > 1 and new > 0").select(*CONTEXT, "n"),
                disputed.where("contexts > 1 and new > 0").select("key"))

    def settle(self) -> None:
        """Merge levels of equal size, smallest first."""
        while len(self.levels) > 1 and self.levels[-1].batches >= self.levels[-2].batches:
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(Level(a.batches + b.batches, merged(a.rows, b.rows)))
            forget(a.rows, b.rows)

    def drop(self) -> None:
        forget(*[level.rows for level in self.levels])
        self.levels = []


# --- comparison of contexts ---

def ranks(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rank of the ``LENGTH`` bytes from each place of ``at`` among all: a suffix array by doubling, equal strings equal."""
    size = len(data)

    def onward(values: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate((values[by:], np.zeros(min(by, size), values.dtype)))

    word = data.astype(_U)
    for by in (1, 2, 4):
        word = (word << _U(8 * by)) | onward(word, by)
    rank = np.unique(word, return_inverse=True)[1].astype(_U)
    width = 8
    while 2 * width <= LENGTH:
        rank = np.unique((rank << _U(32)) | onward(rank, width), return_inverse=True)[1].astype(_U)
        width *= 2
    return np.unique((rank[at] << _U(32)) | rank[at + LENGTH - width], return_inverse=True)[1]


def repeated_windows(rows: pd.DataFrame) -> pd.DataFrame:
    """``t1``, ``t2``, ``first``, ``last`` of the windows that occur twice in the contexts ``rows``, runs joined."""
    sizes = rows["bytes"].str.len().to_numpy()
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
    at = windows(len(data), starts)
    rank = ranks(data, at)
    at = at[np.bincount(rank)[rank] > 1]
    row = np.searchsorted(starts, at, "right") - 1
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(at)), bool), (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1]))))
    first, last = at[new], at[np.append(new[1:], len(at)) - 1] if len(at) else at
    row = row[new]
    shift = rows["first"].to_numpy()[row] - starts[row]
    out = pd.DataFrame({"t1": rows["t1"].to_numpy()[row], "t2": rows["t2"].to_numpy()[row], "first": first + shift, "last": last + shift})
    return out[rows["n"].to_numpy()[row] == 1]  # windows of the others are known


PLACE = "t1 bigint, t2 bigint, first bigint, last bigint"


def heads_in_task(frames):
    """Compare the contexts of a partition that is sorted by ``key``, whole heads at a time."""
    held = None
    for frame in frames:
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        open_key = held["key"].iloc[-1] if len(held) else None
        whole = held["key"] != open_key  # the last head may go on in the next frame
        if held.loc[whole, "bytes"].str.len().sum() >= PIECE:
            yield from compared_pieces(held[whole])
            held = held[~whole]
    if held is not None and len(held):
        yield from compared_pieces(held)


def compared_pieces(rows: pd.DataFrame):
    """Cut whole heads into pieces of about ``PIECE`` bytes (one head has at most ``CROWD`` contexts) and compare each."""
    rows = rows.reset_index(drop=True)
    ends = np.flatnonzero(np.append(rows["key"].to_numpy()[1:] != rows["key"].to_numpy()[:-1], True)) + 1
    total = rows["bytes"].str.len().cumsum().to_numpy()
    a = done = 0
    for b in ends:
        if total[b - 1] - done >= PIECE or b == len(rows):
            yield repeated_windows(rows.iloc[a:b].reset_index(drop=True))
            a, done = b, total[b - 1]


def window_prints(batches):
    """Fingerprint and place of every window of the contexts, once for equal windows of a batch."""
    for batch in batches:
        frame = batch.select([*TEXT, "first"]).to_pandas()
        for data, starts, rows, offsets in pieces(batch.column("bytes")):
            at = windows(len(data), starts)
            h1, h2 = (mix(Polynomial(_BYTE[k][data], _POWERS[k]).of(at, at + LENGTH)).view(np.int64) for k in (1, 2))
            text = np.searchsorted(starts, at, "right") - 1
            own = frame.iloc[rows[text]]
            out = pd.DataFrame({"h1": h1, "h2": h2, "t1": own["t1"].to_numpy(), "t2": own["t2"].to_numpy(),
                                "first": own["first"].to_numpy(),
                                "at": own["first"].to_numpy() + at - starts[text] + offsets[text], "n": 1})
            out["n"] = out.groupby(["h1", "h2"])["n"].transform("size")
            yield pa.RecordBatch.from_pandas(out.drop_duplicates(["h1", "h2"]), preserve_index=False)


def crowded_windows(rows: DataFrame) -> DataFrame:
    """The repeated windows of contexts whose heads have too many for one task: all but those that occur once."""
    prints = rows.select(*TEXT, "first", "bytes").mapInArrow(
        window_prints, "h1 bigint, h2 bigint, t1 bigint, t2 bigint, first bigint, at bigint, n bigint")
    once = (prints.groupBy("h1", "h2").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in (*TEXT, "first", "at")])
            .where("n = 1").groupBy(*TEXT, "first").agg(F.collect_list("at").alias("once")))  # of one context
    some = rows.where("n = 1").select(*TEXT, "first", "last").join(once, [*TEXT, "first"], "left")
    places = F.array_except(F.sequence("first", "last"), F.coalesce("once", F.array().cast("array<bigint>")))
    return some.select(*TEXT, F.explode(places).alias("first")).withColumn("last", F.col("first"))


def compared(found: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``t1``, ``t2``, ``first``, ``last`` of the windows that contexts of one head share with each other. ``found``: places with
    ``bytes``; one place of each context is compared, and windows are marked for contexts with no other."""
    place = [F.first(c).alias(c) for c in (*TEXT, "first", "last", "bytes")]
    some = store(found.groupBy(*CONTEXT).agg(F.count("*").alias("n"), *place), "contexts")
    crowded = some.groupBy("key").count().where(F.col("count") > crowd).select("key")
    # There are fewer such heads than contexts / crowd, but that grows with the data: no broadcast is asked for.
    few = some if is_empty(crowded) else some.join(crowded, "key", "left_anti")
    out = few.repartition("key").sortWithinPartitions("key").select("key", *TEXT, "first", "bytes", "n").mapInPandas(
        heads_in_task, PLACE)
    return out if few is some else out.unionByName(crowded_windows(some.join(crowded, "key", "left_semi")))


# --- results ---

def covered(places) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by the windows ``places``."""
    spans: list[list[int]] = []
    for first, last in sorted((p["first"], p["last"]) for p in places):
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], last + LENGTH)
        else:
            spans.append([first, last + LENGTH])
    return [tuple(s) for s in spans]


SPANS = ArrayType(StructType().add("start", LongType()).add("end", LongType()))


@F.pandas_udf(StructType().add("spans", SPANS).add("kept", BinaryType()).add("n_bytes", LongType()).add("kept_sha256", StringType()))
def cleaned(text: pd.Series, places: pd.Series) -> pd.DataFrame:
    out = []
    for t, ps in zip(text, places):
        data, at, kept = t.encode("utf-8", "surrogatepass"), 0, []
        spans = covered([] if ps is None else ps)
        for start, end in spans:
            kept.append(data[at:start])
            at = end
        rest = b"".join(kept) + data[at:]
        out.append(([{"start": s, "end": e} for s, e in spans], rest, len(data), hashlib.sha256(rest).hexdigest()))
    return pd.DataFrame(out, columns=["spans", "kept", "n_bytes", "kept_sha256"])


def distinct_texts(texts: DataFrame) -> DataFrame:
    return texts.groupBy(*TEXT).agg(F.first("text").alias("text"))


def repeated(docs: DataFrame, text_col: str = "text", batches: int = BATCHES, crowd: int = CROWD) -> DataFrame:
    """``t1``, ``t2``, ``places``: the repeated windows of every distinct text that has any."""
    texts = named_texts(docs, text_col)
    family, scans = Family(), []
    for k in range(batches):
        scans.append(family.add(suffixes(texts.where(F.pmod("t1", F.lit(batches)) == k))))
    family.drop()
    again, heads = (functools.reduce(DataFrame.unionByName, side) for side in zip(*scans))
    again = store(again.groupBy(*CONTEXT).agg(F.max("n").alias("n")), "repeated")
    heads = store(heads.distinct(), "disputed")
    shape = ", ".join(f"{c} bigint" for c in [*TEXT, "first", "last", *CONTEXT]) + ", known boolean, bytes binary"
    found = store(texts.select(*TEXT, "text").mapInArrow(placed_rows(Filter(again, "c"), Filter(heads, "key")), shape), "places")
    place = [*TEXT, "first", "last"]
    narrow = found.select(*place, *CONTEXT, "known")
    certain = join_counted(narrow.where("not known").drop("known"), again, CONTEXT, "n").select(*place)
    open_ = found.where("bytes is not null")
    places = certain.unionByName(narrow.where("known").select(*place)).unionByName(compared(open_, crowd)).distinct()
    return places.groupBy(*TEXT).agg(F.collect_list(F.struct("first", "last")).alias("places"))  # of one text


def without_repeats(docs: DataFrame, text_col: str = "text", batches: int = BATCHES, crowd: int = CROWD) -> DataFrame:
    """``t1``, ``t2``, ``spans`` (removed byte ranges), ``kept`` (bytes), ``n_bytes``, ``kept_sha256`` of every distinct text."""
    texts = named_texts(docs, text_col)
    return (distinct_texts(texts).join(repeated(docs, text_col, batches, crowd), TEXT, "left")
            .select(*TEXT, cleaned("text", "places").alias("c")).select(*TEXT, "c.*"))


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of every document."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    facts = without_repeats(docs, text_col, batches).select(
        *TEXT, "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")
    rows = named_texts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body")), "body").select("doc_id", *TEXT)
    copies = rows.groupBy(*TEXT).count()
    facts = store(facts.join(copies, TEXT), "kept")
    return join_counted(rows, facts, TEXT, "count").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLE_SQL = """
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT row, unnest(range(0, CAST(length(h) // 2 - 199 AS BIGINT))) AS p, h FROM docs WHERE length(h) >= 400),
windows AS MATERIALIZED (SELECT row, p, hash(substr(h, 2 * p + 1, 400)) AS w FROM starts),
again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hits AS (SELECT row, p, p - lag(p) OVER (PARTITION BY row ORDER BY p) AS gap FROM windows SEMI JOIN again USING (w)),
numbered AS (SELECT row, p, sum(CASE WHEN gap <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY row ORDER BY p) AS g FROM hits),
spans AS (SELECT row, g, min(p) AS a, max(p) + 200 AS b FROM numbered GROUP BY row, g),
before AS (SELECT row, a, b, coalesce(lag(b) OVER (PARTITION BY row ORDER BY a), 0) AS prev FROM spans),
cut AS (SELECT row, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS done,
               list((prev, a) ORDER BY a) AS gaps FROM before GROUP BY row),
kept AS (SELECT d.row, CASE WHEN c.row IS NULL THEN h ELSE
           array_to_string(list_transform(c.gaps, lambda g: substr(h, 2 * g[1] + 1, 2 * (g[2] - g[1]))), '')
           || substr(h, 2 * done + 1) END AS k FROM docs d LEFT JOIN cut c ON c.row = d.row)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM docs JOIN kept USING (row) LEFT JOIN cut USING (row)
"""
