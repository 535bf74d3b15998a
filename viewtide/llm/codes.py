"""Compression of vectors to short codes: product quantisation with exact integer k-means over Hilbert-sorted blocks.

A vector becomes integers floor(4096 * x) and is cut into equal parts. The vectors of each part position are sorted along a
Hilbert curve and cut into flat blocks of ``BLOCK`` neighbours, which store the smallest box around them and their sums.
In every round the least and the greatest distance from a block's box to each codebook entry leave a shortlist: an entry is
out when even its least distance exceeds another entry's greatest. A block with one entry left adds its stored sums
unseen; the others are evaluated against their shortlist by an integer kernel. Only partial sums per entry leave a
task, and only the codebooks (``entries`` times the vector's length) reach the driver.

Blocks are cut from a range partitioning by part, curve position and a hash, so any number of equal vectors is spread over
tasks; where the cuts fall changes the work and never a result.

Defined results: vectors that are null or empty, or hold null or non-finite components, take no part; neither do those with a
component of magnitude ``LIMIT`` or more, whose squared distances could leave 64 bits, nor those of another length than the
most frequent one divisible by the number of parts (the smaller of equals). A null id is kept and sorts last; rows that share
an id start the codebook in the order of their vectors; every repeated row has a result row. With fewer vectors than
entries the codebook has that many. Ties go to the lower index. Null labels are one label. An empty table gives an
empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.common import join_counted, store

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
BLOCK = 256             # vectors of a block, at most
LIMIT = 16_384.0        # greatest magnitude of a component
CURVE_BITS = 62         # bits of a position on the curve, at most


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on a Hilbert curve of points in a grid with ``2**bits`` cells a dimension (rows of ``cells``)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):        # undo the rotations of the coarser levels
        q, low = 1 << level, (1 << level) - 1
        for d in range(dims):
            up = (x[d] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(up, low, swap)
            x[d] ^= swap
    for d in range(1, dims):                    # Gray code
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << 1) | ((x[d] >> level) & 1)
    return out


def curve(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hilbert positions of integer points; the dimensions beyond the 62nd do not take part."""
    used = min(points.shape[1], CURVE_BITS)
    bits = max(1, min(8, CURVE_BITS // used))
    low, high = low[:used].astype(np.float64), high[:used].astype(np.float64)
    cells = (points[:, :used] - low) / np.maximum(high - low, 1) * (1 << bits)
    return hilbert(np.clip(cells, 0, (1 << bits) - 1).astype(np.int64), bits)


def integers(table: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> DataFrame:
    """``row`` (unique), ``vec_id``, ``label`` and ``v`` (integers) of the vectors that take part, stored."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < LIMIT))  # false for NaN and infinities
    rows = (table.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("raw"))
            .where(F.size("raw") > 0).withColumn("v", F.transform("raw", lambda x: x.cast("double"))).where(fine)
            .withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE).cast("int"))).drop("raw")
            .withColumn("row", F.monotonically_increasing_id()))
    kept = store(rows, "integers")
    sizes = kept.groupBy(F.size("v").alias("n")).count().where(F.col("n") % parts == 0)
    common = sizes.orderBy(F.desc("count"), "n").first()
    return kept.where(F.size(v) == (common.n if common else 0))


def flat(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def packed(rows: np.ndarray) -> pa.Array:
    """A matrix as one binary value a row."""
    rows = np.ascontiguousarray(rows)
    width = rows.itemsize * rows.shape[1]
    ends = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def unpacked(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def blocks_of(kept: DataFrame, parts: int, width: int) -> DataFrame:
    """``part``, ``n``, ``rows``, ``data``, ``low``, ``high``, ``sums`` of every block, stored."""
    sized = F.expr(f"transform(sequence(0, {parts * width - 1}), i -> struct(i, v[i] as x))")
    spans = (kept.select(F.explode(sized).alias("c")).groupBy("c.i").agg(F.min("c.x"), F.max("c.x"))
             .orderBy("i").collect())  # one row a dimension
    low = np.array([r[1] for r in spans]).reshape(parts, width)
    high = np.array([r[2] for r in spans]).reshape(parts, width)

    def placed(batches):
        for batch in batches:
            rows, v = batch.column("row"), flat(batch.column("v")).astype(np.int32)
            for p in range(parts):
                x = v[:, p * width:(p + 1) * width]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), p, np.int32)), pa.array(curve(x, low[p], high[p])), rows, packed(x)],
                    names=["part", "at", "row", "x"])

    def cut(batches):
        for batch in batches:
            part, row = batch.column("part").to_numpy(), batch.column("row").to_numpy()
            x = unpacked(batch.column("x"), np.int32, width)
            starts = [s for a, b in runs(part) for s in range(a, b, BLOCK)]
            ends = starts[1:] + [len(part)]
            if not starts:
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[starts]), pa.array(np.subtract(ends, starts).astype(np.int32)),
                 pa.array([row[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                 pa.array([x[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                 packed(np.minimum.reduceat(x, starts)), packed(np.maximum.reduceat(x, starts)),
                 packed(np.add.reduceat(x.astype(np.int64), starts))],
                names=["part", "n", "rows", "data", "low", "high", "sums"])

    points = kept.select("row", "v").mapInArrow(placed, "part int, at bigint, row bigint, x binary")
    order = ["part", "at", F.xxhash64("row")]
    return store(points.repartitionByRange(*order).sortWithinPartitions(*order).select("part", "row", "x").mapInArrow(
        cut, "part int, n int, rows binary, data binary, low binary, high binary, sums binary"), "blocks")


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of every run of equal values."""
    if not len(values):
        return []
    cuts = (np.flatnonzero(values[1:] != values[:-1]) + 1).tolist()
    return list(zip([0] + cuts, cuts + [len(values)]))


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Which entries of ``book`` may be nearest to a point of each box (blocks by entries)."""
    below, above = low[:, None, :].astype(np.int64) - book, book - high[:, None, :].astype(np.int64)
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
    most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
    return least <= most.min(axis=1, keepdims=True)


def nearest(points: np.ndarray, book: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest allowed entry (the lowest of equals) of every point, and the squared distance."""
    gaps = points[:, None, :].astype(np.int64) - book[allowed]
    d = np.einsum("ijk,ijk->ij", gaps, gaps)
    best = d.argmin(axis=1)
    return allowed[best], d[np.arange(len(d)), best]


def assigned(batch: pa.RecordBatch, books: np.ndarray, keep_points: bool):
    """Yield (block, part, entries, distances or None, points or None); None where one entry is left and the block's sums do."""
    part = batch.column("part").to_numpy()
    width = books.shape[2]
    low, high = (unpacked(batch.column(c), np.int32, width) for c in ("low", "high"))
    fit = np.zeros((len(part), books.shape[1]), bool)
    for p in np.unique(part):
        here = part == p
        fit[here] = shortlists(low[here], high[here], books[p])
    data = batch.column("data")
    for b in range(len(part)):
        allowed = np.flatnonzero(fit[b])
        if len(allowed) == 1 and not keep_points:
            yield b, part[b], allowed[0], None, None
        else:
            x = np.frombuffer(data[b].as_py(), np.int32).reshape(-1, width)
            entry, d = nearest(x, books[part[b]], allowed)
            yield b, part[b], entry, d, x


def next_books(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: assign every part vector, then replace each entry that has any by the floor of their mean."""
    parts, entries, width = books.shape

    def sums(batches):
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            stored, n = unpacked(batch.column("sums"), np.int64, width), batch.column("n").to_numpy()
            for b, p, entry, d, x in assigned(batch, books, False):
                if d is None:
                    total[p, entry] += stored[b]
                    count[p, entry] += n[b]
                else:
                    np.add.at(total[p], entry, x)
                    count[p] += np.bincount(entry, minlength=entries)
        p, e, i = (a.ravel().astype(np.int32) for a in np.indices(books.shape))
        used = count[p, e] > 0
        yield pa.RecordBatch.from_arrays([pa.array(a[used]) for a in (p, e, i, total.ravel(), count[p, e])],
                                         names=["p", "e", "i", "total", "n"])

    rows = (blocks.mapInArrow(sums, "p int, e int, i int, total bigint, n bigint")
            .groupBy("p", "e", "i").agg(F.sum("total"), F.sum("n")).collect())  # one row a component of the codebooks
    out = books.copy()
    for p, e, i, total, n in rows:
        out[p, e, i] = total // n
    return out


def trained(kept: DataFrame, blocks: DataFrame, parts: int, entries: int, rounds: int) -> np.ndarray:
    """The codebooks: parts by entries by positions."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    books = np.array([r.v for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    for _ in range(rounds):
        books = next_books(blocks, books)
    return books


def coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``row``, ``part``, ``entry``, ``error`` of every part vector."""

    def codes(batches):
        for batch in batches:
            rows = batch.column("rows")
            for b, p, entry, d, _ in assigned(batch, books, True):
                row = np.frombuffer(rows[b].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), pa.array(np.full(len(row), p, np.int32)), pa.array(entry.astype(np.int32)), pa.array(d)],
                    names=["row", "part", "entry", "error"])

    return blocks.mapInArrow(codes, "row bigint, part int, entry int, error bigint")


def compress(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``label``, ``codes`` (entry indexes in part order), ``error`` of every vector, stored; the codebooks."""
    kept = integers(table, id_col, vector_col, label_col, parts)
    one = kept.select(F.size("v")).first()
    if one is None:
        none = kept.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("bigint").alias("error"))
        return none, np.zeros((parts, 0, 0), np.int64)
    blocks = blocks_of(kept, parts, one[0] // parts)
    books = trained(kept, blocks, parts, entries, rounds)
    picks = [F.max(F.when(F.col("part") == p, F.col("entry"))) for p in range(parts)]
    per_row = coded(blocks, books).groupBy("row").agg(*[c.alias(f"c{p}") for p, c in enumerate(picks)], F.sum("error").alias("error"))
    out = kept.select("row", "vec_id", "label").join(per_row, "row")
    return store(out.select("vec_id", "label", F.array(*[f"c{p}" for p in range(parts)]).alias("codes"), "error"), "codes"), books


def decoded(codes: list[int], books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for, in the scale of the input."""
    return np.concatenate([books[p, c] for p, c in enumerate(codes)]) / SCALE


def vector_codes(table: DataFrame, **options) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error``, ``codebooks_sha256`` of every vector that takes part."""
    rows, books = compress(table, **options)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    totals = rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return join_counted(rows, totals, ["label"], "n").select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle() -> str:
    floor = "((s - ((s % n) + n) % n) // n)"
    steps = [f"""
    kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
             FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    comp AS MATERIALIZED (SELECT vec_id, (i - 1) // (len(v) // {PARTS}) AS p, (i - 1) % (len(v) // {PARTS}) AS pos, v[i] AS x
             FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM kept)),
    c0 AS MATERIALIZED (SELECT p, r - 1 AS e, pos, x FROM comp JOIN
             (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r FROM kept) USING (vec_id) WHERE r <= {ENTRIES})"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""
    a{r} AS MATERIALIZED (SELECT vec_id, p, e, d FROM
             (SELECT v.vec_id, v.p, c.e, sum((v.x - c.x) * (v.x - c.x)) AS d FROM comp v JOIN c{r} c ON v.p = c.p AND v.pos = c.pos
              GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1)""")
        if r < ROUNDS:
            steps.append(f"""
    c{r + 1} AS MATERIALIZED (SELECT c.p, c.e, c.pos, coalesce({floor}, c.x) AS x FROM c{r} c LEFT JOIN
             (SELECT p, e, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM comp JOIN a{r} USING (vec_id, p) GROUP BY ALL) m
             ON c.p = m.p AND c.e = m.e AND c.pos = m.pos)""")
    return f"""WITH {",".join(steps)},
    done AS (SELECT vec_id, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
             FROM a{ROUNDS} GROUP BY vec_id),
    digest AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, pos)) AS h FROM c{ROUNDS})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
    FROM done JOIN kept USING (vec_id), digest"""


ORACLE_SQL = _oracle()
