import hashlib

import numpy as np
import pytest

from viewtide.llm import codes

DDL = "vec_id bigint, embedding array<float>, label int, code string, part int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, "c", 1)
                                  for i, v, y in rows], DDL)


def brute(rows, parts=8, entries=16, rounds=6, width=16):
    """The contract step by step on Python integers."""
    kept = []
    for i, v, y in rows:
        if v and len(v) == width and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            kept.append((i, [int(np.floor(4096 * float(np.float32(x)))) for x in v], y))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = width // parts
    cut = [[tuple(v[p * w:(p + 1) * w]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        picks = [[nearest(p, c[p])[0] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, k in zip(cut, picks) if k[p] == e]
                if mine:
                    books[p][e] = tuple(sum(x) // len(mine) for x in zip(*mine))
    out, by_label = [], {}
    for (i, _, y), c in zip(kept, cut):
        found = [nearest(p, c[p]) for p in range(parts)]
        error = sum(d for _, d in found)
        by_label[y] = by_label.get(y, 0) + error
        out.append((i, "".join(f"{k:02x}" for k, _ in found), error, y))
    text = ",".join(str(x) for book in books for e in book for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, c, e, by_label[y], digest) for i, c, e, y in out), key=str)


def vectors(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, 16))
    return (centres[rng.integers(0, 5, n)] + 0.3 * rng.standard_normal((n, 16))).astype(np.float32).tolist()


def rows_of(n):
    out = [(1000 - k, v, None if k % 7 == 0 else k % 3) for k, v in enumerate(vectors(n))]
    out += [(k, out[3][1], 1) for k in range(2000, 2040)]             # copies
    out += [out[5]] * 3 + [(None, vectors(1, 9)[0], 2)] * 2           # repeated rows, missing ids
    return out + [(1, None, 0), (2, [], 0), (3, [None] + [0.0] * 15, 0), (4, [float("nan")] * 16, 0),
                  (5, [float("-inf")] + [0.0] * 15, 0), (6, [0.5] * 24, 0), (7, [0.5] * 9, 0), (8, [1e9] * 16, 0)]


@pytest.mark.parametrize("block", [7, 256])
def test_codes_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(codes, "BLOCK", block)
    rows = rows_of(300)
    got = codes.vector_codes(table(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute([r for r in rows if r[0] != 8])


def test_few_empty_and_unusable(spark):
    few = rows_of(5)[:5]
    got = sorted((tuple(r) for r in codes.vector_codes(table(spark, few)).collect()), key=str)
    assert got == brute(few)
    assert codes.vector_codes(table(spark, [])).collect() == []
    assert codes.vector_codes(table(spark, [(1, None, 0), (2, [0.5] * 9, 0)])).collect() == []


def test_compress_decodes_near_the_input(spark):
    rows = [(k, v, 0) for k, v in enumerate(vectors(200))]
    coded, books = codes.compress(table(spark, rows))
    gaps = [np.abs(codes.decoded(r.codes, books) - rows[r.vec_id][1]).mean() for r in coded.collect()]
    assert len(gaps) == 200 and np.mean(gaps) < 0.35
    other, small = codes.compress(table(spark, rows), parts=4, entries=3, rounds=2)
    assert small.shape == (4, 3, 4) and all(len(r.codes) == 4 and max(r.codes) < 3 for r in other.collect())


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        at = codes.hilbert(grid, bits)
        assert sorted(at) == list(range(len(grid)))
        path = grid[np.argsort(at)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(4)
    book = rng.integers(-900, 900, (16, 3))
    points = rng.integers(-1000, 1000, (40, 20, 3)) // rng.integers(1, 40, (40, 1, 1))
    fit = codes.shortlists(points.min(axis=1), points.max(axis=1), book)
    d = ((points[:, :, None] - book) ** 2).sum(axis=3)
    for b in range(40):
        assert set(d[b].argmin(axis=1)) <= set(np.flatnonzero(fit[b]))
    assert 0.05 < fit.mean() < 0.9
