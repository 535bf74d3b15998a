import numpy as np
import pytest

from viewtide.llm import lsh_forest, pivot_search
from viewtide.llm.vectors import usable

DDL = "vec_id bigint, embedding array<float>, label int, rank string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "r", "s")
                                  for i, v in rows], DDL)


def clustered(n, d=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, d))
    return (centres[rng.integers(0, 8, n)] + 0.4 * rng.standard_normal((n, d))).astype(np.float32)


def odd_rows(d=16):
    return [(5000, None), (5100, []), (5200, [0.0] * d), (5300, [1.0] * (d - 1) + [None]), (5400, [float("nan")] * d),
            (5500, [float("inf")] + [0.0] * (d - 1)), (5600, [1.0] * (d + 1)), (None, [1.0] * d)]


def by_query(rows):
    out = {}
    for r in rows:
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def good(rows, zero):
    out = {}
    for i, v in rows:
        if i is None or v is None or len(v) != 16 or any(c is None or not np.isfinite(c) for c in v):
            continue
        if zero or any(c != 0 for c in v):
            out[i] = np.array(v, np.float32).astype(float)
    return out


@pytest.fixture(scope="module")
def rows():
    x = clustered(900)
    out = [(i, v.tolist()) for i, v in enumerate(x)]
    return out + [(1000 + i, x[100].tolist()) for i in range(350)] + [(100, x[100].tolist())] * 3 + odd_rows()


def test_forest_recall_ties_and_copies(spark, rows):
    got = by_query(lsh_forest.nearest(table(spark, rows), k=10).collect())
    valid = good(rows, zero=False)
    ids, x = np.array(list(valid)), np.array(list(valid.values()))
    hit = total = 0
    assert sorted(got) == sorted(i for i in valid if i % 100 == 0)
    for q, found in got.items():
        d = np.sqrt(((x - valid[q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        want = ids[np.lexsort((ids, d))[:10]]
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(abs(s - d[ids == v][0]) < 1e-12 for _, v, s in found)
        hit += len(set(want) & {v for _, v, _ in found})
        total += 10
    assert hit / total >= 0.9
    assert [v for _, v, _ in got[100]] == list(range(1000, 1010))


def test_forest_is_a_prefix_search():
    """Exactly the vectors that share a long enough prefix in some tree, whatever the part's size."""
    x = clustered(300, seed=2).astype(float)
    forest = lsh_forest.Forest(x, trees=6)
    chosen = forest.candidates(x[:20], 60)
    assert (chosen.sum(axis=1) >= 60).all() and (chosen.sum(axis=1) < 300).any()
    for i in range(20):
        shared = np.zeros(300, int)
        for h, middle, keys, order in forest.trees:
            own = lsh_forest.strings(x[i:i + 1] @ h > middle)[0]
            bits = np.array([64 - int(own ^ k).bit_length() for k in keys])
            shared[order] = np.maximum(shared[order], bits)
        depth = max(d for d in range(65) if (shared >= d).sum() >= 60)
        assert (chosen[i] == (shared >= depth)).all()


@pytest.mark.parametrize("n", [400, 1500, 6000])
def test_forest_recall_with_vectors_left_out(n):
    """Without clusters, as in the given table, at several sizes: recall of the candidates, of which there are far fewer
    than vectors."""
    x = np.random.default_rng(n).standard_normal((n, 24))
    q = x[:60]
    mask = lsh_forest.Forest(x).candidates(q, int(np.ceil(lsh_forest.SHARE * n)))
    d = ((x[None] - q[:, None]) ** 2).sum(axis=2)
    d[np.arange(60), np.arange(60)] = np.inf
    recall = np.take_along_axis(mask, np.argsort(d, axis=1)[:, :10], axis=1).mean()
    assert recall >= 0.9 and mask.mean() < 0.6


def test_few_candidates_return_all(spark):
    few = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (7, [1.0, 1.0])]
    got = by_query(lsh_forest.nearest(table(spark, few), k=10).collect())
    assert [v for _, v, _ in got[0]] == [7, 100] and [v for _, v, _ in got[100]] == [7, 0]
    top = by_query(pivot_search.top_products(table(spark, few), k=20).collect())
    assert top[0] == [(1, 7, 4096), (2, 100, 0)]


def test_pivot_search_is_exact(spark, rows):
    got = by_query(pivot_search.top_products(table(spark, rows), k=20).collect())
    valid = good(rows, zero=True)
    ids, x = np.array(list(valid)), np.floor(64 * np.array(list(valid.values()))).astype(np.int64)
    assert sorted(got) == sorted(i for i in valid if i % 20 == 0)
    for q, found in got.items():
        s = x @ x[ids == q][0]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        assert found == [(n + 1, ids[i], s[i]) for n, i in enumerate(order)]


def test_pivot_search_over_many_small_annuli(spark, rows, monkeypatch):
    monkeypatch.setattr(pivot_search, "ANNULUS", 4)
    monkeypatch.setattr(pivot_search, "SAMPLE_ROWS", 30)
    test_pivot_search_is_exact(spark, rows)


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(0, None), (100, [])]):
        assert lsh_forest.nearest(table(spark, rows)).collect() == []
        assert pivot_search.top_products(table(spark, rows)).collect() == []


def test_most_frequent_length(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0]), (3, [1.0, 2.0, 4.0])]
    assert sorted(r.vec_id for r in usable(table(spark, rows), "vec_id", "embedding", True).collect()) == [2, 3]
