import hashlib
import random

import numpy as np
import pytest

from viewtide.llm import suffixes

DDL = "doc_id bigint, text string, t1 string, n int, key double"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 0.5) for i, t in rows], DDL)


def brute(rows):
    seen, out = {}, []
    data = [(i, (t or "").encode()) for i, t in rows]
    for d, (_, b) in enumerate(data):
        for p in range(len(b) - 199):
            seen.setdefault(b[p:p + 200], []).append((d, p))
    marks = [bytearray(len(b)) for _, b in data]
    for places in seen.values():
        if len(places) > 1:
            for d, p in places:
                marks[d][p:p + 200] = b"\x01" * 200
    for (i, b), m in zip(data, marks):
        kept = bytes(x for x, gone in zip(b, m) if not gone)
        spans = sum(1 for k in range(len(m)) if m[k] and not (k and m[k - 1]))
        out.append((i, len(b), sum(m), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    """Shared passages between different surroundings and of lengths around the limit, overlapping ones, runs, copies, edits."""
    rng = random.Random(8)

    def words(n):
        return " ".join(rng.choice(["déjà", "vu", "alpha", "beta", "q"]) + str(rng.randrange(10_000)) for _ in range(n))

    passage = words(120)
    out = []
    for k in range(60):
        start, size = rng.randrange(300), rng.choice([150, 190, 199, 200, 201, 230, 400])
        out.append(words(rng.randrange(5, 60)) + passage[start:start + size] + words(rng.randrange(5, 40)))
    out += [passage, passage, passage[100:450], "ab" * 400, "ab" * 150 + "c", "z" * 199, "z" * 200, "z" * 260, None, "", "é" * 100,
            "é" * 120, "short", "short"]
    base = words(150)
    for _ in range(25):
        at = rng.randrange(len(base) - 10)
        out.append(base[:at] + str(rng.random()) + base[at:])
    return [(i if i % 9 else None, t) for i, t in enumerate(out)] + [(5, out[5]), (5, "other")]


def digests(df, **kw):
    return sorted((tuple(r) for r in suffixes.repeat_digests(df, **kw).collect()), key=str)


@pytest.mark.parametrize("batches", [1, 5])
def test_removed_bytes_match_brute_force(spark, rows, batches):
    assert digests(table(spark, rows), batches=batches) == brute(rows)


def test_pieces_and_crowds_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 700)
    spans = {(r.t1, r.t2): r.kept_sha256 for r in suffixes.without_repeats(table(spark, rows)).collect()}
    crowd = {(r.t1, r.t2): r.kept_sha256 for r in suffixes.without_repeats(table(spark, rows), crowd=3).collect()}
    assert spans == crowd and set(spans.values()) == {h for *_, h in brute(rows)}


def test_family_levels_grow_geometrically(spark, rows):
    texts = suffixes.named_texts(table(spark, rows), "text")
    family, found = suffixes.Family(), None
    for k in range(7):
        family.add(suffixes.suffixes(texts.where(f"pmod(t1, 7) = {k}")))
        sizes = [level.batches for level in family.levels]
        assert sum(sizes) == k + 1 and len(sizes) <= 4
    family.settle()
    assert [level.batches for level in family.levels] == [4, 2, 1]
    a, b, c = (level.rows.count() for level in family.levels)
    assert a > b > 0 and c > 0


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 256, 600).astype(np.uint8)
    heads = []
    for left, right in ((0, 0), (333, 50), (7, 400)):
        data = np.concatenate([rng.integers(0, 256, left), shared, rng.integers(0, 256, right)]).astype(np.uint8)
        first, last, key, _ = suffixes.anchors(data, np.zeros(1, np.int64))
        assert first[0] == 0 and last[-1] == len(data) - 200 and (first[1:] == last[:-1] + 1).all()
        of = np.repeat(key, last - first + 1)
        heads.append(of[left:left + 401])
    assert (heads[0] == heads[1]).all() and (heads[0] == heads[2]).all()


def test_ranks_are_those_of_sorted_strings():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 900).astype(np.uint8)
    data[500:800] = data[100:400]
    at = np.arange(701)
    strings = [data[i:i + 200].tobytes() for i in at]
    order = {s: k for k, s in enumerate(sorted(set(strings)))}
    assert suffixes.ranks(data, at).tolist() == [order[s] for s in strings]


def test_empty_table(spark):
    assert suffixes.repeat_digests(table(spark, [])).collect() == []
