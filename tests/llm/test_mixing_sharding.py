import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from viewtide.llm import mixing, sharding
from viewtide.llm.mixing import Targets

DDL = "doc_id bigint, text string, lang string, source string, epoch int, m string, whole string, shard int, size string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, s, 1, "m", "w", 2, "z") for i, t, g, s in rows], DDL)


def corpus():
    rows = [(i, "w " * (i % 7 + 1), "en", "big") for i in range(300)]
    rows += [(1000 + i, "w " * 5, "de", "mid") for i in range(60)] + [(2000 + i, "w w", None, "small") for i in range(20)]
    return rows + [(3000, "x y z", "en", None), (3001, None, "en", "none"), (3002, "", "en", "none"), (None, "a b", "fr", "big"),
                   (0, "w ", "en", "big"), (0, "w ", "en", "big")]


def tokens(rows):
    out = Counter()
    for _, t, _, s in rows:
        out[s] += len((t or "").split())
    return out


def smallest_exponent(share, repeats, entropy):
    def meets(a):
        w = {s: p ** a for s, p in share.items()}
        z = sum(w.values())
        h = -sum(x / z * math.log(x / z) for x in w.values())
        r = [w[s] / share[s] for s in share]
        return ((repeats is None or max(r) / min(r) <= repeats * (1 + 1e-12))
                and (entropy is None or h <= entropy * math.log(len(share)) + 1e-12))
    if meets(0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (low, mid) if meets(mid) else (mid, high)
    return high


@pytest.mark.parametrize("repeats,entropy", [(1.5, None), (None, 0.8), (3.0, 0.9), (None, None)])
def test_weights_and_passes(spark, repeats, entropy):
    rows = corpus()
    got = defaultdict(list)
    for r in mixing.mixture(docs(spark, rows), Targets(entropy, repeats)).collect():
        got[r.source].append(r)
    have = {s: n for s, n in tokens(rows).items() if n}
    total = sum(have.values())
    share = {s: n / total for s, n in have.items()}
    a = smallest_exponent(share, repeats, entropy)
    z = sum(p ** a for p in share.values())
    budget = max(have[s] / (share[s] ** a / z) for s in have)
    for s, n in have.items():
        weight = share[s] ** a / z
        assert got[s][0].weight == pytest.approx(weight, rel=1e-6)
        emitted = sum(r.tokens for r in got[s])
        assert 0 <= emitted - weight * budget + 1e-6 * n < 8 + 1e-6 * n, s
    ids = {r.doc_id for v in got.values() for r in v}
    assert ids == {r[0] for r in rows} and len(got["none"]) == 2
    times = Counter((s, r.doc_id) for s, v in got.items() for r in v)
    assert max(times[s, i] for s, i in times if s == "mid") - min(times[s, i] for s, i in times if s == "mid") <= 1


def test_budget_cuts_sources(spark):
    rows = corpus()
    got = Counter()
    for r in mixing.mixture(docs(spark, rows), Targets(None, None, 400)).collect():
        got[r.source] += r.tokens
    have = {s: n for s, n in tokens(rows).items() if n}
    assert all(0 <= got[s] - 400 / len(have) < 8 for s in have)


def test_blocks_are_whole_before_the_cut(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 10)
    rows = [(i, "w " * 3, "en", "a") for i in range(200)] + [(500 + i, "w", "en", "b") for i in range(100)]
    out = mixing.mixture(docs(spark, rows), Targets(None, 2.5, None)).where("source = 'b'").collect()
    last = max(r.epoch for r in out)
    taken = Counter(r.block for r in out if r.epoch == last)
    assert 0 < last < 3
    first = {r.doc_id: r.block for r in mixing.mixture(docs(spark, rows), Targets(None, 2.5, None)).where("source = 'b'").collect()
             if r.epoch == last}
    assert sorted(taken) == list(range(max(taken) + 1)) and len(first) == sum(taken.values())


def test_mixed_keeps_columns(spark):
    df = docs(spark, corpus())
    out = mixing.mixed(df)
    assert out.columns == df.columns
    counts = Counter(r.doc_id for r in out.collect())
    assert set(counts) == {r[0] for r in corpus()} and counts[0] % 3 == 0
    assert mixing.mixed(df.where("false")).collect() == [] and mixing.mixture(df.where("false")).collect() == []


def shard_rows(spark, rows, shards):
    return sharding.sharded(docs(spark, rows), shards).collect()


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_shards_are_near_equal_and_keep_groups(spark, shards):
    rows = [(i, f"text {i % 700} " * (i % 23 + 1), ("en", "de", None)[i % 3], f"s{i % 5}") for i in range(1500)]
    rows += [(None, None, None, None), (7, None, "en", "s0"), (7, "", "en", "s1"), (8, "x" * 3000, "en", "s1")]
    got = shard_rows(spark, rows, shards)
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"}
    used, slots, where = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        used[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        where[r.text_crc32].add(r.shard)
    mean = sum(used.values()) / shards
    assert set(used) == set(range(shards)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(used.values()) - min(used.values()) <= max(3100, 0.1 * mean)
    assert all(len(v) == 1 for v in where.values())
    want = Counter((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, _, _ in rows)
    assert Counter((r["size"], r.text_crc32) for r in got) == want


def test_a_large_group_is_split_and_shards_stay_equal(spark):
    rows = [(i, "the same text " * 5, "en", "s") for i in range(1000)] + [(5000 + i, f"other {i} " * 8, "en", "s") for i in range(1500)]
    used = Counter()
    for r in shard_rows(spark, rows, 10):
        used[r.shard] += r["size"]
    assert len(used) == 10 and max(used.values()) < 1.25 * min(used.values())


def test_sections_number_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 7)
    got = shard_rows(spark, [(i // 2, f"t{i % 50}", "en", "s") for i in range(400)], 4)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_few_items_and_empty(spark):
    assert len(shard_rows(spark, [(1, "a", "en", "s"), (2, "b", "en", "s")], 40)) == 2
    assert shard_rows(spark, [], 40) == []


def test_sharding_is_native(spark):
    df = docs(spark, [(i, f"t{i}", "en", "s") for i in range(50)])
    plan = sharding.sharded(df, 3)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
    assert sharding.sharded(df, 3).select(F.max("shard")).first()[0] == 2
