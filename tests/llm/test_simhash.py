import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from viewtide.llm import simhash

DDL = "doc_id bigint, text string, fp string, component_id int"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_groups(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    own = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 3 and own[j] < own[i]:
                    own[i], changed = own[j], True
    ids = {}
    for (doc_id, _), o in zip(rows, own):
        ids.setdefault(o, []).append(doc_id)
    return sorted((d, f"{f:016x}", min(x for x in ids[o] if x is not None)) for (d, _), f, o in zip(rows, fps, own))


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "Two words", "ÀB C d e", "a b c a b c a b c", "x " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (2**64 - 1) == brute_fingerprint(text)


@pytest.mark.parametrize("frontier", [4, 1 << 19])
def test_trie_join_finds_every_link_once(monkeypatch, frontier):
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    rng = np.random.default_rng(3)
    v = rng.integers(0, 2**63, 300).astype(np.uint64)
    v = np.concatenate([v, v[:90] ^ np.uint64(1 << 63), v[:60] ^ np.uint64(0b1011), v[:30] ^ np.uint64(0b11110), np.array([0, 1, 2**64 - 1], np.uint64)])
    trie = simhash.Trie(v)
    got = [(min(p), max(p)) for i, j in simhash.trie_join(trie, trie, 0, 0, True) for p in zip(i.tolist(), j.tolist())]
    u = trie.values
    want = {(i, j) for i in range(len(u)) for j in range(i + 1, len(u)) if (int(u[i]) ^ int(u[j])).bit_count() <= 3}
    assert len(got) == len(set(got)) and set(got) == want


def texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(12)]
    near = [b + " tail" for b in base[:6]] + [b.upper() for b in base[:3]]
    return [None, "", "  ", "Short", "short"] + base + near + [base[0]] * 9


def test_groups_match_brute_force(spark):
    rows = list(enumerate(texts())) + [(3, "Short")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DDL)
    got = sorted(map(tuple, simhash.groups(df).collect()))
    assert got == brute_groups(rows)


def test_small_leaves_give_the_same_links(spark):
    rng = np.random.default_rng(5)
    v = rng.integers(-2**63, 2**63 - 1, 400)
    v = np.unique(np.concatenate([v, v[:100] ^ 5, v[:50] ^ (1 << 40)]))
    df = spark.createDataFrame([(int(x),) for x in v], "fp bigint")
    got = {r.node: r.root for r in simhash.components(simhash.fingerprint_links(df, leaf_rows=40)).collect()}
    want = {r.node: r.root for r in simhash.components(simhash.fingerprint_links(df)).collect()}
    assert got == want and len(got) > 150


def test_components_of_chains_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 150)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(links, "x bigint, y bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 150, 150: 150}


def test_empty_table(spark):
    df = spark.createDataFrame([], DDL)
    assert simhash.groups(df).collect() == [] and simhash.keep_one(df).collect() == []


def test_keep_one_keeps_columns_and_the_first(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())] + [(5, texts()[5], "x", 1), (None, "alone here today", None, None)]
    df = spark.createDataFrame(rows, DDL)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = {r.component_id for r in simhash.groups(df.where("doc_id is not null")).collect()}
    assert sorted(i for i in ids if i is not None) == sorted(groups) and ids.count(None) == 1


def test_links_are_joined_by_key(spark):
    plan = simhash.fingerprint_links(spark.range(100).select(F.xxhash64("id").alias("fp")))._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def edited(rng, words, changes):
    out = list(words)
    for k in rng.sample(range(len(out)), changes):
        out[k] = f"new{rng.random()}"
    return out


def shingled(text):
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_keep_one_recall_of_five_word_shingles_against_brute_force(spark):
    rng = random.Random(11)
    docs = []
    for _ in range(120):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([60, 200, 600]))]
        docs += [" ".join(base), " ".join(edited(rng, base, rng.randrange(1, len(base) // 25)))]
    docs += [" ".join(edited(rng, docs[0].split(), 1)) for _ in range(40)]  # a larger group of near copies
    sets = [shingled(t) for t in docs]
    own = list(range(len(docs)))

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8]
    far = [(i, i + 1) for i in range(0, 240, 2) if jaccard(sets[i], sets[i + 1]) < 0.75]
    for i, j in pairs:
        own[max(root(i), root(j))] = min(root(i), root(j))
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(docs)], DDL)).collect()}
    want = {i for i in own if root(i) == i}
    bits = [simhash.fingerprint(t) for t in docs]
    assert sum((bits[i] ^ bits[j]).bit_count() > 3 for i, j in pairs) > 50 and len(far) > 10
    assert kept == want


def test_keep_one_compares_sets_that_the_chain_separates(spark):
    rng = random.Random(12)
    base = [f"w{k}" for k in range(400)]
    left, right = edited(rng, base, 7), edited(rng, base, 7)  # each similar to base, not to each other
    rows = [(1, " ".join(left) + " a b c", "x", 1), (2, " ".join(base), "x", 1), (3, " ".join(right) + " d", "x", 1)]
    assert not simhash.similar(*(simhash.shingle_set(rows[k][1]) for k in (0, 2)))
    assert [r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, DDL)).collect()] == [1]
    sets = [simhash.shingle_set(t) for _, t, *_ in rows]
    pdf = pd.DataFrame({"bucket": 1, "a": 0, "b": 0, "sh": [7, 5, 6], "root": [7, 5, 5],
                        "sig": [simhash.signature(s).tobytes() for s in sets], "shingles": [s.tobytes() for s in sets]})
    assert sorted(simhash.unlinked_sets(pdf)["sh"]) == [5, 6, 7]
    assert simhash.similar_sets(pdf).to_numpy().tolist() == [[5, 7]]


def template(rng, n, words=60, changed=3):
    """Pages of one template, each with its own words in one place: Jaccard about 0.78 unless the place is near the edge."""
    base = [f"w{k}" for k in range(words)]
    out = []
    for i in range(n):
        at = rng.randrange(words - changed)
        out.append(" ".join(base[:at] + [f"x{i}y{k}" for k in range(changed)] + base[at + changed:]))
    return out


@pytest.mark.parametrize("n", [100, 300])
def test_similar_sets_of_a_template_match_brute_force_and_are_a_forest(n):
    rng = random.Random(n)
    docs = template(rng, n) + [" ".join(edited(rng, template(rng, 1)[0].split(), 1)) for _ in range(n // 10)]
    sets = [simhash.shingle_set(t) for t in docs]
    pdf = pd.DataFrame({"sh": range(len(docs)), "root": range(len(docs)), "shingles": [s.tobytes() for s in sets]})
    links = simhash.similar_sets(pdf)
    true = [(i, j) for i in range(len(docs)) for j in range(i) if simhash.similar(sets[i], sets[j])]
    assert components_of(len(docs), links.to_numpy().tolist()) == components_of(len(docs), true)
    assert len(links) < len(docs) and len(true) > 10 and all((j, i) in {(min(p), max(p)) for p in true} for j, i in links.to_numpy().tolist())


def components_of(n, links):
    own = list(range(n))

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    for i, j in links:
        own[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(n)]


def test_blocks_meet_pairwise(spark):
    rows = spark.range(3 * simhash.BLOCK).selectExpr("7L as bucket", "id as sh", "id as root")
    met = simhash.blocked(rows).groupBy("a", "b").count().collect()
    assert sorted((r.a, r.b) for r in met) == [(0, 1), (0, 2), (1, 2)] and sum(r["count"] for r in met) == 6 * simhash.BLOCK
    one = simhash.blocked(rows.limit(50))
    assert one.count() == 50 and one.where("a = 0 and b = 0").count() == 50


def test_rows_of_templated_pages_grow_with_their_number(spark, monkeypatch):
    """Nothing that near-dedup writes or emits for a template grows with the square of its pages."""
    written = {}
    plain = simhash.store
    for n in (150, 300):
        counts = written.setdefault(n, {})

        def counting(df, name):
            out = plain(df, name)
            counts[name] = counts.get(name, 0) + out.count()
            return out

        monkeypatch.setattr(simhash, "store", counting)
        docs = [(i, t, "x", 1) for i, t in enumerate(template(random.Random(1), n))]
        simhash.keep_one(spark.createDataFrame(docs, DDL)).collect()
    assert all(written[300][k] <= 2.6 * written[150][k] + 10 for k in written[300])


def test_shingle_set_and_signature_match_brute_force():
    rng = random.Random(13)
    base = [f"w{rng.randrange(300)}" for _ in range(2000)]
    a, b = " ".join(base), " ".join(edited(rng, base, 40))
    x, y = simhash.shingle_set(a), simhash.shingle_set(b)
    assert (len(x), len(y)) == (len(shingled(a)), len(shingled(b)))
    exact = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert exact == jaccard(shingled(a), shingled(b))
    assert abs((simhash.signature(x) == simhash.signature(y)).mean() - exact) < 0.2
    assert len(simhash.shingle_set(None)) == 0 and len(simhash.shingle_set("A b")) == 1
    assert simhash.shingle_set("A b") == simhash.shingle_set(" a  B ")
