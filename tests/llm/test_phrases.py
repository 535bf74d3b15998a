import random
import re
from collections import Counter

import pytest

from viewtide.llm import phrases

DDL = "doc_id bigint, text string, lang string, n bigint, phrase string, key int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, 1, "p", 2) for i, (t, g) in enumerate(rows)], DDL)


def brute(rows, least, first=2000):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i:i + n])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = set()
    for (g, w), a in cand.items():
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                if 100 * a >= 100 * f[g, w[i:i + n]]:
                    inside.add((g, w[i:i + n]))
    out = []
    for (g, w), a in cand.items():
        if (g, w) in inside:
            continue
        cuts = [(1000 * a * total[g] // (f[g, w[:k]] * f[g, w[k:]]), k) for k in range(1, len(w))]
        s, k = min(cuts)
        out.append((g, " ".join(w), a, f[g, w[:k]], f[g, w[k:]], total[g], s))
    ranked = []
    for g in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == g), key=lambda x: (-x[6], -x[2], x[1].encode()))[:first]
        ranked += [(g, r + 1, *x[1:]) for r, x in enumerate(mine)]
    return sorted(ranked)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = ["New", "york", "city", "über", "a", "of", "the", "état", "x1", "it's", "—", "\x00z"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! ", " \r\n "]
    fixed = ["the state of the art", "New York City hall", "a of the"]
    out = []
    for _ in range(160):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))]
        out.append(("".join(p + rng.choice(marks) for p in parts), rng.choice(["en", "en", "de", None])))
    out += [("copy of the copy of the copy", "en")] * 40 + [(None, "en"), ("", None), ("  \t ", "de"), ("...", "de")]
    return out + [("long " * 30_000 + "the state of the art", "en")]


@pytest.mark.parametrize("bits", [64, 9])
def test_collocations_match_brute_force(spark, rows, bits):
    """With nine bits nearly every fingerprint is shared, so that phrases are counted again by their text."""
    got = phrases.collocations(table(spark, rows), least=12, bits=bits).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == brute(rows, 12)


def test_small_blocks_and_few_held_fingerprints(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 100)
    monkeypatch.setattr(phrases, "MERGE_ROWS", 50)
    got = phrases.collocations(table(spark, rows[:120]), least=5, first=30).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == brute(rows[:120], 5, 30)


def test_empty_and_rare(spark):
    assert phrases.collocations(table(spark, [])).collect() == []
    assert phrases.collocations(table(spark, [("a b c", "en"), (None, None)])).collect() == []


def test_exact_beyond_64_bits(spark):
    text = "a b " * 40_000
    got = phrases.collocations(table(spark, [(text, "en")] * 3), least=100).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == brute([(text, "en")] * 3, 100)


def test_filter_has_no_false_negatives(spark):
    values = [0, 1, 2, 32_767, 32_768, 32_769, -1, 2**62 + 5, 7]
    held = phrases.Filter(spark.createDataFrame([(v,) for v in values], "fp bigint"))
    import numpy as np
    assert held.has(np.array(values)).all() and not held.has(np.array([100, 5000, 70_000])).any()


def test_only_pairs_are_counted_by_slots_first(spark, rows, monkeypatch):
    """A second pass hands over every frequent n-gram once a task, which outgrows the texts; words and filtered n-grams go
    through one pass."""
    written = []
    plain = phrases.store
    monkeypatch.setattr(phrases, "store", lambda df, name: written.append(name) or plain(df, name))
    got = phrases.collocations(table(spark, rows), least=12).collect()
    assert len(got) == len(brute(rows, 12))
    assert [n for n in written if n.startswith("slots-")] == ["slots-2"]
    assert [n for n in written if n.startswith("grams-")] == [f"grams-{n}" for n in range(1, 6)]
