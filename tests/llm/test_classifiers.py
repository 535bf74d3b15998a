import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewtide.llm import language, quality, toxicity
from viewtide.llm.common import fold, fold_of

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, predicted string, x string, y string"
LABEL = "doc_id bigint, quality int, toxic int, text string"
SYLLABLES = {"en": ["the", "and", "ing", "er", "on", "sh", "wh"], "de": ["sch", "ein", "ung", "ß", "heit", "ver", "ä"],
             "fr": ["eau", "ç", "que", "ment", "é", "ou", "le"]}


def prose(rng, lang="en", n=80):
    def word():
        return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3)))
    return " ".join(" ".join(word() for _ in range(8)).capitalize() + "." for _ in range(n // 8))


@pytest.fixture(scope="module")
def corpus():
    """600 documents: a fifth of poor quality, a fifth toxic, three languages."""
    rng = random.Random(7)
    docs, labels = [], []
    for i in range(600):
        lang = rng.choice(list(SYLLABLES))
        text, bad, toxic = prose(rng, lang, rng.randint(40, 200)), rng.random() < 0.2, rng.random() < 0.2
        if bad:
            text = rng.choice([lambda t: t.upper().replace(" ", "!! "), lambda t: t.replace(" ", " | "),
                               lambda t: " ".join(w for w in t.split()[:9] for _ in range(20))])(text)
        if toxic:
            words = text.split(" ")
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "gromling", "gromlot"]))
            text = " ".join(words)
        docs.append((i, text, lang, "s", len(text), "a", "b", "c", "d"))
        labels.append((i, int(not bad), int(toxic), "t"))
    return docs, labels


def odd():
    return [(9000, None, None, None, None, None, None, None, None), (9001, "", "en", "s", 0, "a", "b", "c", "d"),
            (None, "no id at all here", "en", "s", 0, "a", "b", "c", "d"), (9002, "123 456 --", None, "s", 0, "a", "b", "c", "d"),
            (9003, "the and " * 40_000, "en", "s", 0, "a", "b", "c", "d"), (1, "again the same id", "en", "s", 0, "a", "b", "c", "d")]


@pytest.fixture(scope="module")
def frames(spark, corpus):
    docs, labels = corpus
    extra = [(9000, 0, 0, "t"), (9001, None, None, "t"), (None, 1, 1, "t"), (3, 7, 7, "t")]
    return spark.createDataFrame(docs + odd(), DOC), spark.createDataFrame(labels + extra, LABEL)


def test_fold_is_the_same_in_spark(spark):
    df = spark.createDataFrame([(i,) for i in (0, 5, 123456789, -4, None)], "i bigint")
    assert [r[0] for r in df.select(fold(F.col("i"), 5)).collect()] == [fold_of(i, 5) for i in (0, 5, 123456789, -4, None)]


@pytest.mark.parametrize("run,label", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_held_out_accuracy(frames, corpus, run, label):
    rows = run(*frames).collect()
    assert len(rows) == len(corpus[0]) + len(odd()) and all(0 <= r.score <= 1 for r in rows)
    want = {i: q if label == "quality" else t for i, q, t, _ in corpus[1]}
    held = [r for r in rows if r.held_out and r.doc_id in want and r.doc_id != 1]
    assert all(r.held_out == (fold_of(r.doc_id, 5) == 0) for r in rows)
    assert len(held) > 80 and np.mean([r.predicted == want[r.doc_id] for r in held]) > 0.95
    cut = 0.3 if label == "quality" else 0.5
    assert all(r.predicted == int(r.score >= cut) for r in rows)


def test_held_out_labels_do_not_matter(spark, frames, corpus):
    docs, labels = frames
    turned = labels.withColumn("quality", F.when(fold(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    first = {(r.doc_id, r.score) for r in quality.quality_scores(docs, labels).where("doc_id < 600").collect()}
    second = {(r.doc_id, r.score) for r in quality.quality_scores(docs, turned).where("doc_id < 600").collect()}
    assert {(i, round(s, 9)) for i, s in first} == {(i, round(s, 9)) for i, s in second}


def test_density_ratio_matches_scipy_free_formula():
    rng = np.random.default_rng(0)
    d = len(quality.STATISTICS)
    x = {0: rng.standard_normal((400, d)) * 2, 1: rng.standard_normal((900, d)) + 1}
    quality_sums = {y: (float(len(v)), v.sum(0), v.T @ v) for y, v in x.items()}
    old, quality.class_sums = quality.class_sums, lambda rows: quality_sums
    try:
        model = quality.fit(None, pool=0.0, ridge=0.0)
    finally:
        quality.class_sums = old
    point = rng.standard_normal((5, d))
    logs = []
    for y in (0, 1):
        c = np.cov(x[y].T, bias=True) + 1e-6 * np.eye(d)
        z = point - x[y].mean(0)
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", z, np.linalg.inv(c), z) + np.linalg.slogdet(c)[1]))
    assert np.allclose(model.scores(point), 1 / (1 + np.exp(-(logs[1] - logs[0] + np.log(900 / 400)))), atol=1e-6)


def test_grammar_scores_clauses():
    g = toxicity.Grammar({"gromli"})
    assert g.features("You are an idiot.")[:6] == pytest.approx([0, np.log(2), 0, 0, 0, 0])
    assert g.features("Not an idiot here")[2] > 0 and g.features("the text called it gromlings")[3] > 0
    assert g.features("not so. idiot")[0] > 0, "a negation ends with its clause"
    assert g.features("not a b c d idiot")[0] > 0, "a negation reaches three words"
    assert g.features("they will hurt")[4] > 0 and g.features("never hurt them")[4] == 0
    assert g.features("idiotic grom") == [0.0] * 12 and g.features(None) == [0.0] * 12


def test_stems_grow_to_whole_words():
    assert toxicity.choose_stems({"tra": 10, "tras": 10, "trash$": 10, "gro": 9, "grom": 9, "gromli$": 3}) == ["grom", "trash$"]


def test_filters_keep_columns_and_clean_documents(frames, corpus):
    docs, labels = frames
    for keep, bad in ((quality.keep_good, {i for i, q, _, _ in corpus[1] if not q}),
                      (toxicity.keep_civil, {i for i, _, t, _ in corpus[1] if t})):
        kept = keep(docs, labels)
        assert kept.columns == docs.columns
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        clean = {i for i in range(600) if i not in bad}
        assert len(ids & clean) > 0.97 * len(clean) and len(ids & bad) < 0.1 * len(bad)


def test_without_labels_or_rows(spark, frames):
    docs, labels = frames
    none, empty = labels.where("false"), docs.where("false")
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    rows = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, none).collect()}
    assert rows[9001] == 0 and rows[9000] == 0
    for run in (quality.quality_scores, toxicity.toxicity_scores, quality.keep_good, toxicity.keep_civil):
        assert run(empty, labels).collect() == []
    only = quality.quality_scores(docs, labels.where("quality = 1")).collect()
    assert all(r.predicted == 1 for r in only)


def test_languages(spark, frames, corpus):
    rows = language.languages(frames[0]).collect()
    want = {d[0]: d[2] for d in corpus[0]}
    held = [r for r in rows if r.held_out and r.doc_id in want and r.doc_id != 1]
    assert len(rows) == len(corpus[0]) + len(odd()) and len(held) > 100
    assert np.mean([r.lang_pred == want[r.doc_id] for r in held]) > 0.97
    by_id = {r.doc_id: r for r in rows}
    assert by_id[9000].lang_pred == by_id[9001].lang_pred == by_id[9002].lang_pred == "und" and by_id[9000].score == 0
    assert by_id[9003].lang_pred == "en" and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (fold_of(r.doc_id, 4) == 2) for r in rows)


def test_language_rejects_what_is_far(spark, frames):
    model = language.fit(frames[0])
    far = spark.createDataFrame([(1, "日本語 日本 語日 本語"), (2, "The and ing er on sh wh")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in language.predictions(far, model).collect()}
    assert got[1].decided == "und" and got[1].rejected and not got[2].rejected


def test_language_of_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "words here", None)], "doc_id bigint, text string, lang string")
    assert [r.lang_pred for r in language.languages(docs).collect()] == ["und"]
    assert language.languages(docs.where("false")).collect() == []


def test_pieces_count_like_the_whole(monkeypatch):
    text = prose(random.Random(1), "de", 400)
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "PIECE", 37)
    assert np.array_equal(language.gram_counts(text), whole)


def test_sample_of_rows_without_ids_or_with_repeated_ones_is_bounded(spark, corpus, monkeypatch):
    """Rows are drawn by a hash of the row, so a missing or repeated id draws no more of them; equal rows count once."""
    kept = {}
    plain = language.store

    def counting(df, name):
        out = plain(df, name)
        kept[name] = out
        return out

    monkeypatch.setattr(language, "store", counting)
    monkeypatch.setattr(language, "FIT_ROWS", 40)
    docs = [(None, *d[1:]) for d in corpus[0]] + [(7, *d[1:]) for d in corpus[0]] + [corpus[0][0]] * 300
    df = spark.createDataFrame(docs, DOC)
    found = language.languages(df).collect()
    fit = kept["language-fit"].groupBy("f_g").count().collect()
    assert len(fit) == 3 and all(r["count"] == 40 for r in fit)
    right = sum(r.lang_pred == d[2] for r, d in zip(sorted(found, key=lambda r: r.doc_id is not None)[:600], corpus[0]))
    assert len(found) == len(docs) and right > 0
