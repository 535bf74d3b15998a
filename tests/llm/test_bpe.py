import hashlib
import random

import pytest
from pyspark.sql import functions as F

from viewtide.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def pair():
    path = public.path("word_bpe_49k.json")
    return bpe.Codec(path), tokenizers.Tokenizer.from_file(path)


def samples():
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    words += ["".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    words += ["a" * n for n in range(1, 80)] + ["ha" * n for n in range(1, 40)] + ["#" * n + "!" * (n % 7) for n in range(30)]
    odd = ["", " \n\t", "Hello the World's <|startoftext|>café 123 ΟΔΟΣ.", "I'll we'RE 'section don't", "é́ x\x1cy \x85z İ ẞß",
           "日本語のテスト 한국어", "<|endoftext|><|startoftext|>x<|endoftext|>", "😀👍🏽🇩🇪 a​b", "<|startoftext"]
    return words + odd + [" ".join(words[:400])]


def test_equals_the_library(pair):
    codec, library = pair
    for text, (n, ids, decoded) in zip(samples(), codec.encode_many(samples())):
        want = library.encode(text, add_special_tokens=False).ids
        assert (n, ids) == (len(want), " ".join(map(str, want))), text
        assert decoded == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("n", [255, 256, 257, 5000])
def test_long_words(pair, n):
    rng = random.Random(n)
    for text in ("a" * n, "ab" * n, "".join(rng.choice("abcdehn") for _ in range(n))):
        assert pair[0].encode(text)[1] == " ".join(map(str, pair[1].encode(text, add_special_tokens=False).ids))


def test_checks_agree_with_exact_merging(pair):
    codec = pair[0]
    for word in samples()[:800]:
        symbols = codec.symbols_of(word)
        exact = codec.exact(list(symbols))
        assert codec._exact_long([codec.vocab[s] for s in symbols]) == exact


def test_cache_is_bounded(pair, monkeypatch):
    codec, library = pair
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    monkeypatch.setattr(bpe, "CHARS_AT_ONCE", 200)
    for text, got in zip(samples(), codec.encode_many(samples())):
        assert got[1] == " ".join(map(str, library.encode(text, add_special_tokens=False).ids))


def test_digests_and_round_trip(spark, pair):
    rows = [(1, "A text, and more.", 5), (1, "A text, and more.", 5), (2, None, 6), (None, "", 7), (4, "word " * 30_000, 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    out = bpe.token_digests(df).collect()
    assert len(out) == 5
    for r, (doc_id, text, _) in zip(out, rows):
        ids = pair[1].encode(text or "", add_special_tokens=False).ids
        assert r.doc_id == doc_id and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want = pair[1].decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(want.encode()).hexdigest()
    tokens = bpe.tokenized(df, to="n_tokens")
    assert tokens.columns[:3] == df.columns and len(tokens.columns) == 4
    back = tokens.select(bpe.decoded_text(F.col(tokens.columns[3]), bpe.default_path()).alias("d")).collect()
    assert back[0].d == "a</w> text</w> ,</w> and</w> more</w> .</w>" and back[2].d == ""


def test_empty_table(spark):
    assert bpe.token_digests(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
