"""Collocations: phrases of two to five words that occur more often together than their parts suggest, per language.

Words and phrases are counted as Rabin-Karp fingerprints: numpy prefix polynomials over the bytes of a block of texts give the
hash of every word, and prefix polynomials over those hashes give the hash of every n-gram that stays within a piece. A task
sums equal fingerprints before the shuffle; a row carries the fingerprint, its count, the sum of a second hash and a
pointer to one occurrence (hash of the document, word number). Only frequent phrases are ever materialised, from
their pointers, and verified: the second hash of the text found there, times the count, must equal the sum over all
occurrences. Phrases that share a fingerprint with another fail that test and are counted again by their text.

Lengths are counted one after the other, pairs first by 32 bits of the fingerprint alone. An n-gram is looked at only if both
(n-1)-grams in it may be frequent, which a bitmap of ``FILTER_BITS`` bits (at most 8 MB, whatever the data) says without false negatives. On tables with far more frequent
phrases than bits the bitmap lets more through, which costs work and changes no result.

Defined results: a null text is empty, a null language ``und``; A-Z are lower-cased; repeated rows count each; ids are not looked
at, nor any other column; texts of any length are read whole, in blocks of whole texts; an empty table, or one without a frequent
phrase, gives an empty result. Ties: of cuts to the one with the shorter first part, of phrases as the ranking says.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.common import forget, is_empty, join_counted, store

LONGEST = 5
LEAST = 100             # occurrences of a candidate
FIRST = 2_000           # phrases of a language
BLOCK_BYTES = 1 << 18   # texts hashed together
MERGE_ROWS = 1 << 19    # fingerprints a task holds before it hands them on
FILTER_BITS = 26
FP_BITS = 64            # tests use fewer to provoke collisions
CHECK_BITS = 28         # sums of the second hash stay exact up to 2**35 occurrences
POSITION_BITS = 30
SALTS = 8

_U = np.uint64
_RNG = np.random.default_rng(11)
_BYTE = _RNG.integers(0, 2**64, 256, _U)
_BASES = [int(b) | 1 for b in _RNG.integers(2**32, 2**63, 3, _U)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_INNER = ~_BREAK
_INNER[list(b" \t")] = False


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.pair = (base, pow(base, -1, 2**64))
        self.tables = [np.ones(1, _U)] * 2

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.tables[0]) < n:
            self.tables = [np.concatenate(([_U(1)], np.cumprod(np.full(max(n, BLOCK_BYTES * 2), b, _U)))) for b in self.pair]
        return self.tables


_POWERS = [Powers(b) for b in _BASES]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> _U(29))) * _U(0xD1B54A32D192ED03)
    return h ^ (h >> _U(32))


class Polynomial:
    """Prefix sums of values times powers of a base: the hash of any range in constant time."""

    def __init__(self, values: np.ndarray, powers: Powers):
        power, self.inverse = powers.upto(len(values) + 1)
        self.sums = np.concatenate(([_U(0)], np.cumsum(values * power[:len(values)], dtype=_U)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


class Words:
    """The words of a block of texts: hash, text number, place in the text, piece, and their bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = _LOWER[data]
        inner = np.concatenate(([False], _INNER[self.data], [False]))
        first = np.zeros(len(inner), bool)
        first[offsets + 1] = True      # a text starts here, whatever stands before
        self.start = np.flatnonzero(inner[1:-1] & (~inner[:-2] | first[1:-1]))
        self.end = np.flatnonzero(inner[1:-1] & (~inner[2:] | first[2:])) + 1
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        self.piece = np.cumsum(_BREAK[self.data])[self.start] + self.text if len(self.start) else self.start
        self.place = np.arange(len(self.start)) - np.searchsorted(self.text, self.text)
        spans = Polynomial(_BYTE[self.data], _POWERS[0]).of(self.start, self.end)
        self.hash = mix(spans + (self.end - self.start).astype(_U))
        self.rolling = [Polynomial(self.hash, p) for p in _POWERS[1:]]

    def grams(self, n: int) -> np.ndarray:
        """First words of the n-grams that stay within a piece."""
        i = np.arange(max(0, len(self.start) - n + 1))
        return i[self.piece[i] == self.piece[i + n - 1]]

    def prints(self, i: np.ndarray, n: int, languages: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and second hash of the n-grams at ``i``; texts of different languages share none."""
        a, b = (r.of(i, i + n) for r in self.rolling)
        fp = mix(a + languages[self.text[i]] + _U(n)) >> _U(64 - bits)
        return fp.view(np.int64), (mix(b + _U(n)) >> _U(64 - CHECK_BITS)).view(np.int64)

    def phrase(self, i: int, n: int) -> str:
        return b" ".join(self.data[self.start[j]:self.end[j]].tobytes() for j in range(i, i + n)).decode("utf-8", "replace")


def text_blocks(batch: pa.RecordBatch):
    """Yield (first row, Words, languages' hashes) for runs of whole texts of about ``BLOCK_BYTES``."""
    column = pc.fill_null(batch.column("text"), "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    names = batch.column("lang").to_pylist()
    known = {x: xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 7) for x in set(names)}
    languages = np.array([known[x] for x in names], _U)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + BLOCK_BYTES, "right")) - 1)
        yield a, Words(data[offsets[a]:offsets[b]], offsets[a:b] - offsets[a]), languages[a:b]
        a = b


def summed(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Columns fp, count, check, pointer with one row a fingerprint: sums of the middle two, the least pointer."""
    order = np.argsort(rows[0])
    fp, count, check, at = (c[order] for c in rows)
    if not len(fp):
        return [fp, count, check, at]
    first = np.flatnonzero(np.concatenate(([True], fp[1:] != fp[:-1])))
    return [fp[first], np.add.reduceat(count, first), np.add.reduceat(check, first), np.minimum.reduceat(at, first)]


class Filter:
    """A bitmap of fingerprints: which may be in a set."""

    def __init__(self, fps: DataFrame, column: str = "fp"):
        slot = F.col(column).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
        parts = (fps.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect())  # at most 8 MB
        bits = bytearray((1 << FILTER_BITS) // 8 + 4096)
        for part in parts:
            at = max(part.bucket - 1, 0) * 4096
            bits[at:at + 4096] = bytes(a | b for a, b in zip(bits[at:at + 4096], part.bits))
        self.packed, self.bits = zlib.compress(bytes(bits), 1), None

    def __getstate__(self):
        return {"packed": self.packed, "bits": None}

    def has(self, fp: np.ndarray) -> np.ndarray:
        if self.bits is None:
            self.bits = np.frombuffer(zlib.decompress(self.packed), np.uint8)
        slot = fp & ((1 << FILTER_BITS) - 1)
        bit = np.maximum(slot - 1, 0)  # Spark's buckets start at 1; 0 shares the bit of 1
        return (self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def hopeful(words: Words, n: int, languages: np.ndarray, bits: int, shorter: Filter | None) -> np.ndarray:
    """First words of the n-grams whose two (n-1)-grams may be frequent."""
    i = words.grams(n)
    if shorter is None or not len(i):
        return i
    i = i[shorter.has(words.prints(i, n - 1, languages, bits)[0])]
    return i[shorter.has(words.prints(i + 1, n - 1, languages, bits)[0])]


SLOT = (1 << 32) - 1
SIEVED = 2  # words of the n-grams that are counted by their slots first: the only ones of which most are rare and unfiltered


def in_batches(columns: list[str], add):
    """Function of batches of texts that sums the rows of ``add(key, first, words, languages)`` per fingerprint before it
    hands them on; it holds at most ``MERGE_ROWS`` of them."""
    def emit(batches):
        held, size = [], 0
        for batch in batches:
            key = batch.column("key").to_numpy()
            for first, words, languages in text_blocks(batch):
                held.append(summed(add(key, first, words, languages)))
                size += len(held[-1][0])
                if size > MERGE_ROWS:
                    held = [summed([np.concatenate(c) for c in zip(*held)])]
                    size = len(held[0][0])
                    if size > MERGE_ROWS // 2:
                        yield as_batch(held[0])
                        held, size = [], 0
        if held:
            yield as_batch(summed([np.concatenate(c) for c in zip(*held)]))

    def as_batch(values):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in values[:len(columns)]], names=columns)

    return emit


def counted(texts: DataFrame, n: int, shorter: Filter | None, least: int, bits: int) -> DataFrame:
    """``fp``, ``a``, ``check``, ``at`` of the n-grams with ``least`` occurrences, stored.

    Most n-grams of ``SIEVED`` words are rare. A first pass counts 32 bits of their fingerprints, which loses none that is
    frequent; only what they let through is counted with check sums and pointers. Words repeat within a task, and longer
    n-grams have passed the filter: they are counted at once, so the rows of a length grow with the texts and not with the
    phrases that become frequent times the tasks.
    """
    read = texts.select("key", "lang", "text")
    often = None
    if n == SIEVED:
        def slots(key, first, words, languages):
            fp, _ = words.prints(hopeful(words, n, languages, bits, shorter), n, languages, bits)
            one = np.ones(len(fp), np.int64)
            return [fp & SLOT, one, one, one]

        sums = read.mapInArrow(in_batches(["fp", "n"], slots), "fp bigint, n bigint").groupBy("fp").agg(F.sum("n").alias("n"))
        common = store(sums.where(F.col("n") >= least).select("fp"), f"slots-{n}")
        often = Filter(common)
        forget(common)

    def grams(key, first, words, languages):
        i = hopeful(words, n, languages, bits, shorter)
        fp, check = words.prints(i, n, languages, bits)
        if often is not None:
            keep = often.has(fp)
            i, fp, check = i[keep], fp[keep], check[keep]
        at = (key[first + words.text[i]] << POSITION_BITS) | words.place[i]
        return [fp, np.ones(len(fp), np.int64), check, at]

    rows = read.mapInArrow(in_batches(["fp", "n", "check", "at"], grams), "fp bigint, n bigint, check bigint, at bigint")
    return store(rows.groupBy("fp").agg(F.sum("n").alias("a"), F.sum("check").alias("check"), F.min("at").alias("at"))
                 .where(F.col("a") >= least), f"grams-{n}")


def materialised(grams: DataFrame, texts: DataFrame, bits: int) -> DataFrame:
    """``n``, ``fp``, ``lang``, ``phrase``, ``one`` (second hash) of what the pointers of ``grams`` show."""
    pointed = (grams.withColumn("key", F.shiftrightunsigned("at", POSITION_BITS))
               .withColumn("place", F.col("at").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)))
               .groupBy("key").agg(F.collect_list(F.struct("place", "n", "fp")).alias("wanted")))  # within one text
    # Equal texts have one key; only one of them is read. Different texts with one key are told apart by the fingerprint.
    sizes = texts.groupBy("key").count()
    one = (join_counted(texts, pointed.select("key").join(sizes, "key"), ["key"], "count").drop("count")
           .withColumn("twin", F.xxhash64(F.lit(1), "lang", "text"))
           .groupBy("key", "twin").agg(F.first("lang").alias("lang"), F.first("text").alias("text")))

    def read(batches):
        for batch in batches:
            wanted = batch.column("wanted")
            out = []
            for first, words, languages in text_blocks(batch):
                begins = np.searchsorted(words.text, np.arange(len(languages)))
                for t in range(len(languages)):
                    lang = batch.column("lang")[first + t].as_py()
                    for w in wanted[first + t].as_py():
                        i, n = begins[t] + w["place"], w["n"]
                        if i + n > len(words.start) or words.piece[i] != words.piece[i + n - 1] or words.text[i] != t:
                            continue
                        fp, check = words.prints(np.array([i]), n, languages, bits)
                        if fp[0] == w["fp"]:
                            out.append((n, int(fp[0]), lang, words.phrase(i, n), int(check[0])))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["n", "fp", "lang", "phrase", "one"]).astype(
                {"n": "int32", "fp": "int64", "one": "int64"}), schema=shape, preserve_index=False)

    shape = pa.schema([("n", pa.int32()), ("fp", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("one", pa.int64())])
    return one.join(pointed, "key").select("lang", "text", "wanted").mapInArrow(
        read, "n int, fp bigint, lang string, phrase string, one bigint")


def recounted(texts: DataFrame, doubtful: DataFrame, least: int, bits: int) -> DataFrame:
    """``n``, ``lang``, ``phrase``, ``a`` of the phrases whose fingerprint is in ``doubtful``, counted by their text."""
    lengths = sorted(r.n for r in doubtful.select("n").distinct().collect())  # at most five
    sieve = {n: Filter(doubtful.where(F.col("n") == n)) for n in lengths}

    def emit(batches):
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for first, words, languages in text_blocks(batch):
                seen = Counter()
                for n in lengths:
                    i = words.grams(n)
                    fp = words.prints(i, n, languages, bits)[0]
                    hit = sieve[n].has(fp)
                    seen.update((n, f, names[first + words.text[j]], words.phrase(j, n)) for j, f in zip(i[hit], fp[hit].tolist()))
                columns = [*zip(*seen), seen.values()] if seen else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, shape.types)], schema=shape)

    shape = pa.schema([("n", pa.int32()), ("fp", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64())])
    rows = texts.select("lang", "text").mapInArrow(emit, "n int, fp bigint, lang string, phrase string, a bigint")
    return (rows.groupBy("n", "fp", "lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
            .join(doubtful.select("n", "fp"), ["n", "fp"], "left_semi").select("n", "lang", "phrase", "a"))


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                     longest: int = LONGEST, bits: int = FP_BITS) -> DataFrame:
    """``n`` (words), ``lang``, ``phrase``, ``a`` of every phrase of up to ``longest`` words with ``least`` occurrences."""
    lang, text = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")), F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(lang.alias("lang"), text.alias("text"))
    texts = texts.withColumn("key", F.xxhash64("lang", "text").bitwiseAND(F.lit((1 << 63 - POSITION_BITS) - 1)))
    levels, shorter = [], None
    for n in range(1, longest + 1):
        level = counted(texts, n, shorter, least, bits)
        levels.append(level.withColumn("n", F.lit(n)))
        if n == longest or is_empty(level):
            break
        shorter = Filter(level)
    grams = levels[0]
    for more in levels[1:]:
        grams = grams.unionByName(more)
    shown = materialised(grams, texts, bits).groupBy("n", "fp").agg(
        F.min(F.struct("lang", "phrase", "one")).alias("s")).select("n", "fp", "s.*")
    checked = store(grams.join(shown, ["n", "fp"], "left")
                    .withColumn("sound", F.coalesce(F.col("check") == F.col("a") * F.col("one"), F.lit(False))), "checked")
    sound = checked.where("sound").select("n", "lang", "phrase", "a")
    doubtful = checked.where("not sound").select("n", "fp")
    if not is_empty(doubtful):
        sound = sound.unionByName(recounted(texts, doubtful, least, bits))
    out = store(sound, "phrases")
    forget(*levels, checked)
    return out


def word_totals(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``total``: the number of word occurrences of each language."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    words = F.regexp_count(F.col(text_col), F.lit(r"[^ \t.,;:!?\n\x0B\f\r]+"))
    return docs.groupBy(lang.alias("lang")).agg(F.sum(F.coalesce(words, F.lit(0)).cast("bigint")).alias("total"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 longest: int = LONGEST, first: int = FIRST, bits: int = FP_BITS) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the best phrases of each language.

    A phrase's cut with the lowest score counts; phrases inside a longer one of equal count are left out.
    """
    phrases = frequent_phrases(docs, text_col, lang_col, least, longest, bits)
    totals = F.broadcast(word_totals(docs, text_col, lang_col))  # one row a language
    words = F.split("phrase", " ")
    cuts = (phrases.where("n > 1").join(totals, "lang").withColumn("k", F.explode(F.expr("sequence(1, n - 1)")))
            .withColumn("head", F.array_join(F.slice(words, F.lit(1), F.col("k")), " "))
            .withColumn("tail", F.array_join(F.slice(words, F.col("k") + 1, F.col("n") - F.col("k")), " "))
            .withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")))
    # A common word begins many phrases: its count is offered once for each salt.
    parts = phrases.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    both = (cuts.join(parts.select("lang", "salt", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "salt", "head"])
            .join(parts.select("lang", "salt", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "salt", "tail"]))
    # a < 2**43 and total < 2**59 keep every product within 38 digits
    score = F.expr("(cast(a * 1000 as decimal(18,0)) * cast(total as decimal(18,0))) "
                   "div (cast(l as decimal(14,0)) * cast(r as decimal(14,0)))")
    scored = store(both.withColumn("score", score), "cuts")
    best = (scored.groupBy("lang", "phrase", "a", "total", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
            .select("lang", "phrase", "a", F.col("total").alias("n"), "c.l", "c.r", "c.score"))
    inside = (scored.where("k = n - 1 and l = a").select("lang", F.col("head").alias("phrase"))
              .unionByName(scored.where("k = 1 and r = a").select("lang", F.col("tail").alias("phrase"))).distinct())
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.join(inside, ["lang", "phrase"], "left_anti").withColumn("rank", F.row_number().over(order).cast("bigint"))
            .where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


ORACLE_SQL = r"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0),
grams AS (SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, n FROM starts, (SELECT unnest(range(1, 6)) AS n)
          WHERE i + n - 1 <= len(w)),
f AS MATERIALIZED (SELECT lang, phrase, n, count(*) AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(a) AS total FROM f WHERE n = 1 GROUP BY lang),
cuts AS (SELECT lang, phrase, n, a, string_split(phrase, ' ') AS w, unnest(range(1, n)) AS k FROM f WHERE n > 1 AND a >= 100),
scored AS MATERIALIZED (
  SELECT c.lang, c.phrase, c.n, c.a, c.k, h.phrase AS head, t.phrase AS tail, h.a AS l, t.a AS r, total.total,
         (1000::HUGEINT * c.a * total.total) // (h.a::HUGEINT * t.a) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.w[c.k + 1:], ' ') JOIN total ON total.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, head AS phrase FROM scored WHERE k = n - 1 AND l = a
           UNION SELECT lang, tail FROM scored WHERE k = 1 AND r = a),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, total, score
           FROM best b WHERE NOT EXISTS (FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase))
SELECT lang, rank, phrase, a, l, r, CAST(total AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
