"""BPE encoding and decoding by speculation: greedy longest matches, vectorised checks of neighbours, exact merging for the rest.

A segmentation of a word into tokens is its BPE encoding exactly if every token encodes to itself and no two neighbours
would have been joined across their border. The tokens of a word proposed by greedy longest match are therefore checked pair
by pair, all distinct pairs of a batch at once in numpy; words with a failing pair are merged exactly, by rank.

Two neighbours are joined across the border exactly if, at some time, the last piece x of the left and the first piece y
of the right both stand and the pair (x, y) has a rank before the merge that ends x and not after the merge that ends y (the
leftmost of equal ranks goes first). The pieces are the right spine of the left token's merge tree and the left spine of
the right token's.

Every worker holds the vocabulary and a cache of encoded words that is emptied when it is full, so memory does not depend
on the corpus; encoding is a map over rows without a shuffle.

Defined results: a null text counts as empty; an empty text has no tokens, the hash of the empty string and an empty decoding;
text of white space only likewise; special tokens spelled out in a text are special tokens; other columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from viewtide.llm.common import fresh

CACHE_WORDS = 400_000
WORDS_AT_ONCE = 50_000
CHARS_AT_ONCE = 2_000_000
LONG_WORD = 256         # symbols; beyond it, pairs are kept in a heap
LAST = 1 << 40
NEVER = np.int64(LAST)
SPACE = r"\t-\r \x85\xa0  -     　"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else the next from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Codec:
    """A word-level BPE tokenizer file: NFC, lower case, white space dropped, byte symbols with a mark at word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.symbols = byte_alphabet()
        self.pieces = regex.compile(PIECES)
        self.size = max(self.token) + 1
        self.rank_of: dict[tuple[int, int], int] = {}
        self.made_by: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank_of.setdefault((self.vocab[left], self.vocab[right]), rank)
            self.made_by.append(self.vocab[left + right])
        self._tree()
        self.cache: dict[str, tuple] = {}

    def _tree(self) -> None:
        """Merge tree of every token, the sorted table of mergeable pairs, and the tokens that encode to themselves."""
        n = self.size
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.rank = np.full(n, -1, np.int64)
        keys = np.fromiter((a * n + b for a, b in self.rank_of), np.int64, len(self.rank_of))
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.fromiter(self.rank_of.values(), np.int64, len(self.rank_of))[order]
        for (a, b), rank in self.rank_of.items():
            made = self.made_by[rank]
            if self.rank[made] < 0:
                self.left[made], self.right[made], self.rank[made] = a, b, rank
        sound = np.ones(n, bool)
        made = np.nonzero(self.rank >= 0)[0]
        # A token encodes to itself if its parts do and nothing is joined across their border before its own merge.
        fine = self.compatible(self.left[made], self.right[made], self.rank[made])
        sound[made[~fine]] = False
        for t in made[np.argsort(self.rank[made])]:
            sound[t] &= sound[self.left[t]] and sound[self.right[t]]
        self.greedy = {t: i for t, i in self.vocab.items() if sound[i]}
        self.longest = max(map(len, self.greedy), default=1)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether each pair of tokens stays apart (or, with ``before``, stays apart until that rank)."""
        ok = np.ones(len(a), bool)
        limit = np.full(len(a), NEVER) if before is None else before
        row, x, x_ends = np.arange(len(a)), a.astype(np.int64), limit
        while len(row):
            y, y_ends, at = b[row].astype(np.int64), limit[row], np.arange(len(row))
            while len(at):
                key = x[at] * self.size + y
                i = np.searchsorted(self.pair_keys, key).clip(max=len(self.pair_keys) - 1)
                rank = np.where(self.pair_keys[i] == key, self.pair_ranks[i], NEVER)
                first = y_ends if before is None else np.where(y_ends == limit[row[at]], y_ends - 1, y_ends)
                ok[row[at][(rank < x_ends[at]) & (rank <= first)]] = False
                deeper = self.left[y] >= 0
                at, y, y_ends = at[deeper], self.left[y[deeper]], self.rank[y[deeper]]
            deeper = self.right[x] >= 0
            row, x, x_ends = row[deeper], self.right[x[deeper]], self.rank[x[deeper]]
        return ok

    def exact(self, symbols: list[str]) -> list[int]:
        """Merge by rank, leftmost first."""
        ids = [self.vocab[s] for s in symbols]
        if len(ids) > LONG_WORD:
            return self._exact_long(ids)
        rank, made = self.rank_of.get, self.made_by
        ranks = [rank(p, LAST) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == LAST:
                break
            i = ranks.index(best)
            ids[i:i + 2] = [made[best]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), LAST)
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), LAST)
        return ids

    def _exact_long(self, ids: list[int]) -> list[int]:
        """The same for a word of any length, with a heap of pairs over a linked list of pieces."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.rank_of[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rank_of]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else n
            if j >= n or self.rank_of.get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j], after[i] = self.made_by[rank], None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (ids[a], ids[b]) in self.rank_of:
                    heapq.heappush(heap, (self.rank_of[ids[a], ids[b]], a))
        return [t for t in ids if t is not None]

    def symbols_of(self, word: str) -> list[str]:
        out = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        out[-1] += self.end
        return out

    def propose(self, symbols: list[str]) -> list[int] | None:
        """Greedy longest match; None if it gets stuck."""
        text, n = "".join(symbols), len(symbols)
        out, i, greedy = [], 0, self.greedy
        while i < n:
            whole = greedy.get(text[i:]) if n - i <= self.longest else None
            if whole is not None:
                out.append(whole)
                return out
            for j in range(min(n - 1, i + self.longest), i, -1):
                found = greedy.get(text[i:j])
                if found is not None:
                    break
            else:
                return None
            out.append(found)
            i = j
        return out

    def learn(self, words: list[str]) -> None:
        """Put the encodings of distinct words into the cache."""
        symbols = [self.symbols_of(w) for w in words]
        proposed = [self.propose(s) for s in symbols]
        lengths = np.array([len(p) if p else 0 for p in proposed], np.int64)
        flat = np.array([t for p in proposed if p for t in p], np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        near = np.nonzero(owner[:-1] == owner[1:])[0] if len(owner) else np.zeros(0, np.int64)
        keys, back = np.unique(flat[near] * self.size + flat[near + 1], return_inverse=True)
        good = self.compatible(keys // self.size, keys % self.size)
        failed = lengths == 0
        failed[owner[near[~good[back]]]] = True
        for i, word in enumerate(words):
            ids = self.exact(symbols[i]) if failed[i] else proposed[i]
            self.cache[word] = (len(ids), " ".join(map(str, ids)), " ".join(map(self.token.__getitem__, ids)))

    def words(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        return self.pieces.findall(text.replace("Σ", "σ").lower())

    def segments(self, text: str | None) -> list[tuple[bool, list[str]]]:
        """(special, words) in order; words of ordinary text are not encoded yet."""
        if not text:
            return []
        if self.split_special is None or not any(s in text for s in self.special):
            return [(False, self.words(text))]
        return [(part in self.special, [part] if part in self.special else self.words(part))
                for part in self.split_special.split(text) if part]

    def encode_many(self, texts):
        """Yield (number of tokens, decimal ids joined by a space, decoded text) of each text, in order.

        The new words of about ``CHARS_AT_ONCE`` characters are learned together, so that one check covers many pairs.
        """
        held, chars = [], 0
        for text in texts:
            held.append(self.segments(text))
            chars += len(text or "")
            if chars >= CHARS_AT_ONCE:
                yield from self._finish(held)
                held, chars = [], 0
        yield from self._finish(held)

    def _finish(self, held: list):
        new = {w for segments in held for special, words in segments if not special for w in words}
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
        new = list(new.difference(self.cache))
        for start in range(0, len(new), WORDS_AT_ONCE):
            self.learn(new[start:start + WORDS_AT_ONCE])
        for segments in held:
            entries = []
            for special, words in segments:
                if special:
                    entries.append((1, str(self.special[words[0]]), words[0]))
                else:
                    entries += map(self.cache.__getitem__, words)
            if entries:
                counts, ids, tokens = zip(*entries)
                yield sum(counts), " ".join(ids), " ".join(tokens)
            else:
                yield 0, "", ""

    def encode(self, text: str | None) -> tuple[int, str, str]:
        return next(self.encode_many([text]))

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, special ones included; ids outside the vocabulary are skipped."""
        return " ".join(self.token[i] for i in ids if i in self.token)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each worker process."""
    return Codec(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


DIGEST = StructType([StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
                     StructField("decoded_sha256", StringType())])


def digests(text_col, path: str):
    """Column of (n_tokens, ids_sha256, decoded_sha256) for whole texts."""
    @F.pandas_udf(DIGEST)
    def run(text: pd.Series) -> pd.DataFrame:
        c = codec(path)
        rows = []
        for n, ids, decoded in c.encode_many(text):
            rows.append((n, hashlib.sha256(ids.encode()).hexdigest(),
                         hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest()))
        return pd.DataFrame(rows, columns=DIGEST.names)

    return run(text_col)


def token_ids(text_col, path: str):
    """Column of the token ids of whole texts."""
    @F.pandas_udf(ArrayType(IntegerType()))
    def run(text: pd.Series) -> pd.Series:
        c = codec(path)
        return pd.Series([[int(i) for i in ids.split()] for _, ids, _ in c.encode_many(text)], dtype=object)

    return run(text_col)


def decoded_text(ids_col, path: str):
    """Column of the texts that lists of token ids decode to; null for a null list."""
    @F.pandas_udf(StringType())
    def run(ids: pd.Series) -> pd.Series:
        c = codec(path)
        return pd.Series([None if x is None else c.decode(list(x)) for x in ids], dtype=object)

    return run(ids_col)


def tokenized(docs: DataFrame, text_col: str = "text", path: str | None = None, to: str = "tokens") -> DataFrame:
    """``docs`` with its columns and the array of token ids, under ``to`` or, if that is taken, a fresh name."""
    return docs.withColumn(fresh(docs, to), token_ids(F.col(text_col), path or default_path()))


def token_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of every row."""
    d = digests(F.col(text_col), path or default_path())
    return docs.select(F.col(id_col).alias("doc_id"), d.alias("d")).select("doc_id", "d.*")
