"""Operator 12: spelling variants by a variable-length gram index.

1. Words are counted over whole texts; hashes and crc32 run over whole slices at once.
2. Gram dictionary: the frequent grams of the words (lengths QMIN to QMAX - 1).  A gram is only made
   longer while it is frequent, so lists stay short.  "Frequent" is a share of all gram places, so
   at most DICTIONARY grams of each length are kept: this bounds what each task is given.
3. A word is cut into variable grams: at each place the shortest gram that is not frequent, or that
   ends with the word; those inside an earlier one are left out.
4. Affected grams: for each place of an edit, the grams that it may change are those over the place,
   those left of it that a longer gram could swallow, and those right of it that a new gram could
   swallow.  The largest number of them is the word's bound b: a word one edit away shares all but b
   of the grams.  So two such words meet in one of their b + 1 rarest grams, with all before or all
   behind it: lists go by these and the length.  What meets is verified.
   Two words with no more than b grams each meet by their halves instead, one of which an edit leaves
   whole.
5. Forms come from the near words by partial maxima; roots by following forms, twice as far in each round.

Defined results: null texts have no words; a null doc_id counts as an empty one in the hashed
string.  Repeated rows count again.  Ties of n go to the smallest word in code-point order.  Empty
tables give no rows.  Very long words have as few keys as others.  Further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textops as T
from ledgerlens.llm.common import ship_code, stored

#: Code points of a word, and occurrences of it, at least.
MIN_CHARS, MIN_COUNT = 7, 2
#: A form is this many times as frequent as its variant.
FORM_FACTOR = 10
#: One code point of every so many (document, run) pairs is deleted.
DELETE_EACH = 31
QMIN, QMAX = 2, 4
#: Frequent grams of each length, at most, and the places a frequent gram has at least.
DICTIONARY, MIN_PLACES = 50_000, 200
SLICE_BYTES = 4 << 20
#: Longer words and keys are hashed one by one.
LONG_WORD = 64


# ---------------------------------------------------------------- words
def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()
_in_word = np.arange(256) > 0


def crc32_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """crc32 of buf[start:end] for each span, continued from the crc32 in ``begin``."""
    length, out = end - start, np.zeros(len(start), dtype=np.uint32)
    for i in np.flatnonzero(length > LONG_WORD).tolist():
        out[i] = zlib.crc32(buf[start[i]:end[i]].tobytes(), int(begin[i]))
    rest = np.flatnonzero(length <= LONG_WORD)
    rest = rest[np.argsort(-length[rest], kind="stable")]
    state = begin[rest] ^ np.uint32(0xFFFFFFFF)
    for j in range(int(length[rest[0]]) if len(rest) else 0):
        n = int(np.searchsorted(-length[rest], -j, side="left"))  # spans longer than j
        state[:n] = _CRC[(state[:n] ^ buf[start[rest[:n]] + j]) & 255] ^ (state[:n] >> np.uint32(8))
    out[rest] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _slice_words(ids: list, buf: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], list[int]]:
    """Distinct words of a slice, with their counts; a deleted code point may make two entries of one word."""
    lead = buf == 0xC3  # U+00C0 to U+00FF are this byte and another
    inside = lead | ((buf | 32) >= 97) & ((buf | 32) <= 122) & (buf < 128)
    inside[1:] |= lead[:-1]
    start, end, first = T.word_spans(inside.astype(np.uint8), offsets, _in_word)
    leads = np.concatenate([[0], np.cumsum(lead)])
    chars = (end - start) - (leads[end] - leads[start])
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keep = chars >= MIN_CHARS
    start, end, chars, doc = start[keep], end[keep], chars[keep], doc[keep]
    h = T.span_hashes(T.prefix_sums(buf), start, end)
    order = np.lexsort((h, doc))  # a run's place in a document does not matter
    new = np.ones(len(order), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    at, n = order[new], np.diff(np.append(np.flatnonzero(new), len(order)))
    start, end, chars, doc, h = start[at], end[at], chars[at], doc[at], h[at]
    begin = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], dtype=np.uint32)
    crc = crc32_spans(buf, start, end, begin[doc])
    cut = crc % np.uint32(DELETE_EACH) == 0
    _, one, of = np.unique(h[~cut], return_index=True, return_inverse=True)
    counts = np.bincount(of, weights=n[~cut], minlength=len(one)).astype(np.int64)
    data = buf.tobytes()
    words = [data[a:b] for a, b in zip(start[~cut][one].tolist(), end[~cut][one].tolist())]
    changed: Counter = Counter()
    for a, b, c, k, m in zip(*(x[cut].tolist() for x in (start, end, crc, chars, n))):
        if k > MIN_CHARS:
            word = data[a:b].decode()
            changed[(word[:c % k] + word[c % k + 1:]).encode()] += m
    return words + list(changed), counts.tolist() + list(changed.values())


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words, stored."""
    ship_code(docs.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, offsets in T.cut_slices(batch, "text", SLICE_BYTES):
                words, n = _slice_words(rows.column(0).to_pylist(), T.lower_ascii(raw), offsets)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = wanted.mapInArrow(read, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counted.where(F.col("n") >= MIN_COUNT), "words")


# ---------------------------------------------------------------- variable grams
def frequent_grams(words: DataFrame, dictionary: int = DICTIONARY, min_places: int = MIN_PLACES) -> dict[str, int]:
    """Frequent grams with their number of places; at most ``dictionary`` of each length."""
    ship_code(words.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = Counter(w[p:p + q] for w in batch.column(0).to_pylist() for q in range(QMIN, QMAX) for p in range(len(w) - q + 1))
            yield pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], ["gram", "n"])

    grams = stored(words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
                   .where(F.col("n") >= min_places), "grams")
    places = words.agg(F.sum(F.length("word")).alias("n")).first()["n"] or 0  # of grams of one length, at most
    least = max(min_places, -(-places // dictionary))
    return {r["gram"]: r["n"] for r in grams.where(F.col("n") >= least).collect()}


class GramDictionary:
    """What decides how words are cut.  A prefix of a frequent gram is frequent, as counts go by place."""

    def __init__(self, frequent: dict[str, int]):
        self.frequent = frequent
        self.inner = {g[j:] for g in frequent for j in range(1, len(g) - QMIN + 2)}  # proper suffixes

    def cut(self, word: str) -> list[tuple[int, str]]:
        """(place, gram), ascending; a gram within an earlier one is left out."""
        out, reach, n = [], 0, len(word)
        for p in range(n - QMIN + 1):
            q = QMIN
            while q < QMAX and p + q < n and word[p:p + q] in self.frequent:
                q += 1
            if p + q > reach:
                out.append((p, word[p:p + q]))
                reach = p + q
        return out

    def _left(self, word: str, i: int) -> int:
        """The least p such that a gram could start with word[p:i] and go on."""
        p = i
        for q in range(1, min(i, QMAX - 1) + 1):
            if q < QMIN or word[i - q:i] in self.frequent:
                p = i - q
        return p

    def _right(self, word: str, i: int) -> int:
        """The largest e such that a gram could start before and end with word[i:e]."""
        e = i
        for q in range(1, min(len(word) - i, QMAX - 1) + 1):
            if q < QMIN or word[i:i + q - 1] in self.inner:
                e = i + q
        return e

    def affected(self, word: str, grams: list[tuple[int, str]]) -> int:
        """The largest number of grams that one edit may change."""
        spans, most, low = [(p, p + len(g)) for p, g in grams], 0, 0
        for i in range(len(word) + 1):
            left, here, after = self._left(word, i), self._right(word, i), self._right(word, min(i + 1, len(word)))
            while low < len(spans) and spans[low][1] <= left:
                low += 1  # further left than anything an edit here reaches
            high = bisect_right(spans, (i + QMAX, 0))
            near = spans[low:high]
            swallowed = sum(a >= left and b <= i for a, b in near)
            inserted = sum(a < i < b or a >= i and b <= here for a, b in near)
            changed = sum(a <= i < b or a > i and b <= after for a, b in near) if i < len(word) else 0
            most = max(most, swallowed + max(inserted, changed))
        return most

    def _rarity(self, gram: str) -> int:
        """An estimate of a gram's frequency, the same for every word."""
        return self.frequent.get(gram) or min(self.frequent.get(gram[:-1], 0), self.frequent.get(gram[1:], 0))

    def keys(self, word: str) -> tuple[bool, list[tuple[str, bool]]]:
        """(weak, [(key, probes)]): the index keys of a word, and whether it looks for others by them.

        A gram that an edit leaves alone lies left of it, and then all before the gram is left alone
        too, or right of it, and then all behind it: so a key is a gram with all before or all behind it.
        """
        grams = self.cut(word)
        bound = self.affected(word, grams)
        rarest = sorted(grams, key=lambda g: (self._rarity(g[1]), g[1], g[0]))[:bound + 1]
        out = [(k, True) for p, g in rarest for k in ("<" + word[:p + len(g)], ">" + word[p:])]
        weak = bound >= len(grams)
        if weak:  # two such words may share no gram: halves of this length, and of one less for a shorter partner
            for n in (len(word), len(word) - 1):
                out += [("(" + word[:n // 2], n == len(word)), (")" + word[len(word) - (n - n // 2):], n == len(word))]
        return weak, [(k if len(k) <= LONG_WORD else k[0] + blake2b(k.encode(), digest_size=16).hexdigest(), own) for k, own in out]


def gram_index(words: DataFrame, dictionary: GramDictionary) -> DataFrame:
    """(key, length, probes, weak, word, n): the posting lists, stored."""
    ship_code(words.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, word in enumerate(batch.column(0).to_pylist()):
                weak, keys = dictionary.keys(word)
                rows += [(key, len(word), own, weak, i) for key, own in keys]
            key, length, own, weak, at = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(length, pa.int32()), pa.array(own, pa.bool_()), pa.array(weak, pa.bool_()),
                                              *batch.take(pa.array(at, pa.int64())).columns], ["key", "length", "probes", "weak", "word", "n"])

    return stored(words.select("word", "n").mapInArrow(read, "key string, length int, probes boolean, weak boolean, word string, n long"), "gram_index")


def near_pairs(index: DataFrame) -> DataFrame:
    """(a, na, b, nb): all pairs of words one edit apart, once each; b is longer, or the greater of equally long ones."""
    lengths = F.explode(F.array(F.col("length"), F.col("length") + 1)).alias("length")
    probe = index.where("probes").select("key", lengths, F.col("length").alias("own"), F.col("weak").alias("weak_a"), F.col("word").alias("a"), F.col("n").alias("na"))
    lists = index.select("key", "length", "weak", F.col("word").alias("b"), F.col("n").alias("nb"))
    halves = F.col("key") < "*"  # two weak words meet by their halves only
    ordered = (F.col("own") < F.col("length")) | (F.col("a") < F.col("b"))
    near = (halves == (F.col("weak") & F.col("weak_a"))) & ordered & (F.levenshtein("a", "b", 1) == 1)
    return probe.join(lists, ["key", "length"]).where(near).select("a", "na", "b", "nb").distinct()


def with_forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))
    best = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("nb"), F.col("b"))).alias("best"))
    best = best.select("word", "n_near", (-F.col("best.col1")).alias("best_n"), F.col("best.b").alias("best"))
    has = F.col("best_n") >= FORM_FACTOR * F.col("n")
    return words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                                   F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form.  Each form is ten times as frequent, so chains are short and end."""
    links = stored(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        links = moved.select("word", "root")
        if moved.where("next is not null").isEmpty():
            return links


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents."""
    words = word_counts(docs)
    dictionary = GramDictionary(frequent_grams(words))
    forms = stored(with_forms(words, near_pairs(gram_index(words, dictionary))), "forms")
    return (forms.join(roots(forms), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
