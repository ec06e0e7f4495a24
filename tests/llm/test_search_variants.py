"""Operators 11, 12 and 13 against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import exact_dedup, lexical_search, spelling_variants as sv

from .conftest import prose


def key(x):
    return str(tuple(x))


# ---------------------------------------------------------------- 11
def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_search(docs, items, top=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    terms = [pattern.findall(fold(t)) for _, t in docs]
    total, n_docs = sum(map(len, terms)), sum(bool(t) for t in terms)
    df = Counter(x for t in terms for x in set(t))
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), t in zip(docs, terms):
            tf, m = Counter(t), 10 + (90 * len(t) * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * tf[x]) // (1000 * tf[x] + 8 * m))
                    for x in set(pattern.findall(fold(text))) if tf[x])
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return out


def test_ranked_search(spark, docs, rows, empty):
    items = [(1, "Same four WORDS are here é"), (2, rows[0][1]), (2, rows[0][1]), (None, "license GPL 3 四 中文字"), (4, None), (5, "zzzzunknown"),
             (6, " ".join(prose(8, 400)))]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    got = [tuple(r) for r in lexical_search.ranked(docs, table).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(map(key, got)) == sorted(map(key, brute_search([r[:2] for r in rows], items)))
    assert lexical_search.ranked(empty, table).count() == 0
    assert lexical_search.ranked(docs, table.limit(0)).count() == 0


def test_search_copies_and_blocks(spark, monkeypatch):
    """Large classes of equal bags, ties across classes, several blocks of items and of classes."""
    r, vocabulary = random.Random(4), prose(11, 40)
    base = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 12))) for _ in range(40)]
    texts = [(i * 37 % 1201, r.choice(base) if i % 3 else base[0]) for i in range(600)]
    items = [(i, " ".join(r.sample(vocabulary, 3))) for i in range(12)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    monkeypatch.setattr(lexical_search, "BLOCK_CELLS", 200)
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(map(key, brute_search(texts, items)))
    assert sorted(map(key, (tuple(x) for x in lexical_search.ranked(docs, table).collect()))) == expected
    blocks = list(lexical_search.item_blocks(table, max_bytes=100))
    assert len(blocks) > 2 and sum(map(len, blocks)) == 12
    monkeypatch.setattr(lexical_search, "item_blocks", lambda items: iter(blocks))
    assert sorted(map(key, (tuple(x) for x in lexical_search.ranked(docs, table).collect()))) == expected


# ---------------------------------------------------------------- 12
def brute_counts(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_variants(docs):
    n = brute_counts(docs)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return [(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n]


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spelling_variants(spark, seed, monkeypatch):
    """Words over few letters, so that grams are frequent, words weak and chains of forms long."""
    r = random.Random(seed)
    letters = "abé" if seed < 3 else "abcdefghijklmn"
    monkeypatch.setattr(sv, "MIN_PLACES", [5, 20, 50][seed - 1])
    base = ["".join(r.choice(letters) for _ in range(r.randint(6, 11))) for _ in range(60)]
    texts = []
    for i in range(80):
        words = []
        for w in base:
            words += [w.upper() if r.random() < .1 else w] * r.choice([1, 1, 2, 30])
            j = r.randrange(len(w))
            words += [w[:j] + r.choice(letters) + w[j + 1:], w[:j] + w[j + 1:], w[:j] + r.choice(letters) + w[j:]]
        texts.append((i if i % 9 else None, r.choice([" ", ", ", "1"]).join(words)))
    got = [tuple(x) for x in sv.variants(spark.createDataFrame(texts, "doc_id long, text string")).select(COLUMNS).collect()]
    expected = brute_variants(texts)
    assert any(x[1] for x in expected) and any(x[2] not in (x[0], x[1]) for x in expected)
    assert sorted(map(key, got)) == sorted(map(key, expected))


def test_spelling_fixture(docs, rows, empty):
    got = [tuple(x) for x in sv.variants(docs).select(COLUMNS).collect()]
    assert sorted(map(key, got)) == sorted(map(key, brute_variants([x[:2] for x in rows])))
    assert sv.variants(empty).count() == 0


def test_long_words(spark):
    word = "ab" * 20000
    texts = [(1, f"{word} {word} {word}c {word}c"), (2, "x" * 300 + " " + "x" * 300 + " " + "x" * 299 + "y")]
    got = [tuple(x) for x in sv.variants(spark.createDataFrame(texts, "doc_id long, text string")).select(COLUMNS).collect()]
    assert sorted(map(key, got)) == sorted(map(key, brute_variants(texts)))


def test_affected_bound():
    """No single edit changes more grams than the bound says."""
    r = random.Random(9)
    for letters, least in (("ab", 3), ("abc", 6), ("abcdefg", 4)):
        words = {"".join(r.choice(letters) for _ in range(r.randint(7, 13))) for _ in range(150)}
        places = Counter(w[p:p + q] for w in words for q in range(sv.QMIN, sv.QMAX) for p in range(len(w) - q + 1))
        d = sv.GramDictionary({g: n for g, n in places.items() if n >= least})
        for w in words:
            grams, n = d.cut(w), len(w)
            bound = d.affected(w, grams)
            for i in range(n + 1):
                for c in letters:
                    for v in {w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]}:
                        other, move = set(d.cut(v)), len(v) - n
                        kept = sum((p, g) in other and p + len(g) <= i or (p + move, g) in other and p >= i for p, g in grams)
                        assert len(grams) - kept <= bound, (w, v)


def test_crc():
    r = np.random.default_rng(3)
    buf = r.integers(0, 256, 5000).astype(np.uint8)
    start = r.integers(0, 4000, 200)
    end = start + r.integers(0, 200, 200)
    begin = r.integers(0, 2**32, 200).astype(np.uint32)
    assert sv.crc32_spans(buf, start, end, begin).tolist() == [zlib.crc32(buf[a:b].tobytes(), int(c)) for a, b, c in zip(start, end, begin)]


# ---------------------------------------------------------------- 13
def test_exact_copies(docs, rows, empty):
    got = exact_dedup.exact_copies(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    groups = {}
    for doc_id, text in (x[:2] for x in rows):
        groups.setdefault(text or "", []).append(doc_id)
    expected = [(d, max((i for i in ids if i is not None), default=None), len(ids), hashlib.sha256(t.encode()).hexdigest())
                for t, ids in groups.items() for d in ids]
    assert sorted(key((r[0], r[1], r[2], r[4])) for r in got) == sorted(map(key, expected))
    kept = [r for r in got if r["kept"]]
    assert sorted(r["text_sha256"] for r in kept) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    assert exact_dedup.exact_copies(empty).count() == 0


def test_exact_copies_hot(spark):
    """A group with a third of all rows, others of every size, over both history and incoming rows."""
    texts = [(i, "hot" if i % 3 == 0 else f"t{i * i % 411}") for i in range(3000)]
    got = exact_dedup.exact_copies(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()
    last, size = {t: i for i, t in texts}, Counter(t for _, t in texts)
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == [(i, last[t], size[t], i == last[t]) for i, t in texts]


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_perfect_hash(n):
    words = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(2 * n)), dtype="<u8").reshape(-1, 4)
    levels, slot = exact_dedup.build_levels(words[:n])
    assert sorted(slot.tolist()) == list(range(n))
    assert exact_dedup.find_slots(levels, words[:n]).tolist() == slot.tolist()
    assert exact_dedup.find_slots(levels, words[n:]).max(initial=-1) < n
