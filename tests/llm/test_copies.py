"""Operators 2, 3, 5 and 7 against brute force."""

import hashlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from ledgerlens.llm import components, line_dedup, ngram_join, passage_dedup, suffix_dedup
from ledgerlens.llm.common import stored

from .conftest import lines_of, prose


def key(x):
    return str(tuple(x))


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def closed(links, n):
    label = list(range(n))
    while True:
        before = list(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def brute_groups(texts):
    s = [shingles(t) for _, t in texts]
    links = [(i, j) for i in range(len(s)) for j in range(i) if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j])]
    label = closed(links, len(s))
    out = []
    for i in range(len(s)):
        ids = [texts[j][0] for j in range(len(s)) if label[j] == label[i] and texts[j][0] is not None]
        out.append((texts[i][0], len(s[i]), min(ids, default=None)))
    return out


def test_ngram_join(docs, rows, empty):
    got = [tuple(r) for r in ngram_join.similar_documents(docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(map(key, got)) == sorted(map(key, brute_groups([r[:2] for r in rows])))
    assert ngram_join.similar_documents(empty).count() == 0


def test_ngram_join_clusters(spark):
    """Chains and rings of near copies around the threshold, and groups with equal prefixes."""
    rng = np.random.default_rng(5)
    texts = []
    for group in range(6):
        base = prose(100 + group, 60)
        for k in range(25):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(0, len(w)))] = f"edit{rng.integers(0, 3)}"
            texts.append((len(texts) * 7 % 1009, " ".join(w)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = [tuple(r) for r in ngram_join.similar_documents(docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got) == sorted(brute_groups(texts))


def test_one_of_each_group_stays(docs):
    kept = ngram_join.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    # 1 stands for 1, 3, near copy 2 and the copy under a null id; the other text under id 2 stays
    assert ids == sorted(map(str, [1, 2, None, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19]))


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)] + [(500, 500 + k) for k in range(1, 90)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = closed([e for e in edges if e[0] != e[1]], 600)
    assert got == {n: label[n] for e in edges if e[0] != e[1] for n in e}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(rows):
    docs = sorted({r[:2] for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    places = [(k, i, x) for k, (_, t) in enumerate(docs) for i, x in enumerate((t or "").split("\n")) if len(x) >= line_dedup.MIN_CHARS]
    first = {}
    for k, i, x in places:
        first.setdefault(x, (k, i))
    near = {x for x in first for y in first if x != y and abs(len(x) - len(y)) <= 2 and first[y] < first[x] and levenshtein(x, y) <= 2}
    return docs, [[i for k, i, x in places if k == d and (x in near or first[x] != (k, i))] for d in range(len(docs))]


def test_line_dedup(docs, rows, empty):
    few = docs.where("doc_id is null or doc_id not in (2, 14)")  # two texts under id 2 are ordered by hash; 14 is long
    want_docs, want = brute_lines([r for r in rows if r[0] not in (2, 14)])
    nulls = [",".join(map(str, w)) for (i, _), w in zip(want_docs, want) if i is None]
    got = {(r.doc_id): r.removed for r in line_dedup.document_lines(few).collect() if r.doc_id is not None}
    assert got == {i: ",".join(map(str, w)) for (i, _), w in zip(want_docs, want) if i is not None}
    assert set(nulls) == {""}
    kept = line_dedup.dedup_lines(few)
    assert kept.columns == docs.columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    for (i, t), w in zip(want_docs, want):
        left = "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in w)
        if i is not None and w:
            assert texts.get(i) == ((left, len(left)) if left.split() else None)
    assert line_dedup.document_lines(empty).count() == 0 and line_dedup.dedup_lines(empty).count() == 0


def test_edit_distance_and_keys(spark):
    rng = np.random.default_rng(2)

    def edit(s, k):
        s = list(s)
        for _ in range(k):
            i, c = int(rng.integers(0, len(s) + 1)), "abé💥"[rng.integers(0, 4)]
            s[i:i + int(rng.integers(0, 2))] = [c] if rng.integers(0, 3) else []
        return "".join(s)

    for edits in (1, 2, 3):
        pairs = []
        while len(pairs) < 300:
            a = "".join("abé💥"[i] for i in rng.integers(0, 4, int(rng.integers(edits + 1, 14))))
            b = edit(a, int(rng.integers(0, 5)))
            if len(b) > edits and abs(len(a) - len(b)) <= edits:
                pairs.append((a, b))
        d = spark.createDataFrame(pairs, "a string, b string").withColumn("d", line_dedup.edit_distance(F.col("a"), F.col("b"), edits))
        for n in "ab":
            d = d.withColumn(f"k{n}", line_dedup.segment_keys(F.col(n), F.char_length(n), edits))
        for r in d.collect():
            exact = levenshtein(r.a, r.b)
            assert r.d == exact or (r.d > edits and exact > edits), (r.a, r.b, edits)
            if exact <= edits:
                assert {x.key for x in r.ka if x.own} & {x.key for x in r.kb} or {x.key for x in r.kb if x.own} & {x.key for x in r.ka}


def test_crowded_segments(spark, monkeypatch):
    """Lines of a template, and short lines of few letters with few grams, whose keys hold more lines than are paired out."""
    monkeypatch.setattr(line_dedup, "CROWD", 3)
    rng = np.random.default_rng(5)
    ids = ["".join("01é💥"[i] for i in rng.integers(0, 4, 6)) for _ in range(90)]
    plain = [f"The parcel with the number {x} was sent to you" for x in ids]
    plain += [f"number number {x[:3]} number number number {x[3:]}" for x in ids[:60]]
    plain += ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" + x[:k] for k, x in enumerate(ids[:6])]
    plain += ["".join("abc"[i] for i in rng.integers(0, 3, int(rng.integers(4, 15)))) for _ in range(120)]
    plain = sorted(set(plain))
    lines = spark.createDataFrame([(x,) for x in plain + plain[:20]], "line string").select(F.xxhash64("line").alias("h1"), "line", F.char_length("line").alias("n"))
    of = {r.h1: r.line for r in lines.collect()}
    for edits in (1, 2, 3):
        got = [frozenset((of[r.a], of[r.b])) for r in line_dedup.near_pairs(lines, edits).collect()]
        want = {frozenset((x, y)) for i, x in enumerate(plain) for y in plain[:i] if abs(len(x) - len(y)) <= edits and levenshtein(x, y) <= edits}
        assert len(got) == len(set(got)) and set(got) == want and want


def test_crowded_segments_make_few_candidates(spark):
    """A thousand lines of a template and their ids: as many rows meet as lines, not as pairs of them."""
    rng = np.random.default_rng(6)
    texts = [f"Your order {int(x):014d} was shipped to the address on file" for x in rng.integers(0, 10**14, 1000)]
    lines = spark.createDataFrame([(x,) for x in texts], "line string").select(F.xxhash64("line").alias("h1"), "line", F.char_length("line").alias("n"))
    pairs = line_dedup.rare_gram_pairs(lines)
    assert pairs.groupBy("h1").count().where("count > 28").count() == 0
    met = pairs.groupBy("pair").count().agg(F.sum(F.expr("count * (count - 1) div 2"))).first()[0]
    assert met < 20 * 1000  # of 499,500


def brute_repeats(texts, length=100):
    seen, out = set(), []
    for i, t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            if w in seen:
                gone[s:s + length] = True
            seen.add(w)
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + bool(len(b) and gone[0]))
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def test_byte_repeats(docs, rows, empty):
    unique = docs.where("doc_id not in (2, 14)")
    texts = sorted([r[:2] for r in rows if r[0] not in (None, 2, 14)])
    for hot in (suffix_dedup.HOT, 2):
        assert sorted(tuple(r) for r in suffix_dedup.document_repeats(unique, hot).collect()) == brute_repeats(texts)
    assert suffix_dedup.document_repeats(empty).count() == 0
    every = suffix_dedup.document_repeats(docs).collect()
    assert len(every) == len(rows) and sum(r.n_removed == 0 and r.n_bytes > 5000 for r in every) >= 1


def test_byte_repeats_nested_and_periodic(spark):
    """Nested prefixes, short periods, zero bytes, and copies over slices: removals equal brute force."""
    rng = np.random.default_rng(11)
    base = ["".join(rng.choice(list("ab\x00é"), 400)) for _ in range(4)]
    texts = [(0, "ab" * 150), (1, "x" + "ab" * 90), (2, "\x00" * 130), (3, "c" + "\x00" * 260 + "d"), (4, base[0] + base[1])]
    for i in range(5, 60):
        b = base[int(rng.integers(4))]
        at, n = int(rng.integers(0, 250)), int(rng.integers(60, 300))
        texts.append((i, "".join(rng.choice(list("xyz"), int(rng.integers(0, 40)))) + b[at:at + n] + "".join(rng.choice(list("ab"), 3)) + b[:n]))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for parts in (1, 7):
        spread = stored(docs.repartition(parts), "test_nested")
        for hot in (suffix_dedup.HOT, 5):
            assert sorted(tuple(r) for r in suffix_dedup.document_repeats(spread, hot).collect()) == brute_repeats(texts)


def test_intervals_of_a_bucket():
    """The stack scan gives every repeat that differs to the left, or starts its surroundings, with all occurrences."""
    rng = np.random.default_rng(12)
    core = bytes(rng.choice(list(b"abc"), 168).astype(np.uint8))
    texts = []
    for _ in range(40):
        at, n = int(rng.integers(0, 50)), int(rng.integers(100, 160))
        texts.append((bytes(rng.choice(list(b"ab"), int(rng.integers(0, 8))).astype(np.uint8)) + core[at:at + n])[:168])
    items, docs = np.zeros(len(texts), suffix_dedup._CONTEXT), np.zeros(len(texts), suffix_dedup._DOC)
    items["doc"], items["windows"], items["before"] = np.arange(len(texts)), [len(t) - 99 for t in texts], -1
    docs["order"] = docs["rid"] = np.arange(len(texts))
    array = suffix_dedup.SuffixArray([{"slice": 0, "items": items.tobytes(), "docs": docs.tobytes(), "bytes": zstandard.compress(b"".join(texts))}])
    got = [(n, frozenset(zip(array.doc[a:b].tolist(), array.start[a:b].tolist()))) for a, b, n in zip(*(x.tolist() for x in array.repeats()))]
    wanted = set()
    for length in range(100, 169):
        places = {}
        for i, t in enumerate(texts):
            for s in range(len(t) - length + 1):
                places.setdefault(t[s:s + length], []).append((i, s))
        for same in places.values():
            left = {texts[i][s - 1] if s else -1 for i, s in same}
            right = {texts[i][s + length] if s + length < len(texts[i]) else (i, s) for i, s in same}
            if len(same) > 1 and (len(left) > 1 or -1 in left) and len(right) > 1:
                wanted.add((length, frozenset(same)))
    assert len(got) == len(set(got)) and set(got) == wanted and any(n > 100 for n, _ in got)


def test_maximal_repeats(spark):
    common = " ".join(prose(9, 30))[:120]
    texts = [(1, "q" * 10 + common + "zz"), (2, common + "!"), (3, "some " + common[:110] + " other"), (4, "nothing here")]
    groups = {}
    for r in suffix_dedup.maximal_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        groups.setdefault((r.group_id, r.length), set()).add((r.doc_id, r.start))
    assert {(1, 10), (2, 0), (3, 5)} in groups.values()
    data = {i: t.encode() for i, t in texts}
    for (_, n), places in groups.items():
        assert n >= 100 and len({data[i][s:s + n] for i, s in places}) == 1


def test_passages(docs, empty, spark):
    got = passage_dedup.repeated_passages(docs).collect()
    later = {r.doc_id: r for r in got}
    assert later[10].kept_doc_id == 9 and later[10].end_word - later[10].first_word >= 30
    assert 33 <= later[10].first_word and later[10].end_word <= 103
    assert 3 in later and 14 not in later and 9 not in later and 7 not in later
    assert passage_dedup.repeated_passages(empty).count() == 0
    # passages pasted into other text, mid-line: every one is found, clean documents are left alone
    passages = [prose(1000 + k, 60) for k in range(20)]
    texts = [(i, " ".join(prose(2000 + i, 40 + i % 30) + (passages[i % 20] if i < 100 else []) + prose(3000 + i, 37))) for i in range(160)]
    found = {r.doc_id for r in passage_dedup.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found == set(range(20, 100))


def test_few_key_rows():
    """Rows between slices and buckets stay few as text and partitions grow; a part of the paragraphs has the keys it has among all."""
    text, partitions = 10 << 30, 600
    assert passage_dedup.key_buckets(text, partitions) * (text // suffix_dedup.SLICE_BYTES) < 7_000_000
    assert passage_dedup.key_buckets(0, 8) == 8
    words = np.random.default_rng(1).integers(0, 50, 900).astype(np.uint64)
    begins = np.r_[0, np.sort(np.random.default_rng(2).choice(np.arange(1, 900), 80, replace=False))]
    ends = np.r_[begins[1:], 900]
    h, cuts, digest = passage_dedup.shingle_sets(begins, ends, words)
    some = np.arange(3, 81, 4)
    h2, cuts2, digest2 = passage_dedup.shingle_sets(begins[some], ends[some], words)
    assert (digest2 == digest[some]).all()
    assert (passage_dedup.band_keys(h2, cuts2) == passage_dedup.band_keys(h, cuts)[some]).all()


def test_edited_passages(spark):
    """Pasted passages with an edit in the middle, and repeats within one document, are found to their true ends."""
    rng, texts, planted = np.random.default_rng(21), [], {}
    for k in range(100):
        n = (51, 60, 80, 100)[k % 4]
        passage = prose(7000 + k, n)
        edited = {0: passage, 1: passage[:n // 2] + ["edited"] + passage[n // 2 + 1:], 2: passage[:n // 2] + passage[n // 2 + 1:]}[k % 3]
        before = prose(8000 + k, int(rng.integers(20, 70)))
        texts += [(3 * k, " ".join(prose(9000 + k, 40) + passage + prose(10000 + k, 40))), (3 * k + 1, " ".join(before + edited + prose(11000 + k, 30))),
                  (3 * k + 2, " ".join(prose(12000 + k, 90)))]
        planted[3 * k + 1] = (len(before), len(before) + len(edited))
    twice = prose(13000, 70)
    texts.append((1000, " ".join(prose(13001, 30) + twice + prose(13002, 30) + twice + prose(13003, 30))))
    got = {}
    for r in passage_dedup.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.first_word, r.end_word, r.kept_doc_id))
    assert got.pop(1000) == [(130, 200, 1000)]
    assert set(got) <= set(planted)  # first copies and clean documents stay
    covered = [sum(max(0, min(b, e) - max(a, s)) for s, e, _ in got.get(d, [])) / (b - a) for d, (a, b) in planted.items()]
    assert sum(c >= 0.95 for c in covered) >= 95 and all(kept == d - 1 for d, v in got.items() for _, _, kept in v)


def test_extension():
    """Over an edit as long as the passage keeps the threshold; not into unlike text."""
    def words(x):
        return np.array(x, "<u4").tobytes()

    text, other = list(range(60)), list(range(100, 160))
    edited = [*text[:20], 999, *text[21:]]
    assert passage_dedup.grown(words(text), words(edited), 12, (0, 0)) == (60, (5, 5))
    assert passage_dedup.grown(words(text), words(text[:20] + text[21:]), 12, (0, 0)) == (60, (5, 4))
    assert passage_dedup.grown(words(text[:20] + other), words(text), 12, (0, 0)) == (20, (0, 0))
    assert passage_dedup.grown(words([*text[:3], 999, *text[4:20]]), words(text[:20]), 12, (0, 0)) == (3, (0, 0))  # else 23 of 33 shingles
    assert passage_dedup.grown(b"", words(text), 12, (0, 0)) == (0, (0, 0))


def test_short_lines_and_copied_documents(spark):
    """Exact repeats go whatever their length; of a copy no fragment is left; short lines are not joined by edits."""
    body = lines_of(prose(70, 48))
    texts = [(1, f"Heading\n{body}\n\nend."), (2, f"Heading\n{body}\n\nend."), (3, "Heading\n" + lines_of(prose(71, 24)) + "\n\nend!"),
             (4, "Menu\n \nMenu\nHeading"), (5, "Heading"), (6, "  \n\n"), (7, None), (8, f"Heading\n{body}\nend. x")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: texts[0][1], 3: texts[2][1].removeprefix("Heading\n"), 4: "Menu\n ", 6: "  \n\n", 7: None, 8: "end. x"}


def test_one_of_each_group_by_id_and_version(spark):
    """Near copies under one doc_id, and a group in which no doc_id is known, keep one row each."""
    base, other, third = prose(80, 60), prose(81, 60), prose(82, 60)
    edited = lambda w, k: " ".join(w[:k] + ["changed"] + w[k + 1:])
    texts = [(5, " ".join(base)), (5, edited(base, 0)), (6, edited(base, 1)), (None, edited(base, 59)), (5, " ".join(third)),
             (None, " ".join(other)), (None, edited(other, 0)), (None, edited(other, 59)), (7, " ".join(prose(83, 60))), (None, None), (8, "")]
    for rows in (texts, [*texts, *texts[:2]]):
        kept = [tuple(r) for r in ngram_join.keep_one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
        assert len(set(kept)) == len(kept) and set(kept) <= set(texts)
        groups = [texts[:4], texts[5:8]]
        assert [sum(k in g for k in kept) for g in groups] == [1, 1]
        assert [k[0] for k in kept if k in texts[:4]] == [5]
        assert {texts[4], texts[8], texts[9], texts[10]} <= set(kept)


def brute_maximal(texts, length=100):
    """{(length, places)}: what a pair of places with other bytes, or an end, on both sides has in common, with all its places."""
    data, places, found, out = {i: t.encode() for i, t in texts}, {}, set(), set()
    for i, b in data.items():
        for s in range(len(b) - length + 1):
            places.setdefault(b[s:s + length], []).append((i, s))
    for same in places.values():
        for k, (i, s) in enumerate(same):
            for j, u in same[:k]:
                if s == 0 or u == 0 or data[i][s - 1] != data[j][u - 1]:
                    n = length
                    while s + n < len(data[i]) and u + n < len(data[j]) and data[i][s + n] == data[j][u + n]:
                        n += 1
                    found.add(data[i][s:s + n])
    for w in found:
        out.add((len(w), frozenset((i, s) for i, s in places[w[:length]] if data[i][s:s + len(w)] == w)))
    return out


def test_maximal_repeats_are_whole(spark):
    """Repeats far longer than a window, within a slice and across, nested, periodic, and at the ends of documents."""
    long, inner = " ".join(prose(90, 400)), " ".join(prose(91, 50))
    texts = [(1, long + " tail"), (2, "x " + long), (3, "copied " + inner), (4, "copied " + inner), (5, f"{inner} mid {inner} end"), (6, long[300:900] + "!"),
             (7, "abc" * 60), (8, long), (9, "z" + "abc" * 50), (10, "é" * 40), (11, "alone " + " ".join(prose(92, 60)))]
    want = brute_maximal(texts)
    assert max(n for n, _ in want) == len(long.encode()) > 1000
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for parts in (1, 4):
        groups = {}
        for r in suffix_dedup.maximal_repeats(stored(docs.repartition(parts), "test_repeats")).collect():
            groups.setdefault((r.group_id, r.length), []).append((r.doc_id, r.start))
        assert all(len(set(v)) == len(v) for v in groups.values()) and len(groups) == len(want)
        assert {(n, frozenset(v)) for (_, n), v in groups.items()} == want
    assert suffix_dedup.maximal_repeats(docs.limit(0)).count() == 0
