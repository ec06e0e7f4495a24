"""Operators 6, 9 and 10 against brute force, row by row."""

import hashlib
import re

from ledgerlens.llm import license_scan, quality_rules, secret_scan

KINDS = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
         ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def key(x):
    return str(tuple(x))


def words(t):
    return [w.decode() for w in (t or "").encode().split()]


def test_secrets(docs, rows, empty):
    want = []
    for r in rows:
        found = sorted((m.start(), i, m.end()) for i, (_, p, ok) in enumerate(KINDS) for m in p.finditer(r[1] or "") if ok(m))
        joined = ",".join(f"{KINDS[i][0]}:{a}:{b}" for a, i, b in found)
        want.append((r[0], *[sum(f[1] == i for f in found) for i in range(3)], hashlib.sha256(joined.encode()).hexdigest(), joined))
    got = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in secret_scan.document_secrets(docs).collect()]
    assert sorted(map(key, got)) == sorted(map(key, want))  # the fixture has base kinds only
    assert secret_scan.document_secrets(empty).count() == 0


def test_trigram_queries():
    assert secret_scan.trigram_query("[0-9a-f]{24,}") == []
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == [{frozenset({"aki", "kia"})}]
    assert frozenset({"tok", "oke", "ken"}) in secret_scan.trigram_query(secret_scan.BASE_RULES[0].pattern)[0]
    assert secret_scan.trigram_query("ab(cd|ef)") == [{frozenset({"abc", "bcd"}), frozenset({"abe", "bef"})}]
    assert secret_scan.trigram_query("(x|abc)+yz.") == []


def quality(t):
    w = words(t)
    places = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 5)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered), failed


def test_quality(docs, rows, empty):
    got = quality_rules.document_quality(docs).collect()
    assert sorted(map(key, [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got])) == \
        sorted(map(key, [(r[0], *quality(r[1])) for r in rows]))
    assert not any(r.kept and r.base_failed for r in got)
    assert all(r.kept == (r.failures & quality_rules.policy_mask(quality_rules.CURRENT_POLICY) == 0) for r in got)
    assert quality_rules.document_quality(empty).count() == 0


def test_quality_stage_and_ablations(docs):
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    table = quality_rules.document_quality(docs)
    assert kept.count() == table.where("kept").count()
    rows = {r.rule: r for r in quality_rules.ablations(table).collect()}
    mask = quality_rules.policy_mask(quality_rules.CURRENT_POLICY)
    failures = [r.failures & mask for r in table.collect()]
    for rule in quality_rules.RULES:
        assert rows[rule.name].failing == sum(bool(f & (1 << rule.bit)) for f in failures)
        assert rows[rule.name].only_this_rule == sum(f == 1 << rule.bit for f in failures)


def licenses(t):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    places = [(i, label) for phrase, label in license_scan.BASE_PHRASES for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_licenses(docs, rows, empty):
    got = license_scan.document_licenses(docs).collect()
    assert sorted(map(key, [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got])) == \
        sorted(map(key, [(r[0], *licenses(r[1])) for r in rows]))
    found = next(r for r in got if r.doc_id == 15)
    assert set(found.labels.split(",")) == {"cc-by", "cc-by-4.0", "gpl", "gpl-3-or-later", "reserved"}
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) for r in got)
    assert license_scan.document_licenses(empty).count() == 0


def test_resolve_keeps_the_stronger():
    assert license_scan.resolve([(0, 4, 70, 1), (1, 3, 40, 2), (3, 6, 40, 3)]) == [(0, 4, 70, 1), (3, 6, 40, 3)]
    assert len(license_scan.SIGNATURES) > 200


def spellings(parsed):
    """Strings that a parsed signature matches: each branch, each optional part with and without, one character of a class and each of a small one."""
    out = [""]
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            part = [chr(arg)]
        elif op == "SUBPATTERN":
            part = spellings(arg[3])
        elif op == "BRANCH":
            part = [x for branch in arg[1] for x in spellings(branch)]
        elif op == "MAX_REPEAT":
            part = ([""] if arg[0] == 0 else []) + spellings(arg[2])
        elif op == "IN":
            part = [chr(a) for kind, a in arg if str(kind) == "LITERAL"] or ["7"]
        else:
            raise ValueError(op)
        out = [a + b for a in out for b in part]
    return out


def test_license_prefilter_loses_nothing():
    rules = [(i, s, re.compile(rf"(?<!\S)(?:{s.pattern})(?!\S)")) for i, s in enumerate(license_scan.SIGNATURES)]
    n = 0
    for i, s, pattern in rules:
        for text in set(spellings(re._parser.parse(s.pattern))):
            assert pattern.fullmatch(text), (s.label, text)
            words = set(text.split())
            assert words & set(s.keywords.split()), (s.label, text)
            n += 1
    assert n > 1000


def test_license_scan_with_and_without_prefilter(spark):
    texts = [x for s in license_scan.SIGNATURES for x in sorted(set(spellings(re._parser.parse(s.pattern))))[:40]]
    texts += ["GPLv3", "GPLv2 only", "LGPLv2.1", "AGPLv3", "gpl3", "Zero-Clause BSD", "gplv2 or gpl 3", "nothing of the kind"]
    want = []
    for k, t in enumerate(texts):
        words = re.findall("[0-9a-z]+", t.lower())
        joined = " ".join(words)
        found = [(joined[:m.start()].count(" "), joined[:m.end()].count(" ") + 1, s.priority, i) for i, s in enumerate(license_scan.SIGNATURES)
                 for m in re.finditer(rf"(?<!\S)(?:{s.pattern})(?!\S)", joined)]
        base = {label for phrase, label in license_scan.BASE_PHRASES if f" {phrase} " in f" {joined} "}
        want.append((k, ",".join(sorted(base | {license_scan.SIGNATURES[i].label for *_, i in license_scan.resolve(found)}))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.document_licenses(docs).collect()}
    assert [(k, got[k].labels) for k, _ in want] == want
    assert [got[len(texts) - j].labels for j in range(8, 2, -1)] == ["gpl-3", "gpl-2-only", "lgpl-2.1", "agpl-3", "gpl-3", "0bsd"]
    assert all(got[len(texts) - j].score > 0 for j in range(8, 1, -1)) and got[len(texts) - 1].score == 0


def test_license_words_end_at_ascii_blanks_alone(spark):
    texts = ["MIT license", "MIT license\u0085", "MIT license\u00a0v", "MIT\u3000license", "the MIT license."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.labels) for r in license_scan.document_licenses(docs).collect()}
    assert [n for _, (n, _) in sorted(got.items())] == [2, 2, 2, 1, 3]
    assert got[0][1] == got[4][1] == "mit" and got[1][1] == got[2][1] == got[3][1] == ""
