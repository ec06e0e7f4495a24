"""DuckDB twins of the registered operator queries, where SQL can express the whole result.

Mixing (seeded draws), BPE, byte repeats, MinHash passages, sketches and license signatures are
held to brute-force versions in ``tests/llm`` instead.
"""

from __future__ import annotations

from ledgerlens.llm import lexical_search, line_dedup, quality_rules, secret_scan, spelling_variants

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# 2: every pair of documents that shares a shingle is counted; links are closed recursively
_NGRAM = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_LOWER} AS t FROM documents),
w AS (SELECT r, unnest({_WORDS}) AS x, generate_subscripts({_WORDS}, 1) AS i FROM d),
n AS (SELECT r, count(*) AS n FROM w GROUP BY r),
g AS (SELECT r, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS s
      FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
sh AS (SELECT DISTINCT r, s FROM g WHERE s IS NOT NULL
       UNION ALL SELECT r, string_agg(x, ' ' ORDER BY i) FROM w JOIN n USING (r) WHERE n.n < 5 GROUP BY r),
sz AS (SELECT r, count(*) AS c FROM sh GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN sz x ON x.r = a JOIN sz y ON y.r = b WHERE 100 * common.c >= 75 * (x.c + y.c - common.c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT d.doc_id, coalesce(sz.c, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN sz USING (r) JOIN (SELECT a, min(e.doc_id) AS component_id FROM reach JOIN d e ON e.r = reach.b GROUP BY a) m ON m.a = d.r
"""

# 3: every pair of distinct lines of nearly the same length is compared
_LINES = rf"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, t, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS i FROM d),
p AS (SELECT * FROM l WHERE length(x) >= {line_dedup.MIN_CHARS}),
u AS (SELECT x, min({{'d': doc_id, 'i': i}}) AS f FROM p GROUP BY x),
nr AS (SELECT DISTINCT CASE WHEN a.f < b.f THEN b.x ELSE a.x END AS x FROM u a JOIN u b
       ON a.x < b.x AND abs(length(a.x) - length(b.x)) <= {line_dedup.MAX_EDITS} AND levenshtein(a.x, b.x) <= {line_dedup.MAX_EDITS}),
v AS (SELECT p.doc_id, p.t, p.i, nr.x IS NOT NULL AS near, nr.x IS NOT NULL OR {{'d': p.doc_id, 'i': p.i}} <> u.f AS gone
      FROM p JOIN u USING (x) LEFT JOIN nr USING (x)),
s AS (SELECT doc_id, t, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (near) AS n_near,
             string_agg(i::VARCHAR, ',' ORDER BY i) FILTER (gone) AS removed FROM v GROUP BY doc_id, t)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_near, 0) AS n_near, coalesce(removed, '') AS removed
FROM d LEFT JOIN s ON s.doc_id IS NOT DISTINCT FROM d.doc_id AND s.t = d.t
"""


def _secrets() -> str:
    """6: matches by expression, their places from the pieces between them."""
    kinds, none = [], "[]::STRUCT(s BIGINT, k INTEGER, e BIGINT)[]"
    for k, rule in enumerate(secret_scan.RULES):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        value = f"regexp_extract_all(t, {pattern}, {rule.group})"
        kinds.append(f"""
        SELECT r, unnest(range(1, len(m) + 1)) AS j, {k} AS k, m, v, p FROM
          (SELECT r, regexp_extract_all(t, {pattern}) AS m, {value} AS v, string_split_regex(t, {pattern}) AS p FROM d)
        """)
    names = "[" + ", ".join(f"'{r.kind}'" for r in secret_scan.RULES) + "]"
    least = "[" + ", ".join(str(r.least) for r in secret_scan.RULES) + "]"
    n_base = len(secret_scan.BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (k = {i}) AS n_{r.kind}" for i, r in enumerate(secret_scan.BASE_RULES))
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    f AS ({' UNION ALL '.join(kinds)}),
    q AS (SELECT r, k, length(m[j]) AS n, coalesce(list_sum([length(x) for x in p[1:j]]), 0) + coalesce(list_sum([length(x) for x in m[1:j - 1]]), 0) AS s
          FROM f WHERE length(v[j]) >= ({least})[k + 1]),
    a AS (SELECT r, {counts}, string_agg(({names})[k + 1] || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, k) AS spans,
                 string_agg(({names})[k + 1] || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, k) FILTER (k < {n_base}) AS base FROM q GROUP BY r)
    SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in secret_scan.BASE_RULES)},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (r)
    """


def _quality() -> str:
    """9: windows counted by their words, covered words from the distance to the next repeated window."""
    bits = " + ".join(f"CASE WHEN {r.failed} THEN {1 << r.bit} ELSE 0 END" for r in quality_rules.RULES)
    base, now = quality_rules.policy_mask(quality_rules.BASE_POLICY), quality_rules.policy_mask(quality_rules.CURRENT_POLICY)
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT r, unnest({_WORDS}) AS x, generate_subscripts({_WORDS}, 1) AS i FROM d),
    g AS (SELECT r, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS s
          FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
    c AS (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM g WHERE s IS NOT NULL),
    p AS (SELECT r, least(5, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS k FROM c WHERE c > 1),
    n AS (SELECT r, sum(k)::BIGINT AS n_repeat_words FROM p GROUP BY r),
    q AS (SELECT r, doc_id, len({_WORDS})::BIGINT AS n_words, length(t) - len(regexp_extract_all(t, '[\x20\x09-\x0D]')) AS word_chars,
                 len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                 [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
                 len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_upper, len(regexp_extract_all(t, '!!'))::BIGINT AS n_double_marks FROM d),
    m AS (SELECT q.*, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words FROM q LEFT JOIN n USING (r)),
    b AS (SELECT *, ({bits})::BIGINT AS failures FROM m)
    SELECT doc_id, {', '.join(quality_rules._MEASURES)}, failures, (failures & {base}) <> 0 AS base_failed,
           (failures & {base | now}) = 0 AS kept FROM b
    """


# 11: every document is scored for every item that shares a term with it
_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_RANKED = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format(_LOWER)} AS ts FROM documents),
s AS (SELECT count(*) FILTER (len(ts) > 0) AS N, sum(len(ts))::BIGINT AS L FROM d),
tf AS (SELECT r, x, count(*) AS tf FROM (SELECT r, unnest(ts) AS x FROM d) GROUP BY ALL),
w AS (SELECT x, floor(1000 * ln((2 * (SELECT N FROM s) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf GROUP BY x),
m AS (SELECT r, doc_id, 10 + (90 * len(ts) * (SELECT N FROM s)) // (SELECT L FROM s) AS m FROM d WHERE len(ts) > 0),
q AS (SELECT k, item_id, unnest(list_distinct({_TERMS.format(_LOWER)})) AS x FROM (SELECT row_number() OVER () AS k, * FROM benchmark)),
p AS (SELECT k, item_id, m.r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN tf USING (x) JOIN w USING (x) JOIN m ON m.r = tf.r GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM p WHERE score > 0)
WHERE rank <= {lexical_search.TOP}
"""

# 12: near words meet in what is left after one deletion at one place; crc32 by its table, made by the usual rule
_SPELLING = rf"""
WITH RECURSIVE c0(i, k, c) AS (SELECT i, 0, i::BIGINT FROM range(256) t(i)
                     UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM c0 WHERE k < 8),
ct AS (SELECT list(c ORDER BY i) AS c FROM c0 WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]+')) AS x FROM documents),
g AS (SELECT doc_id, x, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || x)) AS b FROM runs
      WHERE length(x) >= {spelling_variants.MIN_CHARS} GROUP BY doc_id, x),
h AS (SELECT x, n, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || substr(b, 2 * j + 1, 2))::BIGINT for j in range(length(b) // 2)]),
             lambda a, e: xor(a >> 8, c[(xor(a, e) & 255) + 1])), 4294967295) AS h FROM g, ct),
y AS (SELECT CASE WHEN h % {spelling_variants.DELETE_EACH} = 0 THEN substr(x, 1, (h % length(x))::BIGINT) || substr(x, (h % length(x))::BIGINT + 2) ELSE x END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM y WHERE length(word) >= {spelling_variants.MIN_CHARS} GROUP BY word HAVING sum(n) >= {spelling_variants.MIN_COUNT}),
v AS (SELECT word, n, j, substr(word, 1, j - 1) || substr(word, j + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS j FROM w)),
e0 AS (SELECT a.word AS a, a.n AS na, b.word AS b, b.n AS nb FROM v a JOIN v b ON a.j = b.j AND a.less = b.less AND a.word <> b.word
       UNION SELECT w.word, w.n, v.word, v.n FROM w JOIN v ON v.less = w.word
       UNION SELECT v.word, v.n, w.word, w.n FROM w JOIN v ON v.less = w.word),
f AS (SELECT a AS word, count(*) AS n_near, min({{'n': -nb, 'w': encode(b)}}) AS best FROM e0 GROUP BY a),
k AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= {spelling_variants.FORM_FACTOR} * w.n THEN decode(best.w) END AS form,
             CASE WHEN -best.n >= {spelling_variants.FORM_FACTOR} * w.n THEN -best.n END AS form_n FROM w LEFT JOIN f USING (word)),
t(word, root, next) AS (SELECT word, word, form FROM k UNION ALL SELECT t.word, k.word, k.form FROM t JOIN k ON k.word = t.next)
SELECT k.word, k.form, t.root, k.n, k.n_near, k.form_n FROM k JOIN t ON t.word = k.word AND t.next IS NULL
"""

_COPIES = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, r DESC) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_jaccard_join": _NGRAM,
        "op3_line_dedup": _LINES,
        "op6_secret_scan": _secrets(),
        "op9_quality_rules": _quality(),
        "op11_ranked_search": _RANKED,
        "op12_spelling_variants": _SPELLING,
        "op13_exact_dedup": _COPIES,
    }
