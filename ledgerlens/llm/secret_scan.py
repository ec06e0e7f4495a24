"""Operator 6: secret scans through a trigram inverted index, in DataFrame functions only.

From every rule's regular expression a Boolean trigram query is derived: what any match must
contain, as groups (all needed) of alternatives (one needed) of trigrams (all needed).  The
documents are indexed on the trigrams that the queries name: one posting (trigram, document) each.
Postings are intersected by counting, and the rules' expressions run only on their candidates;
a rule without a mandatory trigram runs on every document.  Positions come from splitting a text
at the matches: a match starts after the pieces and matches before it.
"""

from __future__ import annotations

import itertools
import re._constants as rc
import re._parser as rp
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored


@dataclass(frozen=True)
class SecretRule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` is shorter are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# fixed values: the base kinds, in the order in which equal starts are listed
BASE_RULES = (
    SecretRule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}"),  # maximal runs, so the length can stand in the expression
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("google", r"AIza[0-9A-Za-z_-]{35}"),
    SecretRule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("pem", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    SecretRule("url", r"[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/@]{3,64}@"),
)
RULES = BASE_RULES + MORE_RULES

#: Strings that are followed side by side while a query is derived; beyond it the query gets weaker, not wrong.
MAX_STRINGS = 64


def trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _weakest(alternatives: set[frozenset[str]]) -> set[frozenset[str]]:
    """Without alternatives that ask for more than another one does."""
    return {a for a in alternatives if not any(b < a for b in alternatives)}


def trigram_query(pattern: str) -> list[set[frozenset[str]]]:
    """Groups of alternatives of trigrams of the lower-cased match; an empty list asks for nothing."""
    groups: list[set[frozenset[str]]] = []

    def flush(strings: set[str]) -> set[str]:
        alternatives = {trigrams(s) for s in strings}
        if all(alternatives) and alternatives:
            groups.append(_weakest(alternatives))
        return {""}

    def spelled(item) -> set[str] | None:
        """All strings that the item matches, lower-cased, if they are few."""
        op, arg = item
        if op is rc.LITERAL:
            return {chr(arg).lower()} if arg < 128 else None
        if op is rc.IN:
            out: set[str] = set()
            for kind, value in arg:
                if kind is rc.LITERAL and value < 128:
                    out.add(chr(value).lower())
                elif kind is rc.RANGE and value[1] - value[0] < 4 and value[1] < 128:
                    out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
                else:
                    return None
            return out if len(out) <= 8 else None
        if op is rc.SUBPATTERN:
            return spelled_all(arg[3])
        if op is rc.BRANCH:
            parts = [spelled_all(x) for x in arg[1]]
            return None if any(p is None for p in parts) else set().union(*parts)
        if op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[1] <= 3:
            one = spelled_all(arg[2])
            return None if one is None else {"".join(x) for n in range(arg[0], arg[1] + 1) for x in itertools.product(one, repeat=n)}
        return None

    def spelled_all(items) -> set[str] | None:
        out = {""}
        for item in items:
            one = spelled(item)
            if one is None or len(out) * len(one) > MAX_STRINGS:
                return None
            out = {a + b for a in out for b in one}
        return out

    now = {""}
    for item in rp.parse(pattern):
        one = spelled(item)
        if one is None:
            now = flush(now)
        elif len(now) * len(one) > MAX_STRINGS:
            flush(now)
            now = one
        else:
            now = {a + b for a in now for b in one}
    flush(now)
    return groups


def _key(doc_id: str) -> Column:
    """Rows that share an id share candidates, which verification sorts out; null counts as an id."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(-1).cast("long"))


def trigram_index(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Postings (trigram, key): one for each trigram of the vocabulary in a document's lower-cased text."""
    low = F.lower(F.coalesce("text", F.lit("")))
    found = docs.select(_key("doc_id").alias("key"), low.alias("low")).select(
        "key", F.array_compact(F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in vocabulary])).alias("found"))
    return found.select("key", F.explode("found").alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[SecretRule, ...]) -> DataFrame:
    """(key, rules): the bits of the indexed rules whose trigram query the document satisfies."""
    spark = docs.sparkSession
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    vocabulary = sorted({t for q in queries.values() for g in q for a in g for t in a})
    postings = stored(trigram_index(docs, vocabulary), "postings")
    wanted = [(t, i, g, a, len(alt)) for i, q in queries.items() for g, group in enumerate(q)
              for a, alt in enumerate(sorted(group, key=sorted)) for t in sorted(alt)]
    # a few rows for each rule: its size is that of the rule list
    terms = spark.createDataFrame(wanted, "trigram string, rule int, grp int, alt int, terms long")
    size = F.create_map(*[F.lit(x) for i, q in queries.items() for x in (i, len(q))])
    hits = (postings.distinct().join(F.broadcast(terms), "trigram").groupBy("key", "rule", "grp", "alt", "terms")
            .agg(F.count("*").alias("n")).where("n = terms"))
    return (hits.groupBy("key", "rule").agg(F.countDistinct("grp").alias("n")).where(F.col("n") == size[F.col("rule")])
            .groupBy("key").agg(F.expr("bit_or(shiftleft(1L, rule))").alias("rules")))


def _spans(text: Column, rule: SecretRule, number: int) -> Column:
    """array<struct<start, rule, end>> of the rule's matches, in code points."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.arrays_zip(F.split(text, rule.pattern, -1).alias("piece"), matches.alias("match"),
                         (F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches).alias("value"))
    none = F.array().cast("array<struct<start:int,rule:int,end:int,value:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["piece"])
        end = start + F.char_length(x["match"])
        span = F.struct(start.alias("start"), F.lit(number).alias("rule"), end.alias("end"), F.char_length(x["value"]).alias("value"))
        return F.struct(F.coalesce(end, acc["at"]).alias("at"),
                        F.when(x["match"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span))).alias("spans"))

    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(text.rlike(rule.pattern), F.filter(found, lambda s: s["value"] >= rule.least)).otherwise(none)


def scan(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """doc_id and ``found``: array of (start, rule, end, value length), by start, then rule; ends exclusive.

    One row for each row of ``docs``; a null text is empty and has no spans.  Texts are searched
    whole, positions are code points, and rules may overlap one another.  Other columns are ignored.
    """
    indexed = [bool(trigram_query(r.pattern)) for r in rules]
    masks = candidates(docs, rules)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"), _key("doc_id").alias("key"))
    rows = rows.join(masks, "key", "left")
    per_rule = []
    for i, rule in enumerate(rules):
        spans = _spans(F.col("_text"), rule, i)
        if indexed[i]:
            none = F.array().cast("array<struct<start:int,rule:int,end:int,value:int>>")
            spans = F.when(F.col("rules").bitwiseAND(F.lit(1 << i)) != 0, spans).otherwise(none)
        per_rule.append(spans)
    return rows.select("doc_id", F.sort_array(F.flatten(F.array(*per_rule))).alias("found"))


def document_secrets(docs: DataFrame) -> DataFrame:
    """The counts of the base kinds, the digest of their spans, and all spans as kind:start:end."""
    n_base = len(BASE_RULES)
    kinds = F.array(*[F.lit(r.kind) for r in RULES])

    def joined(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")

    def of(i: int) -> Column:
        return F.filter(found, lambda s: s["rule"] == i)

    found = F.col("found")
    return scan(docs).select(
        "doc_id", *[F.size(of(i)).cast("long").alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)],
        F.sha2(joined(F.filter(found, lambda s: s["rule"] < n_base)), 256).alias("base_sha256"), joined(found).alias("spans"))
