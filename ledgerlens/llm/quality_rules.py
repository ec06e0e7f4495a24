"""Operator 9: quality rules as a bitmask ledger, in DataFrame functions only.

``ledger`` measures every document once and stores, with the measurements, one failure bit for
each rule.  Policies are versioned sets of rules: a mask.  Applying one, comparing two, or asking
what a policy would keep without one rule (an ablation) is bitwise arithmetic on the ledger; no
text is read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SEPARATOR = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW_WORDS = 5


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``failed`` (SQL over the measurements) is true; ``bit`` never changes."""

    bit: int
    name: str
    failed: str


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "5 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule(4, "upper_case", "10 * n_upper > 4 * word_chars"),
    Rule(5, "exclamations", "5 * n_double_marks > n_words"),
    Rule(6, "long_words", "word_chars > 20 * n_words"),
)
#: Versioned policies: the rules, by name, that reject a document.
POLICIES = {
    1: ("few_words", "repeated_windows"),
    2: ("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    3: tuple(r.name for r in RULES),
}
BASE_POLICY, CURRENT_POLICY = 1, 3

_MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_double_marks"]


def policy_mask(version: int) -> int:
    names = set(POLICIES[version])
    return sum(1 << r.bit for r in RULES if r.name in names)


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once for a row (a lambda's variable, not an expression)."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words covered by a window of five words that the array holds twice or more."""

    def covered(at: Column) -> Column:  # sorted starts of repeated windows
        step = F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW_WORDS)), F.lit(WINDOW_WORDS)))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(pairs: Column) -> Column:  # (hash, start), sorted
        def has_twin(x: Column, i: Column) -> Column:
            before = F.get(pairs, i - 1)["h"].eqNullSafe(x["h"])
            return before | F.get(pairs, i + 1)["h"].eqNullSafe(x["h"])

        return _let(F.sort_array(F.transform(F.filter(pairs, has_twin), lambda x: x["i"])), covered)

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_let(pairs, repeated))

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW_WORDS - 1)),
                          lambda i: F.xxhash64(F.slice(words, i, WINDOW_WORDS)))
    return F.when(F.size(words) > WINDOW_WORDS, _let(windows, count)).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with one struct column ``m`` of all measurements (longs); a null text is empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(SEPARATOR.replace("[", "[^")))
    words = _let(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)),
                 lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    line_counts = _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                                 (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    counted = {"n_symbols": SYMBOL, "n_upper": "[A-Z]", "n_double_marks": "!!"}
    return (docs.withColumn("_w", words).withColumn("_l", line_counts)
            .withColumn("m", F.struct(
                F.col("_w.n_words").alias("n_words"), F.col("_w.n_repeat_words").alias("n_repeat_words"),
                (F.char_length(t) - F.regexp_count(t, F.lit(SEPARATOR))).cast("long").alias("word_chars"),
                F.col("_l.n_lines").alias("n_lines"), F.col("_l.n_dup_lines").alias("n_dup_lines"),
                *[F.regexp_count(t, F.lit(p)).cast("long").alias(k) for k, p in counted.items()]))
            .drop("_w", "_l"))


def ledger(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, the measurements, and ``failures``: bit i set where rule i rejects.

    One row for each row of ``docs``, repeated ids included.  A null, empty or blank text has zero
    words and fails ``few_words``.  The text is measured whole.  Other columns are ignored, so
    none can clash with a measurement.
    """
    flat = measure(docs.select(*carry, F.col(text).alias("_text")), "_text").select(*carry, "m.*")
    bits = [F.when(F.expr(r.failed), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES]
    failures = bits[0]
    for b in bits[1:]:
        failures = failures.bitwiseOR(b)
    return flat.select(*carry, *_MEASURES, failures.cast("long").alias("failures"))


def rejected(version: int, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(policy_mask(version))) != 0


def ablations(table: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """For each rule of a policy: documents that fail it, and those that would be kept without it.

    The ledger is first counted by failure mask (at most one row for each set of bits), so the
    rules are compared on a bounded table.
    """
    masks = table.groupBy(F.col("failures").bitwiseAND(F.lit(policy_mask(version))).alias("mask")).agg(F.count("*").alias("n"))
    names = set(POLICIES[version])
    return masks.agg(*[F.array(F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << r.bit)) != 0, F.col("n"))), F.lit(0)),
                               F.coalesce(F.sum(F.when(F.col("mask") == (1 << r.bit), F.col("n"))), F.lit(0))).alias(r.name)
                       for r in RULES if r.name in names]
                     ).select(F.explode(F.create_map(*[x for r in RULES if r.name in names for x in (F.lit(r.name), F.col(r.name))]))
                              .alias("rule", "v")).select("rule", F.col("v")[0].alias("failing"), F.col("v")[1].alias("only_this_rule"))


def document_quality(docs: DataFrame) -> DataFrame:
    """The ledger with ``base_failed`` (policy 1) and ``kept`` (not rejected by the current policy)."""
    return (ledger(docs).withColumn("base_failed", rejected(BASE_POLICY))
            .withColumn("kept", ~(rejected(BASE_POLICY) | rejected(CURRENT_POLICY))))


def keep_good(docs: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """The rows of ``docs`` that the policy does not reject, with their columns as they are."""
    columns = docs.columns
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in columns]).alias("row"), F.col("text").alias("_text"))
    kept = ledger(row, "_text", carry=("row",)).where(~(rejected(BASE_POLICY) | rejected(version)))
    return kept.select("row.*")
