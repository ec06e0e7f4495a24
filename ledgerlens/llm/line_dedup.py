"""Operator 3: line dedup by a segment-partition edit join, in DataFrame functions only.

A line goes where an earlier line, by document and place, equals it or lies within ``edits``
insertions, deletions or replacements of it.  Two lines that near share one of edits + 1 segments
of the shorter one exactly, at a place that the lengths and the segment's number allow; so every
distinct line is indexed by its segments, probes the lengths up to ``edits`` below its own with
the few substrings that can match, and candidates are verified by a banded bit-parallel edit
distance.  A segment that many lines share (templates with an id in them) is not paired out: its
lines meet by the segment together with two of their rarest grams, of which near lines always
share two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import small, stored

MAX_EDITS = 2
#: Shorter lines are not joined: two edits would join lines that have little in common.
MIN_CHARS = 30
#: A segment's lines are paired with each other up to this number; beyond it they also need two grams in common.
CROWD = 64
#: Characters of a gram of a crowded segment's lines.
GRAM = 3
#: Rare grams that near lines are sure to share, out of edits * GRAM + SHARED.
SHARED = 2


def _segment(i: int, length: Column, edits: int) -> tuple[Column, Column]:
    """(start from 1, length) of segment i of edits + 1; the last ones are one longer where needed."""
    parts = edits + 1
    base, longer = F.floor(length / parts), F.pmod(length, F.lit(parts))
    extra = F.greatest(F.lit(i - 1) - (F.lit(parts) - longer), F.lit(0))
    size = base + F.when(F.lit(i) > F.lit(parts) - longer, 1).otherwise(0)
    return (base * (i - 1) + extra + 1).cast("int"), size.cast("int")


def wide(line: Column) -> Column:
    """Four bytes a character: pieces of it are cut out at their place, without counting through the line."""
    return F.encode(line, "UTF-32")


def _key(line: Column, i: int, length: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(length, F.lit(i), F.substring(line, 4 * start - 3, 4 * size))


def packed_keys(line: Column, length: Column, edits: int = MAX_EDITS) -> Column:
    """Of a line made ``wide``, array<long>: hashes of the line's own segments (lowest bit 1) and of the substrings that probe other lengths (0).

    Lines within ``edits`` share a hash, but for the lowest bit, of which at least one of them is
    the owner: substrings start no further from the segment than edits left of it, and right of
    it, can have moved it.  A substring that does not fit is null.
    """
    keys = []
    for gap in range(edits + 1):  # the other line is shorter by gap
        for i in range(1, edits + 2):
            start, size = _segment(i, length - gap, edits)
            for shift in range(-edits, edits + 1):
                if abs(shift) > i - 1 or abs(shift - gap) > edits + 1 - i:
                    continue
                key = _key(line, i, length - gap, start + shift, size).bitwiseOR(F.lit(1).cast("long"))
                if gap == 0 and shift == 0:
                    keys.append(key)
                else:
                    fits = (start + shift >= 1) & (start + shift + size - 1 <= length)
                    keys.append(F.when(fits, key - 1))
    return F.array(*keys)


def _unpacked(packed: Column) -> tuple[Column, Column]:
    """(key, own) of a packed key."""
    return packed.bitwiseOR(F.lit(1).cast("long")), packed.bitwiseAND(F.lit(1).cast("long")) == 1


def segment_keys(line: Column, length: Column, edits: int = MAX_EDITS) -> Column:
    """array<struct<key, own>>: the packed keys, spelled out."""
    def spelled(x: Column) -> Column:
        key, own = _unpacked(x)
        return F.struct(key.alias("key"), own.alias("own"))

    return F.transform(F.filter(packed_keys(wide(line), length, edits), lambda x: x.isNotNull()), spelled)


_NOT_BLANK = r"[^\x20\x09-\x0D]"


def long_lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """rid, line_no, line, n, h1, h2: every line of MIN_CHARS characters, or not blank with ``short``, with its place and its digest."""
    rows = docs.select("rid", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("n", F.char_length("line"))
    return rows.where(F.col("line").rlike(_NOT_BLANK) if short else F.col("n") >= MIN_CHARS).select("rid", "line_no", "line", "n", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


#: Letters whose counts are compared before texts are: fixed values, frequent in many languages.
SIGNATURE_LETTERS = ("etaonris", "hldcumfp", "gwybvké ")


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def letter_counts(line: Column) -> Column:
    """Counts of the signature letters, eight bits each, modulo 256: a struct of longs."""
    words = []
    for w, letters in enumerate(SIGNATURE_LETTERS):
        out = F.lit(0).cast("long")
        for k, letter in enumerate(letters):
            count = (F.char_length(line) - F.char_length(F.replace(line, F.lit(letter), F.lit("")))).cast("long")
            out = out.bitwiseOR(F.shiftleft(count.bitwiseAND(F.lit(255)), 8 * k))
        words.append(out.alias(f"w{w}"))
    return F.struct(*words)


def letters_apart(a: Column, b: Column) -> Column:
    """Sum of the counts' differences; an edit adds at most two to it."""
    total = F.lit(0).cast("long")
    for w, letters in enumerate(SIGNATURE_LETTERS):
        for k in range(len(letters)):
            x, y = (F.shiftrightunsigned(c[f"w{w}"], 8 * k).bitwiseAND(F.lit(255)) for c in (a, b))
            total = total + F.least(F.abs(x - y), F.lit(256) - F.abs(x - y))
    return total


def edit_distance(a: Column, b: Column, edits: int = MAX_EDITS) -> Column:
    """The edit distance of two lines, or more than ``edits``, from the bits of a diagonal band.

    The band has 2 * edits + 1 rows, one bit each; a step of the fold takes one character of b, and
    additions and shifts on the band's vertical differences do a whole column.  For lines of more
    than ``edits`` characters whose lengths differ by at most ``edits``.
    """
    top = 2 * edits
    mask = F.lit((1 << (top + 1)) - 1)

    def flip(x: Column) -> Column:
        return x.bitwiseXOR(mask)

    def column(left: Column, right: Column) -> Column:
        n = F.size(left)

        def step(acc: Column, i: Column) -> Column:
            match = F.lit(0)
            for k in range(top + 1):
                match = match + F.when(F.get(left, i - edits + k) == F.get(right, i), F.lit(1 << k)).otherwise(F.lit(0))

            def zero(x: Column) -> Column:  # cells whose diagonal difference is zero
                return (x.bitwiseAND(acc["vp"]) + acc["vp"]).bitwiseAND(mask).bitwiseXOR(acc["vp"]).bitwiseOR(x).bitwiseOR(acc["vn"])

            def onward(d0: Column) -> Column:
                hp = acc["vn"].bitwiseOR(flip(d0.bitwiseOR(acc["vp"])))
                hn = d0.bitwiseAND(acc["vp"])
                bit = F.lit(top - 1) - (i - (n - edits))
                at_end = F.get(F.array(*[F.when(hp.bitwiseAND(F.lit(1 << k)) != 0, 1).when(hn.bitwiseAND(F.lit(1 << k)) != 0, -1).otherwise(0)
                                         for k in range(top)]), bit)
                cost = F.when(i < n - edits, F.when(d0.bitwiseAND(F.lit(1 << top)) != 0, 0).otherwise(1)).otherwise(at_end)
                low = F.shiftright(d0, 1)
                return F.struct(hn.bitwiseOR(flip(low.bitwiseOR(hp))).alias("vp"), low.bitwiseAND(hp).alias("vn"),
                                (acc["dist"] + cost).alias("dist"))

            moved = _let(_let(match, zero), onward)
            return F.when(acc["dist"] > 3 * edits, acc).otherwise(moved)  # the end can take back at most 2 * edits

        # the rows of the band that exist before the first column: bits edits .. top
        begin = F.struct(F.lit(((1 << (edits + 1)) - 1) << edits).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("dist"))
        return F.aggregate(F.sequence(F.lit(0), F.size(right) - 1), begin, step, lambda acc: acc["dist"])

    def chars(x: Column) -> Column:
        return F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0))

    return _let(F.struct(chars(a).alias("a"), chars(b).alias("b")), lambda x: column(x["a"], x["b"]))


def _few_grams(n: Column, edits: int) -> Column:
    """Whether a line of n characters has too few grams for its rarest to decide."""
    return n - (GRAM - 1) < edits * GRAM + SHARED


def rare_gram_pairs(lines: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """(h1, pair): hashes of every two of a line's edits * GRAM + SHARED rarest grams.

    lines: h1, line, n, distinct.  The k-th equal gram of a line is an element of its own, and an
    edit touches at most GRAM elements; so of two lines within ``edits`` the larger set lacks at
    most edits * GRAM elements of the other, and taken rarest first (ties by the gram), both
    beginnings hold SHARED common elements, unless both lines have ``_few_grams``.
    """
    place = F.sequence(F.lit(0), F.col("n") - GRAM)
    grams = (lines.where(F.col("n") >= GRAM).select("h1", "n", wide(F.col("line")).alias("wide"))
             .select("h1", F.explode(F.transform(place, lambda i: F.substring(F.col("wide"), 4 * i + 1, F.lit(4 * GRAM)))).alias("gram")))
    times = grams.groupBy("h1", "gram").agg(F.count("*").cast("int").alias("times"))
    elements = stored(times.select("h1", "gram", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("nth")), "line_grams")
    held = stored(elements.groupBy("gram", "nth").agg(F.count("*").alias("held")), "held_grams")
    ranked = elements.join(small(held), ["gram", "nth"]).groupBy("h1").agg(F.sort_array(F.collect_list(F.struct("held", "gram", "nth"))).alias("r"))
    most = edits * GRAM + SHARED
    pairs = [F.when(F.size("r") > j, F.xxhash64(F.get("r", F.lit(i)), F.get("r", F.lit(j)))) for j in range(most) for i in range(j)]
    return ranked.select("h1", F.array(*pairs).alias("pairs")).select("h1", F.explode_outer("pairs").alias("pair")).where("pair is not null")


def near_pairs(lines: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """(a, b): pairs of distinct lines, by their h1, within ``edits`` of each other.

    lines: h1, line, n; repeats are allowed.  Keys are stored and only keys are shuffled; those that one line alone
    has are dropped by a partial aggregation before anything is joined; texts are read again for
    the few lines that share a segment with another.  Lines of a key with more than CROWD of them
    are joined by the key and a pair of rare grams.
    """
    spread = lines.select("h1", "n", wide(F.col("line")).alias("line"))  # once a line, for all of its keys
    # a column of its own, never empty: exploded directly, or not as outer, the array would be evaluated without shared terms, or twice
    spread = spread.select("h1", packed_keys(F.col("line"), F.col("n"), edits).alias("keys"))
    packed = stored(spread.select("h1", F.explode_outer("keys").alias("packed")).where("packed is not null"), "line_keys")
    key, own = _unpacked(F.col("packed"))
    keys = packed.select("h1", key.alias("key"), own.alias("own"))
    shared = stored(keys.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"), F.max("own").alias("owned"))
                    .where("owned and low <> high").select("key"), "shared_keys")
    active = stored(keys.join(small(shared), "key").distinct(), "active")
    ids = stored(active.select("h1").distinct(), "active_ids")
    texts = stored(lines.select("h1", "line", "n").join(small(ids), "h1").groupBy("h1").agg(F.first("line").alias("line"), F.first("n").alias("n"))
                   .withColumn("sig", letter_counts(F.col("line"))), "active_lines")
    crowded = small(stored(active.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > CROWD).select("key"), "crowded_keys"))
    dense = stored(active.join(crowded, "key", "left_semi"), "crowded_lines")
    grams = rare_gram_pairs(texts.join(small(stored(dense.select("h1").distinct(), "crowded_ids")), "h1", "left_semi"), edits)
    met = dense.join(grams, "h1").select("h1", F.xxhash64("key", "pair").alias("key"), "own")

    def pairs_of(keyed: DataFrame) -> DataFrame:
        rows = keyed.join(texts.select("h1", "sig"), "h1")
        near = (F.expr("x.key = y.key and x.h1 <> y.h1 and (not y.own or x.h1 < y.h1)")
                & (letters_apart(F.col("x.sig"), F.col("y.sig")) <= 2 * edits))
        return (rows.where("own").alias("x").join(rows.alias("y"), near)
                .select(F.least("x.h1", "y.h1").alias("a"), F.greatest("x.h1", "y.h1").alias("b")))

    short = texts.where(_few_grams(F.col("n"), edits)).select("h1")
    sparse = active.join(crowded, "key", "left_anti").unionByName(dense.join(short, "h1", "left_semi"))
    pairs = pairs_of(sparse).unionByName(pairs_of(stored(met, "crowded_pairs"))).distinct()
    left = texts.select(F.col("h1").alias("a"), F.col("line").alias("la"), F.col("n").alias("na"))
    right = texts.select(F.col("h1").alias("b"), F.col("line").alias("lb"), F.col("n").alias("nb"))
    both = pairs.join(left, "a").join(right, "b").where(F.abs(F.col("na") - F.col("nb")) <= edits)
    # the fold takes half a millisecond a pair; the compiled distance rejects most pairs before it
    both = both.where(F.levenshtein("la", "lb", edits) >= 0)
    return stored(both.where(edit_distance(F.col("la"), F.col("lb"), edits) <= edits).select("a", "b"), "near_lines")


def removed_lines(docs: DataFrame, edits: int = MAX_EDITS, short: bool = False) -> DataFrame:
    """(doc_id, version, n_lines, removed): the numbers, from 0, of the lines of each document that go.

    A document is a doc_id with a text (``version`` is the text's hash): rows that repeat both are
    one document.  Only documents with a line of MIN_CHARS characters have a row.  With ``short``,
    shorter lines that are not blank are judged as well, by exact equality alone.
    """
    rows = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("version")).alias("rid"),
                       F.coalesce("text", F.lit("")).alias("text"))
    lines = long_lines(rows, short)
    pairs = near_pairs(lines.where(F.col("n") >= MIN_CHARS), edits)
    first = stored(lines.groupBy("h1", "h2").agg(F.min(F.struct("rid", "line_no")).alias("first")).select("h1", "first"), "first_places")
    a, b = first.select(F.col("h1").alias("a"), F.col("first").alias("fa")), first.select(F.col("h1").alias("b"), F.col("first").alias("fb"))
    later = pairs.join(a, "a").join(b, "b").select(F.when(F.col("fa") < F.col("fb"), F.col("b")).otherwise(F.col("a")).alias("h1")).distinct()
    later = small(stored(later.withColumn("near", F.lit(True)), "later_lines"))
    gone = F.col("near").isNotNull() | (F.struct("rid", "line_no") != F.col("first"))
    # two tables meet in this join, so the places of a very common line can be split among tasks
    judged = lines.select("rid", "line_no", "h1").join(first.hint("merge"), "h1").join(later, "h1", "left")
    count = judged.groupBy("rid").agg(F.collect_set("line_no").alias("all"), F.collect_set(F.when(F.col("near").isNotNull(), F.col("line_no"))).alias("near"),
                                      F.sort_array(F.collect_set(F.when(gone, F.col("line_no")))).alias("removed"))  # sets: repeated rows are one
    return count.select("rid.*", F.size("all").alias("n_lines"), F.size("near").alias("n_near"), "removed")


def document_lines(docs: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """doc_id, n_lines (of MIN_CHARS characters or more), n_removed, n_near (no exact twin is needed), removed.

    removed: the numbers of the lines that go, from 0, comma-joined.  One row for each distinct row
    of doc_id and text; documents without a long enough line (a null or empty text has none) have
    zeros and an empty list.  A null doc_id comes before all others.  Lines are split at \\n only
    and compared as they are; equal doc_ids with different texts are ordered by the text's hash.
    """
    found = removed_lines(docs, edits)
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("version")).distinct()
    f = found.select(F.col("doc_id").alias("f_id"), F.col("version").alias("f_version"), "n_lines", "n_near", "removed")
    joined = every.join(f, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("version") == F.col("f_version")), "left")
    return joined.select("doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
                         F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                         F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed"))


def dedup_lines(docs: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """The rows of ``docs`` without the lines that go; n_chars, where there is one, counts anew.

    Lines of any length go where an earlier one equals them, those of MIN_CHARS also where it is
    near: of a copied document nothing is left.  A row that had words and has none left goes as a
    whole.  Untouched rows stay as they are.
    """
    found = stored(removed_lines(docs, edits, short=True).where(F.size("removed") > 0).select("doc_id", "version", "removed"), "removed")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = rows.withColumn("version", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    found = small(found)
    joined = rows.join(found, F.col("row.doc_id").cast("long").eqNullSafe(found["doc_id"]) & (rows["version"] == found["version"]), "left")

    def kept(lines: Column) -> Column:
        index = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
        return F.array_join(F.transform(index, lambda i: F.get(lines, i)), "\n")

    shorter = joined.select("row", F.when(F.col("removed").isNotNull(), _let(F.split("row.text", "\n"), kept)).alias("left"))
    shorter = shorter.where(F.col("left").isNull() | F.col("left").rlike(_NOT_BLANK))
    changed = F.col("row").withField("text", F.col("left"))
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.char_length("left").cast(docs.schema["n_chars"].dataType))
    return shorter.select(F.when(F.col("left").isNull(), F.col("row")).otherwise(changed).alias("row")).select("row.*")
