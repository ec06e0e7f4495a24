"""Operator 8: document fingerprints as invertible Bloom lookup sketches.

A text becomes a set of paragraph digests: lines, the long ones cut where a word's hash says so,
so that an edit changes only the pieces it touches.  Every digest goes into one cell of each of
three sub-tables; a cell holds a count, the sum of its digests and the sum of their checks.
Subtracting two sketches cell by cell cancels what the texts share; peeling cells that hold one
digest recovers what differs.  Where peeling fails, both sides are sketched again with more cells.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textops as T
from ledgerlens.llm.common import ship_code, text_bytes

#: Cells of the published fingerprint, in three sub-tables; each retry has GROWTH times as many.
CELLS = 24
GROWTH = 4
RETRIES = 12
#: Text in a part of neighbouring documents, about, while there are no more than MAX_PARTS of them.
PART_BYTES = 16 << 20
#: Parts, each a task and one bound of 16 bytes on the driver; beyond it parts grow (2 GB each at 100 TB), whose sort spills and whose rows are read as a stream.
MAX_PARTS = 50_000
#: A word ends a piece when its hash is 0 modulo this (or at the end of a line).
PIECE_WORDS = 4

_U = np.uint64


def piece_digests(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digest, doc) of every paragraph piece; the k-th repeat within a text has a digest of its own."""
    start, end, first = T.word_spans(buf, offsets)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums = T.prefix_sums(buf)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    newlines = np.r_[0, np.cumsum(buf == 10)]
    last = np.ones(len(start), dtype=bool)
    last[:-1] = (newlines[start[1:]] != newlines[end[:-1]]) | (doc[1:] != doc[:-1])
    last |= T.span_hashes(sums, start, end) % _U(PIECE_WORDS) == 0
    ends = np.flatnonzero(last)
    begins = np.r_[0, ends[:-1] + 1]
    h, doc = T.span_hashes(sums, start[begins], end[ends]), doc[ends]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    fresh = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
    at = np.arange(len(h))
    return T.mix(h + (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)), doc


def _cells(h: np.ndarray, row: np.ndarray, m: int, seed: int) -> np.ndarray:
    """The three cells of each digest in a table of ``m`` cells for each row; shape (3, len(h))."""
    third = m // 3
    return np.stack([row * m + j * third + (T.mix(h + _U(1 + j + 3 * seed)) % _U(third)).astype(np.int64) for j in range(3)])


def _check(h: np.ndarray) -> np.ndarray:
    return T.mix(h ^ _U(0x5BF03635DEADBEEF))


class Sketches:
    """Sketches of ``rows`` texts side by side: count, digest sum and check sum of every cell."""

    def __init__(self, rows: int, m: int, seed: int):
        self.m, self.seed = m, seed
        self.count = np.zeros(rows * m, np.int64)
        self.digest = np.zeros(rows * m, np.uint64)
        self.check = np.zeros(rows * m, np.uint64)

    def add(self, h: np.ndarray, row: np.ndarray, sign: np.ndarray | int = 1) -> None:
        sign = np.broadcast_to(np.asarray(sign, np.int64), h.shape)
        factor = sign.astype(np.uint64)  # -1 is 2**64 - 1: sums are modulo 2**64
        for cell in _cells(h, row, self.m, self.seed):
            np.add.at(self.count, cell, sign)
            np.add.at(self.digest, cell, h * factor)
            np.add.at(self.check, cell, _check(h) * factor)

    def subtract(self, other: Sketches) -> None:
        self.count -= other.count
        self.digest -= other.digest
        self.check -= other.check

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows that peeled whole, digests only on the left, only on the right), counts by row."""
        rows = len(self.count) // self.m
        left, right = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        touched = np.flatnonzero(np.abs(self.count) == 1)
        while len(touched):
            sign = self.count[touched]
            ok = np.abs(sign) == 1
            h = self.digest[touched] * sign.astype(np.uint64)
            ok &= _check(h) * sign.astype(np.uint64) == self.check[touched]
            h, sign, row = h[ok], sign[ok], touched[ok] // self.m
            order = np.lexsort((h, row))
            h, sign, row = h[order], sign[order], row[order]
            once = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])] if len(h) else np.zeros(0, bool)
            h, sign, row = h[once], sign[once], row[once]
            left += np.bincount(row[sign > 0], minlength=rows)
            right += np.bincount(row[sign < 0], minlength=rows)
            self.add(h, row, -sign)
            touched = np.unique(_cells(h, row, self.m, self.seed)) if len(h) else h
            if left.sum() + right.sum() > len(self.count):  # more than the cells can hold: not a set of digests
                break
        empty = ((self.count == 0) & (self.digest == 0) & (self.check == 0)).reshape(rows, self.m).all(axis=1)
        return empty, left, right


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], rows: int) -> np.ndarray:
    """|A and B| / |A or B| of each row's digest sets, by subtracting and peeling; 1 for two empty sets."""
    n_a, n_b = np.bincount(a[1], minlength=rows), np.bincount(b[1], minlength=rows)
    out = np.ones(rows)
    open_rows = np.flatnonzero((n_a > 0) | (n_b > 0))
    m = CELLS
    for retry in range(RETRIES):
        if not len(open_rows):
            break
        slot = np.full(rows, -1)
        slot[open_rows] = np.arange(len(open_rows))
        left, right = Sketches(len(open_rows), m, retry), Sketches(len(open_rows), m, retry)
        for side, (h, row) in ((left, a), (right, b)):
            mine = slot[row] >= 0
            side.add(h[mine], slot[row[mine]])
        left.subtract(right)
        done, only_a, only_b = left.peel()
        i = open_rows[done]
        out[i] = (n_a[i] - only_a[done]) / (n_a[i] + only_b[done])
        open_rows = open_rows[~done]
        # twice as many cells as there can be differences always do; the seed changes from there on
        m = min(m * GROWTH, 3 * int(max(8, (n_a + n_b)[open_rows].max(initial=0))))
    for i in open_rows.tolist():  # not met in practice: twelve seeds that all leave a cycle
        x, y = a[0][a[1] == i], b[0][b[1] == i]
        out[i] = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    return out


def fingerprints(pieces: tuple[np.ndarray, np.ndarray], rows: int) -> list[str]:
    """The published sketch of each row: number of pieces, then count, digest and check of each cell."""
    s = Sketches(rows, CELLS, 0)
    s.add(*pieces)
    cells = np.zeros(rows * CELLS, dtype=[("count", "u1"), ("digest", "<u8"), ("check", "<u4")])
    cells["count"], cells["digest"], cells["check"] = s.count & 255, s.digest, s.check & _U(0xFFFFFFFF)
    n = np.bincount(pieces[1], minlength=rows)
    return [base64.b64encode(int(k).to_bytes(4, "little") + c.tobytes()).decode() for k, c in zip(n, cells.reshape(rows, CELLS))]


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(d) for d in data])].astype(np.int64)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare(texts: list[str], following: list[str]) -> tuple[list, ...]:
    """For each text and the one that follows it: n_chars, digest of the edited text, both fingerprints, likenesses."""
    n = len(texts)
    changed = [edited(t, x) for t, x in zip(texts, following)]
    own, new, after = (piece_digests(*_joined(x)) for x in (texts, changed, following))
    return ([len(t) for t in texts], [hashlib.sha256(t.encode()).hexdigest() for t in changed], fingerprints(own, n),
            fingerprints(new, n), likeness(own, new, n).tolist(), likeness(own, after, n).tolist())


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_OUT_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")
_DEALT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("k1", pa.int64()), ("k2", pa.int64()), ("part", pa.int32()), ("ahead", pa.bool_())])


def _rows(ids: list, columns: tuple[list, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, *columns), _OUT)], schema=_OUT)


def part_of(k1: np.ndarray, k2: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The last bound (first keys of the parts, in order) that is not above each key."""
    low = np.searchsorted(bounds["k1"], k1, side="left")
    high = np.searchsorted(bounds["k1"], k1, side="right")
    part = high - 1
    for i in np.flatnonzero(high > low).tolist():  # ids on a bound: the text's hash decides
        part[i] = low[i] + np.searchsorted(bounds["k2"][low[i]:high[i]], k2[i], side="right") - 1
    return part


def _dealer(bounds: np.ndarray):
    """Rows with their part; a part's first row also goes, ahead, to the part before it (the first to the last)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            part = part_of(k1, k2, bounds)
            first = np.flatnonzero((bounds["k1"][part] == k1) & (bounds["k2"][part] == k2))
            for rows, parts, ahead in ((batch, part, False), (batch.take(pa.array(first)), (part[first] - 1) % len(bounds), True)):
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(parts.astype(np.int32)), pa.array([ahead] * len(parts), pa.bool_())], schema=_DEALT)

    return deal


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted parts, one after another: compares each row with the next one of its part."""
    before: tuple | None = None
    for batch in batches:
        for rows, _, _ in T.cut_slices(batch, "text"):
            texts = rows.column("text").fill_null("").to_pylist()
            new = list(zip(rows.column("part").to_pylist(), rows.column("ahead").to_pylist(), rows.column("doc_id").to_pylist(), texts))
            every = [before, *new] if before is not None else new
            pairs = [(x, y) for x, y in zip(every, every[1:]) if x[0] == y[0] and not x[1]]
            if pairs:
                yield _rows([x[2] for x, _ in pairs], compare([x[3] for x, _ in pairs], [y[3] for _, y in pairs]))
            before = every[-1]


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints and likenesses of each row's text, its edited text, and the next document.

    Next is the next row by doc_id (nulls first; equal ids by a hash of the text), after the last
    the first; the edited text has its last floor(n/2) code points replaced by the next document's
    first ones.  Texts are shuffled once, to parts of neighbouring keys that are read in order; only
    the first row of a part is sent to two.  A null text is empty; an empty
    text has no pieces and is like another empty one (1) and unlike any other (0).
    """
    spark = docs.sparkSession
    ship_code(spark)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k1"), F.xxhash64(text).alias("k2"))
    # the keys alone are range-partitioned first: each non-empty range's least key bounds a part
    # (a given number of ranges: left to itself, Spark would merge the short keys into few, and so the texts)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-text_bytes(docs) // PART_BYTES), MAX_PARTS))
    keys = rows.select("k1", "k2").repartitionByRange(n, "k1", "k2").withColumn("range", F.spark_partition_id())
    found = keys.groupBy("range").agg(F.min(F.struct("k1", "k2")).alias("least")).select("least.*").collect()  # one short row a range
    bounds = np.array(sorted((r["k1"], r["k2"]) for r in found), dtype=[("k1", "<i8"), ("k2", "<i8")])
    if not len(bounds):
        return spark.createDataFrame([], _OUT_DDL)
    dealt = rows.mapInArrow(_dealer(bounds), "doc_id long, text string, k1 long, k2 long, part int, ahead boolean")
    ordered = dealt.repartitionById(len(bounds), "part").sortWithinPartitions("part", "ahead", "k1", "k2")
    return ordered.select("doc_id", "text", "part", "ahead").mapInArrow(_chain, _OUT_DDL)
