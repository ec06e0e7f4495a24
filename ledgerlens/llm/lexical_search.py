"""Operator 11: ranked lexical search with bag deduplication.

1. Items are read in blocks of bounded text; a block's distinct terms are its vocabulary.  One pass
   over the whole texts keeps of each document its number of terms and its bag: the (term, tf)
   pairs within the vocabulary, as packed integers.  Terms are found by a 64-bit hash of their bytes
   and then compared byte by byte.
2. The corpus statistics (documents with terms, all terms, documents holding each term) are counted
   over all documents.
3. Documents with the same length factor m and the same bag score alike for every item.  They are
   dealt by a hash of both and compared in full: a class.  Of a class only the k smallest doc_ids
   can be among an item's k best, so each task passes on k of them at most.
4. Classes are scored once, in blocks, all items of the block at a time; a task keeps for each item
   the k best classes by (score, smallest doc_id).  Whatever is not among those has k better
   documents.  The few that are left are expanded to their members and ranked.

Scores are 64-bit integers throughout, so ranks do not depend on how rows are spread.

Defined results: a null text has no terms; documents without terms count in no statistic and are
never returned.  An item without terms, or whose terms no document holds, has no rows.  Each row of
the items is an item, repeated or null ids included.  Repeated documents are documents of their own.
Equal scores go by ascending doc_id, null last.  Empty tables give no rows.  Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import textops as T
from ledgerlens.llm.common import ship_code, stored

#: Documents returned for an item.
TOP = 10
#: Text of the items that are searched together.
ITEM_BLOCK_BYTES = 4 << 20
#: Cells of a block of scores, about.
BLOCK_CELLS = 2 << 20

_in_term = np.zeros(256, dtype=bool)
_in_term[0x30:0x3A] = _in_term[0x41:0x5B] = _in_term[0x61:0x7B] = _in_term[0x80:] = True
_fold = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of one text, in order, as UTF-8."""
    low = (text or "").encode().translate(_fold)
    buf = np.frombuffer(low, dtype=np.uint8)
    start, end, _ = T.word_spans(buf, np.array([0, len(buf)]), _in_term)
    return [low[a:b] for a, b in zip(start.tolist(), end.tolist())]


class Vocabulary:
    """Distinct terms, sorted by hash, with their bytes for the comparison."""

    def __init__(self, terms: set[bytes]):
        words = sorted(terms)
        data, ends = b"".join(words), np.cumsum([len(w) for w in words])
        self.data = np.frombuffer(data, dtype=np.uint8)
        start = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        h = T.span_hashes(T.prefix_sums(self.data), start, ends)
        order = np.argsort(h)
        self.hash, self.start, self.length = h[order], start[order], (ends - start)[order]
        self.number = {words[j]: i for i, j in enumerate(order.tolist())}

    def __len__(self) -> int:
        return len(self.hash)

    def find(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which, term): the spans that are terms, and their numbers."""
        h = T.span_hashes(T.prefix_sums(buf), start, end)
        at = np.minimum(np.searchsorted(self.hash, h), len(self) - 1)
        which = np.flatnonzero((self.hash[at] == h) & (self.length[at] == end - start))
        at, same = at[which], np.zeros(len(which), dtype=bool)
        for n in np.unique(self.length[at]).tolist():  # terms of one length at a time
            of = np.flatnonzero(self.length[at] == n)
            for part in np.array_split(of, 1 + len(of) * n // BLOCK_CELLS):
                step = np.arange(n)
                same[part] = (buf[start[which[part]][:, None] + step] == self.data[self.start[at[part]][:, None] + step]).all(axis=1)
        return which[same], at[same]


def bags(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n, bag) of every document, stored; a bag is pairs of 32-bit (term, tf), by term."""
    ship_code(docs.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, offsets in T.cut_slices(batch, "text"):
                buf = T.lower_ascii(raw)
                start, end, first = T.word_spans(buf, offsets, _in_term)
                which, term = vocabulary.find(buf, start, end)
                doc = np.searchsorted(first, which, side="right") - 1
                pair, tf = np.unique(doc * len(vocabulary) + term, return_counts=True)
                doc, term = np.divmod(pair, len(vocabulary))
                data = np.stack([term, tf], axis=1).astype("<u4")
                ends = 8 * np.searchsorted(doc, np.arange(rows.num_rows + 1))
                bag = pa.Array.from_buffers(pa.binary(), rows.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(first)), bag], ["doc_id", "n", "bag"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(wanted.mapInArrow(read, "doc_id long, n long, bag binary"), "bags")


def term_weights(bag_table: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """(w of each term, N, L); the vocabulary of a block bounds what comes back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            data, _ = _binary(batch.column(0))
            df += np.bincount(data.view("<u4")[::2], minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], ["term", "df"])

    total = bag_table.where("n > 0").agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    n_docs, n_all = total["N"], total["L"] or 0
    w = np.zeros(n_terms, dtype=np.int64)
    for row in bag_table.select("bag").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        w[row["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["df"] + 1)))
    return w, n_docs, n_all


def _binary(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column without nulls."""
    col = col.cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def bag_classes(bag_table: DataFrame, n_docs: int, n_all: int, top: int = TOP) -> DataFrame:
    """(m, bag, ids): documents with equal m and bag are one class; ids are its first ones, ascending."""
    m = F.expr(f"cast(10 + (cast(90 * cast(n as decimal(20,0)) * {n_docs}BD as decimal(38,0)) div {max(n_all, 1)}BD) as long)")
    rows = bag_table.where(F.length("bag") > 0).select("doc_id", m.alias("m"), "bag").withColumn("h", F.xxhash64("m", "bag"))
    key = ["h", "m", "bag"]  # dealt by the hash, equal only where m and bag are
    first = F.row_number().over(Window.partitionBy(*key).orderBy(F.asc_nulls_last("doc_id")))
    ids = F.transform(F.sort_array(F.collect_list(F.struct("rn", "doc_id"))), lambda x: x["doc_id"])  # top of them at most
    return rows.withColumn("rn", first).where(F.col("rn") <= top).groupBy(*key).agg(ids.alias("ids")).select("m", "bag", "ids")


class _Best:
    """The best classes of each item seen by a task: (score, smallest doc_id), ``top`` of them."""

    def __init__(self, n_items: int, top: int):
        self.top, self.floor = top, np.ones(n_items, dtype=np.int64)
        self.item = self.score = self.first = self.last = np.zeros(0, dtype=np.int64)
        self.ids: list = []

    def add(self, scores: np.ndarray, first: np.ndarray, last: np.ndarray, ids: list) -> None:
        """scores: classes x items; last: 1 where the smallest doc_id is null, which sorts last."""
        row, item = np.nonzero(scores >= self.floor)
        if not len(row):
            return
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[row, item[len(self.item):]]])
        first, last = np.concatenate([self.first, first[row]]), np.concatenate([self.last, last[row]])
        order = np.lexsort((first, last, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        keep = order[place < self.top]
        held = len(self.ids)
        self.ids = [self.ids[j] if j < held else ids[row[j - held]] for j in keep.tolist()]
        self.item, self.score, self.first, self.last = item[keep], score[keep], first[keep], last[keep]
        full = order[place == self.top - 1]
        self.floor[item[full]] = np.maximum(1, score[full])


def best_classes(table: DataFrame, items: list[list[int]], w: np.ndarray, top: int = TOP) -> DataFrame:
    """(item, score, ids): the best classes of each item, some for each task."""
    size = np.array([len(x) for x in items])
    owner = np.flatnonzero(size)  # items without terms have no scores
    term = np.concatenate([np.array(x, dtype=np.int64) for x in items if x])
    begin = np.concatenate([[0], np.cumsum(size[owner])[:-1]])
    rows_at_once = max(1, BLOCK_CELLS // max(len(w), len(term)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(owner), top)
        for batch in batches:
            for i in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(i, rows_at_once)
                data, ends = _binary(part.column("bag"))
                pairs = data.view("<u4").astype(np.int64).reshape(-1, 2)
                doc = np.repeat(np.arange(part.num_rows), np.diff(ends) // 8)
                m = part.column("m").to_numpy()[doc]
                parts = np.zeros((part.num_rows, len(w)), dtype=np.int64)
                parts[doc, pairs[:, 0]] = w[pairs[:, 0]] * ((1_000_000_000 * pairs[:, 1]) // (1000 * pairs[:, 1] + 8 * m))
                ids = part.column("ids").to_pylist()
                null = np.array([x[0] is None for x in ids], dtype=np.int64)
                first = np.array([x[0] or 0 for x in ids], dtype=np.int64)
                best.add(np.add.reduceat(parts[:, term], begin, axis=1), first, null, ids)
        yield pa.RecordBatch.from_arrays([pa.array(owner[best.item]), pa.array(best.score), pa.array(best.ids, pa.list_(pa.int64()))],
                                         ["item", "score", "ids"])

    return table.mapInArrow(score, "item long, score long, ids array<long>")


# ---------------------------------------------------------------- items
def item_blocks(items: DataFrame, max_bytes: int = ITEM_BLOCK_BYTES) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """(item_id, distinct terms) of the items, a bounded block at a time; partitions are read one by one."""
    block, size = [], 0
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        block.append((row["item_id"], sorted(set(terms_of(row["text"])))))
        size += sum(map(len, block[-1][1])) + 16
        if size >= max_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def _search(docs: DataFrame, block: list[tuple[int | None, list[bytes]]], top: int) -> DataFrame | None:
    vocabulary = Vocabulary({t for _, terms in block for t in terms} or {b"0"})
    bag_table = bags(docs, vocabulary)
    w, n_docs, n_all = term_weights(bag_table, len(vocabulary))
    numbers = [[vocabulary.number[t] for t in terms] for _, terms in block]
    if not n_docs or not any(numbers):
        return None
    found = best_classes(bag_classes(bag_table, n_docs, n_all, top), numbers, w, top)
    found = found.select("item", "score", F.explode("ids").alias("doc_id"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    names = docs.sparkSession.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], "item long, item_id long")
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # a block of items


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item."""
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items):
        found = _search(docs, block, top)
        out = out if found is None else out.unionByName(found)
    return out
