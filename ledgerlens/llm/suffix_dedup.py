"""Operator 5: suffix-array dedup of byte strings of LENGTH or more that occur twice.

1. *Anchors.*  Of the K-byte strings in a window of LENGTH bytes the one with the least hash is the
   window's anchor, so equal windows have equal anchors at equal places.  Slices of documents send
   their anchors' hashes to hash buckets, which answer whether another place has them as well.
2. *Suffix arrays.*  Shared anchors are sent again, with the bytes of all their windows, to buckets
   by hash: all copies of a window meet in one bucket.  A bucket sorts suffixes of these
   surroundings and keeps the common prefixes of neighbours: an enhanced suffix array.  Its tree of
   intervals with a common prefix of LENGTH or more is scanned with a stack.  Intervals whose
   suffixes differ in the byte before them, or reach the left end of the surroundings, are the
   maximal repeats there, with all occurrences; every occurrence but the first goes.  Any string of
   LENGTH that occurs twice lies at one place within such a repeat that has the same occurrences.
3. *Cutting.*  The slices get the byte ranges back and unite them.

``maximal_repeats`` goes beyond the surroundings: from the runs whose occurrences have different
bytes before them it follows the text onwards, in rounds, and scans the tree of what they have in
common in the same way: maximal repeats in full length, with all occurrences.

Equal surroundings of an anchor within a slice are sent once.  Anchors in more than HOT places
don't gather their surroundings in one bucket: their windows go to buckets one by one, by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textops as T
from ledgerlens.llm.common import bucket_count, ship_code, small, stored, text_bytes

LENGTH = 100
K = 32
SLICE_BYTES = 1 << 20
#: Text behind a bucket, about; anchors and their surroundings are a fraction of it.
BUCKET_BYTES = 2 << 20
HOT = 20_000
#: Bytes of text that a round of ``maximal_repeats`` follows; four times more in the next, up to the last.
FOLLOWED, MOST_FOLLOWED = 1 << 8, 1 << 14
_POS_BITS = 28

_SLICES = pa.schema([("slice", pa.int64()), ("facts", pa.binary()), ("bytes", pa.binary())])
_ANCHORS = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), ("hashes", pa.binary())])
_FLAGS = pa.schema([("slice", pa.int64()), ("bucket", pa.int32()), ("flags", pa.binary())])
_WINDOWS = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), ("kind", pa.int32()), ("docs", pa.binary()), ("items", pa.binary()),
                      ("bytes", pa.binary())])
_RANGES = pa.schema([("slice", pa.int64()), ("ranges", pa.binary())])
_PLACES = pa.schema([("node", pa.binary()), ("length", pa.int64()), ("slice", pa.int64()), ("doc", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()),
                     ("before", pa.int32()), ("open", pa.bool_())])
_TEXTS = pa.schema([*[f for f in _PLACES if f.name != "open"], ("text", pa.binary())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
_DDL = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string", pa.bool_(): "boolean"}

_FACT = np.dtype([("doc_id", "<i8"), ("null", "<i8"), ("length", "<i8")])
_DOC = np.dtype([("order", "<i8"), ("rid", "<i8")])  # a null id comes before all others
_CONTEXT = np.dtype([("doc", "<u2"), ("windows", "<u2"), ("start", "<u4"), ("before", "<i2")])  # before: the byte before it, or -1
_HASHED = np.dtype([("hash", "<u8"), ("doc", "<u2"), ("start", "<u4")])
_RANGE = np.dtype([("doc", "<u2"), ("start", "<u4"), ("end", "<u4")])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {_DDL[f.type]}" for f in schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def _slice_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, press = TaskContext.get().partitionId() << 24, zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for rows, buf, offsets in T.cut_slices(batch, "text", SLICE_BYTES):
            at += 1
            facts = np.zeros(rows.num_rows, _FACT)
            ids = rows.column("doc_id")
            facts["doc_id"], facts["null"] = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            facts["length"] = np.diff(offsets)
            yield _batch([(at, facts.tobytes(), press.compress(buf.tobytes()))], _SLICES)


def _open(facts: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    facts = np.frombuffer(facts, _FACT)
    return facts, np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), np.r_[0, np.cumsum(facts["length"])]


def sliding_least(v: np.ndarray, w: int) -> np.ndarray:
    """The least of v[i:i + w] for each i, from the running minima of blocks of w, forwards and backwards."""
    n = len(v)
    blocks = np.full(-(-n // w) * w, np.iinfo(v.dtype).max, v.dtype)
    blocks[:n] = v
    blocks = blocks.reshape(-1, w)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    np.minimum.accumulate(blocks[:, ::-1], axis=1, out=blocks[:, ::-1])  # the blocks themselves, backwards
    return np.minimum(blocks.reshape(-1)[:n - w + 1], forward[w - 1:n])


def anchors(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, windows, doc) of every anchor, by first window; windows of one anchor are neighbours."""
    none = np.zeros(0, np.int64)
    if len(buf) < LENGTH:
        return none.astype(np.uint64), none, none, none
    sums = T.prefix_sums(buf)
    h = T.mix((sums[K:] - sums[:-K]) * T._inverse_powers(len(sums))[:len(sums) - K])
    del sums
    at = np.uint64((1 << _POS_BITS) - 1)
    out = []
    for piece in range(0, len(h), 1 << (_POS_BITS - 1)):  # places of a very long document are numbered in pieces
        end = min(len(h), piece + (1 << (_POS_BITS - 1)) + LENGTH - K)
        if end - piece >= LENGTH - K + 1:
            v = (h[piece:end] & ~at) | np.arange(end - piece, dtype=np.uint64)
            out.append((sliding_least(v, LENGTH - K + 1) & at).astype(np.int64) + piece)
    place = np.concatenate(out) if out else none
    place = place[:len(buf) - LENGTH + 1]
    window = np.arange(len(place))
    doc = np.searchsorted(offsets, window, side="right") - 1
    inside = window + LENGTH <= offsets[doc + 1]
    place, window, doc = place[inside], window[inside], doc[inside]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]) if len(place) else none
    return h[place[first]], window[first], np.diff(np.r_[first, len(place)]), doc[first]


def _by_bucket(h: np.ndarray, n_buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(order, [(bucket, from, to)]): the hashes dealt to buckets, order kept within.

    They are mixed first: an anchor's hash is the least of many, so its upper bits are mostly zero.
    """
    bucket = ((T.mix(h ^ np.uint64(0x6A09E667F3BCC909)) >> np.uint64(40)) * np.uint64(n_buckets) >> np.uint64(24)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    return order, [(int(bucket[i]), int(i), int(j)) for i, j in zip(cuts, np.r_[cuts[1:], len(bucket)])]


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one by one: a slice's bytes are copied when it is their turn."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _send_anchors(n_buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _each(batch):
                _, buf, offsets = _open(row["facts"], row["bytes"])
                h = anchors(buf, offsets)[0]
                order, runs = _by_bucket(h, n_buckets)
                low = h[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                yield _batch([(b, row["slice"], low[i:j].tobytes()) for b, i, j in runs], _ANCHORS)

    return send


def _count_anchors(hot: int):
    """One bucket: for each slice's anchors 0 (nowhere else), 1 (elsewhere too) or 2 (in more than ``hot`` places)."""

    def count(table: pa.Table) -> pa.Table:
        parts = []
        for b in table.column("hashes").to_pylist():
            wide = np.zeros((len(b) // 6, 8), np.uint8)
            wide[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
            parts.append(wide.reshape(-1).view("<u8"))
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        flag = (counts > 1).astype(np.uint8) + (counts > hot)
        out = [flag[np.searchsorted(values, p)].tobytes() for p in parts]
        return pa.Table.from_arrays([table.column("slice").combine_chunks(), table.column("bucket").combine_chunks(), pa.array(out, pa.binary())], schema=_FLAGS)

    return count


def _unite(doc: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of the byte ranges that the places cover, neighbours united."""
    if not len(doc):
        none = np.zeros(0, np.int64)
        return none, none, none
    at = doc.astype(np.int64) << 32 | start.astype(np.int64)
    end = at + length
    order = np.argsort(at)
    at, reach = at[order], np.maximum.accumulate(end[order])
    edge = np.flatnonzero(np.r_[True, at[1:] > reach[:-1]])
    low = (1 << 32) - 1
    return at[edge] >> 32, at[edge] & low, reach[np.r_[edge[1:], len(at)] - 1] & low


def _ranges(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Byte ranges that the windows cover, neighbours united."""
    doc, start, end = _unite(doc, start, LENGTH)
    out = np.zeros(len(doc), _RANGE)
    out["doc"], out["start"], out["end"] = doc, start, end
    return out


def _expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(item, first[item] + 0 .. count[item] - 1) for all items."""
    item = np.repeat(np.arange(len(count)), count)
    return item, first[item] + np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)


def _send_windows(n_buckets: int, every: bool = False):
    """One slice with its flags: the surroundings of shared anchors (kind 0), the windows of hot ones (1), local repeats (2).

    With ``every``, equal surroundings are sent each, and no repeat is local.
    """

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for row in left.to_pylist():
            facts, buf, offsets = _open(row["facts"], row["bytes"])
            h, first, windows, doc = anchors(buf, offsets)
            order, runs = _by_bucket(h, n_buckets)
            answers = dict(zip(right.column("bucket").to_pylist(), right.column("flags").to_pylist()))
            flag = np.zeros(len(h), np.uint8)
            for b, i, j in runs:
                flag[order[i:j]] = np.frombuffer(answers[b], np.uint8)
            docs = np.zeros(len(facts), _DOC)
            docs["order"] = np.where(facts["null"] != 0, np.iinfo(np.int64).min, facts["doc_id"])
            docs["rid"] = (row["slice"] << 16) + np.arange(len(facts))
            rank = np.empty(len(facts), np.int64)
            rank[np.lexsort((docs["rid"], docs["order"]))] = np.arange(len(facts))
            sums = T.prefix_sums(buf)
            press = zstandard.ZstdCompressor(level=3)
            local: list[np.ndarray] = []

            def earliest(key: np.ndarray, at: np.ndarray) -> np.ndarray:
                """Whether an item is the first of its key in the slice, by document and place."""
                o = np.lexsort((at, rank[np.searchsorted(offsets, at, side="right") - 1], key))
                is_first = np.zeros(len(key), bool)
                is_first[o[np.r_[True, key[o][1:] != key[o][:-1]]]] = True
                return is_first

            shared = np.flatnonzero(flag == 1)
            if len(shared):
                begin, end = first[shared], first[shared] + windows[shared] + LENGTH - 1
                new = np.ones(len(shared), bool) if every else earliest(T.span_hashes(sums, begin, end), begin)
                copies = shared[~new]
                item, start = _expand(first[copies], windows[copies])
                local.append(_ranges(doc[copies][item], start - offsets[doc[copies]][item]))
                shared = shared[new]
                o, runs = _by_bucket(h[shared], n_buckets)
                shared = shared[o]
                context = np.zeros(len(shared), _CONTEXT)
                context["doc"], context["windows"], context["start"] = doc[shared], windows[shared], first[shared] - offsets[doc[shared]]
                context["before"] = np.where(context["start"] > 0, buf[np.maximum(first[shared] - 1, 0)].astype(np.int16), -1)
                size = windows[shared] + LENGTH - 1
                for b, i, j in runs:
                    used, context["doc"][i:j] = np.unique(context["doc"][i:j], return_inverse=True)
                    data = buf[_expand(first[shared][i:j], size[i:j])[1]].tobytes()
                    out.append((b, row["slice"], 0, docs[used].tobytes(), context[i:j].tobytes(), press.compress(data)))
            hot = np.flatnonzero(flag == 2)
            if len(hot):
                item, start = _expand(first[hot], windows[hot])
                key, d = T.span_hashes(sums, start, start + LENGTH), doc[hot][item]
                new = earliest(key, start)
                local.append(_ranges(d[~new], start[~new] - offsets[d[~new]]))
                key, start, d = key[new], start[new], d[new]
                o, runs = _by_bucket(key, n_buckets)
                hashed = np.zeros(len(o), _HASHED)
                hashed["hash"], hashed["doc"], hashed["start"] = key[o], d[o], (start - offsets[d])[o]
                for b, i, j in runs:
                    used, hashed["doc"][i:j] = np.unique(hashed["doc"][i:j], return_inverse=True)
                    out.append((b, row["slice"], 1, docs[used].tobytes(), hashed[i:j].tobytes(), None))
            if ranges := [r for r in local if len(r)]:
                out.append((row["slice"] * 2654435761 % n_buckets, row["slice"], 2, None, np.concatenate(ranges).tobytes(), None))
        return pa.Table.from_batches([_batch(out, _WINDOWS)])

    return send


class SuffixArray:
    """An enhanced suffix array of a bucket's surroundings: suffixes in order, with common prefixes of neighbours.

    A suffix reaches to the end of its surroundings.  Those take part that start a window with twins
    of which one stands at the left end of its surroundings, or two have different bytes before
    them; of every other window the one before it has the same occurrences.

    place, doc, start, length: of every suffix.  common: with the next suffix.  order: document and
    start in one number.  before: the byte before it, -1 at the start of a document; left: -1 also
    at the left end of the surroundings.
    """

    def __init__(self, rows: list[dict]):
        unpack = zstandard.ZstdDecompressor()
        contexts = [np.frombuffer(r["items"], _CONTEXT) for r in rows]
        data = b"".join(unpack.decompress(r["bytes"]) for r in rows)
        self.buf = np.frombuffer(data, np.uint8)
        base, rank = _places_of(rows)
        context = np.concatenate(contexts)
        windows = context["windows"].astype(np.int64)
        size = windows + LENGTH - 1
        begin = np.cumsum(size) - size
        item, place = _expand(begin, windows)
        h = T.span_hashes(T.prefix_sums(self.buf), place, place + LENGTH)
        left = self.buf[np.maximum(place - 1, 0)].astype(np.int16)
        left[np.cumsum(windows) - windows] = -1
        order = np.argsort(h)
        h, twins = h[order], left[order]
        cuts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        count = np.diff(np.r_[cuts, len(h)])
        least = np.minimum.reduceat(twins, cuts)
        varied = (count > 1) & ((least < 0) | (least != np.maximum.reduceat(twins, cuts)))
        chosen = order[np.repeat(varied, count)]
        item, place, left = item[chosen], place[chosen], left[chosen]
        del h, twins, order, cuts, count, least, varied
        end = (begin + size)[item]
        texts = [data[i:j] for i, j in zip(place.tolist(), end.tolist())]
        order = np.array(sorted(range(len(texts)), key=texts.__getitem__), np.int64)
        del texts
        item, self.place, self.left, self.length = item[order], place[order], left[order], (end - place)[order]
        self.common = self._common_prefixes()
        self.start = context["start"].astype(np.int64)[item] + self.place - begin[item]
        self.doc = (context["doc"].astype(np.int64) + np.repeat(base[:-1], [len(c) for c in contexts]))[item]
        self.order = rank[self.doc] << 32 | self.start
        self.before = np.where(self.place == begin[item], context["before"][item], self.left)

    def _common_prefixes(self) -> np.ndarray:
        """Bytes that each suffix and the next one begin with alike."""
        width, out = 2 * LENGTH - K, []
        text = np.lib.stride_tricks.sliding_window_view(np.r_[self.buf, np.zeros(width, np.uint8)], width)
        for i in range(0, len(self.place) - 1, 1 << 14):
            block = text[self.place[i:i + (1 << 14) + 1]]
            differs = block[1:] != block[:-1]
            out.append(np.where(differs.any(axis=1), differs.argmax(axis=1), width))
        common = np.concatenate(out) if out else np.zeros(0, np.int64)
        return np.minimum(common, np.minimum(self.length[1:], self.length[:-1]))

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """(first, end) of the runs of suffixes with a common prefix of LENGTH, two or more."""
        edge = np.flatnonzero(self.common < LENGTH) + 1
        first, end = np.r_[0, edge], np.r_[edge, len(self.place)]
        several = end - first > 1
        return first[several], end[several]

    def repeats(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, end, length) of the intervals of LENGTH or more whose suffixes differ to the left: the maximal repeats.

        A run whose neighbours all have the same in common is one interval; the others' trees are
        scanned with a stack.
        """
        first, end = self.runs()
        if not len(first):
            none = np.zeros(0, np.int64)
            return none, none, none
        pair, at = _expand(first, end - first - 1)
        edge = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        least, most = np.minimum.reduceat(self.common[at], edge), np.maximum.reduceat(self.common[at], edge)
        member, at = _expand(first, end - first)
        edge = np.flatnonzero(np.r_[True, member[1:] != member[:-1]])
        low, high = np.minimum.reduceat(self.left[at], edge), np.maximum.reduceat(self.left[at], edge)
        plain = least == most
        out = plain & ((low < 0) | (low != high))
        nested = [x for a, b in zip(first[~plain].tolist(), end[~plain].tolist()) for x in self._scan(a, b)]
        more = np.array(nested, np.int64).reshape(-1, 3)
        return np.r_[first[out], more[:, 0]], np.r_[end[out], more[:, 1]], np.r_[least[out], more[:, 2]]

    def _scan(self, begin: int, end: int) -> Iterator[tuple[int, int, int]]:
        """The stack scan of one run: an interval is told when it closes, if the bytes before its suffixes differ."""
        stack: list[list[int]] = []  # [common prefix, first suffix, least and greatest byte before] of open intervals
        common, before = [*self.common[begin:end - 1].tolist(), 0], self.left[begin:end].tolist()
        for i, (p, low) in enumerate(zip(common, before), begin):
            first, high = i, low
            while stack and stack[-1][0] > p:
                length, first, a, b = stack.pop()
                low, high = min(low, a), max(high, b)
                if low < 0 or low != high:
                    yield first, i + 1, length
            if stack and stack[-1][0] == p:
                stack[-1][2:] = min(low, stack[-1][2]), max(high, stack[-1][3])
            elif p >= LENGTH:
                stack.append([p, first, low, high])

    def later(self) -> tuple[np.ndarray, np.ndarray]:
        """(suffix, length): all occurrences of the maximal repeats but each one's first."""
        first, end, length = self.repeats()
        if not len(first):
            return first, length
        group, suffix = _expand(first, end - first)
        least = np.minimum.reduceat(self.order[suffix], np.cumsum(end - first) - (end - first))
        goes = self.order[suffix] > least[group]
        return suffix[goes], length[group[goes]]

    def varied(self) -> Iterator[np.ndarray]:
        """The suffixes of each run with different bytes before them, or the start of a document.

        Where all have the same byte before them, so has every longer repeat within.
        """
        for a, b in zip(*(x.tolist() for x in self.runs())):
            before = self.before[a:b]
            if before.min() < 0 or before.min() != before.max():
                yield np.arange(a, b)


def _places_of(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(where each row's documents begin among all rows', rank of each document by id and place in the table)."""
    tables = [np.frombuffer(r["docs"], _DOC) for r in rows]
    table = np.concatenate(tables)
    rank = np.empty(len(table), np.int64)
    rank[np.lexsort((table["rid"], table["order"]))] = np.arange(len(table))
    return np.cumsum([0, *map(len, tables)]), rank


def _told(rows: list[dict], doc: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> Iterator[tuple[int, bytes]]:
    """(slice, ranges) of the given places; doc counts the documents of all rows."""
    doc, start, end = _unite(doc, start, length)
    base = np.cumsum([0, *(len(r["docs"]) // _DOC.itemsize for r in rows)])
    row = np.searchsorted(base, doc, side="right") - 1
    edge = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else row
    for i, j in zip(edge.tolist(), np.r_[edge[1:], len(row)].tolist()):
        r = rows[int(row[i])]
        out = np.zeros(j - i, _RANGE)
        out["doc"] = (np.frombuffer(r["docs"], _DOC)["rid"] & 0xFFFF)[doc[i:j] - base[row[i]]]
        out["start"], out["end"] = start[i:j], end[i:j]
        yield r["slice"], out.tobytes()


def _find(table: pa.Table) -> pa.Table:
    """One bucket: the byte ranges of each slice that occur earlier, as occurrences of its maximal repeats."""
    rows = table.to_pylist()
    out = [(r["slice"], r["items"]) for r in rows if r["kind"] == 2]
    if near := [r for r in rows if r["kind"] == 0]:
        array = SuffixArray(near)
        suffix, length = array.later()
        out += _told(near, array.doc[suffix], array.start[suffix], length)
    if hot := [r for r in rows if r["kind"] == 1]:
        items = [np.frombuffer(r["items"], _HASHED) for r in hot]
        every = np.concatenate(items)
        base, rank = _places_of(hot)
        doc = every["doc"] + np.repeat(base[:-1], [len(x) for x in items])
        order = np.lexsort((every["start"], rank[doc], every["hash"]))
        again = order[1:][every["hash"][order[1:]] == every["hash"][order[:-1]]]
        out += _told(hot, doc[again], every["start"][again].astype(np.int64), LENGTH)
    return pa.Table.from_batches([_batch(out, _RANGES)])


def _cut(left: pa.Table, right: pa.Table) -> pa.Table:
    """One slice with all its ranges: what is left of each document."""
    out = []
    for row in left.to_pylist():
        facts, buf, offsets = _open(row["facts"], row["bytes"])
        ranges = np.frombuffer(b"".join(right.column("ranges").to_pylist()), _RANGE)
        change = np.zeros(len(buf) + 1, np.int32)
        at = offsets[ranges["doc"].astype(np.int64)]
        np.add.at(change, at + ranges["start"], 1)
        np.add.at(change, at + ranges["end"], -1)
        gone = np.cumsum(change)[:len(buf)] > 0
        for d in range(len(facts)):
            a, b = offsets[d], offsets[d + 1]
            mine = gone[a:b]
            spans = int(np.count_nonzero(mine[1:] & ~mine[:-1]) + (b > a and mine[0]))
            out.append((None if facts["null"][d] else int(facts["doc_id"][d]), int(b - a), int(np.count_nonzero(mine)), spans,
                        hashlib.sha256(buf[a:b][~mine].tobytes() if spans else buf[a:b].tobytes()).hexdigest()))
    return pa.Table.from_batches([_batch(out, _OUT)])


def _first_places(table: pa.Table) -> pa.Table:
    """One bucket: the occurrences of its varied windows, a node for each window."""
    near = [r for r in table.to_pylist() if r["kind"] == 0]
    out: list[tuple] = []
    if near:
        array = SuffixArray(near)
        table = np.concatenate([np.frombuffer(r["docs"], _DOC) for r in near])
        for members in array.varied():
            a = int(array.place[members[0]])
            node = hashlib.sha256(array.buf[a:a + LENGTH].tobytes()).digest()
            rid = table["rid"][array.doc[members]]
            for slice_, doc, start, before in zip((rid >> 16).tolist(), (rid & 0xFFFF).tolist(), array.start[members].tolist(), array.before[members].tolist()):
                out.append((node, LENGTH, slice_, doc, None, start, before, True))
    return pa.Table.from_batches([_batch(out, _PLACES)])


def _next_bytes(at: int, size: int):
    """One slice with its open places: the text from ``at`` bytes behind each place on, ``size`` bytes or up to the document's end."""

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for row in left.to_pylist():
            facts, buf, offsets = _open(row["facts"], row["bytes"])
            for p in right.to_pylist():
                d = p["doc"]
                begin, end = int(offsets[d]) + p["start"] + at, int(offsets[d + 1])
                doc_id = None if facts["null"][d] else int(facts["doc_id"][d])
                out.append((p["node"], at, p["slice"], d, doc_id, p["start"], p["before"], buf[begin:min(begin + size, end)].tobytes()))
        return pa.Table.from_batches([_batch(out, _TEXTS)])

    return read


def _common(a: bytes, b: bytes) -> int:
    """Bytes that two texts begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def _split(at: int, size: int):
    """One bucket: of each node the repeats that end within the text just read; places with all of it in common are open nodes again."""

    def split(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for node, group in groupby(sorted(table.to_pylist(), key=lambda r: (r["node"], r["text"])), key=lambda r: r["node"]):
            members = list(group)
            prefixes = [_common(x["text"], y["text"]) for x, y in zip(members, members[1:])]
            stack: list[tuple[int, int]] = []  # (common prefix, left end) of open intervals
            for i, p in enumerate([*prefixes, -1]):
                left = i
                while stack and stack[-1][0] > p:
                    common, left = stack.pop()
                    before = {r["before"] for r in members[left:i + 1]}
                    if len(before) > 1 or -1 in before:
                        name = hashlib.sha256(node + members[i]["text"][:common]).digest()
                        out += [(name, at + common, r["slice"], r["doc"], r["doc_id"], r["start"], r["before"], common == size) for r in members[left:i + 1]]
                if p >= 0 and (not stack or stack[-1][0] < p):
                    stack.append((p, left))
        return pa.Table.from_batches([_batch(out, _PLACES)])

    return split


def _prepared(docs: DataFrame, hot: int, every: bool = False) -> tuple[DataFrame, DataFrame, int]:
    spark = docs.sparkSession
    ship_code(spark)
    n_buckets = min(1 << 22, bucket_count(spark, text_bytes(docs), BUCKET_BYTES))
    slices = stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_slice_documents, _ddl(_SLICES)), "slices")
    flags = slices.mapInArrow(_send_anchors(n_buckets), _ddl(_ANCHORS)).groupBy("bucket").applyInArrow(_count_anchors(hot), _ddl(_FLAGS))
    windows = slices.groupBy("slice").cogroup(flags.groupBy("slice")).applyInArrow(_send_windows(n_buckets, every), _ddl(_WINDOWS))
    return slices, windows, n_buckets


def document_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    A byte goes if a LENGTH-byte string over it also starts earlier: in a document with a smaller
    doc_id (a null one is smaller than all others; equal ids by their place in the table), or
    earlier in the same one.  Strings are judged on the input.  A null text is empty; texts below
    LENGTH bytes stay whole.  An empty table gives an empty table; other columns are ignored.
    """
    slices, windows, _ = _prepared(docs, hot)
    ranges = windows.groupBy("bucket").applyInArrow(_find, _ddl(_RANGES))
    return slices.groupBy("slice").cogroup(ranges.groupBy("slice")).applyInArrow(_cut, _ddl(_OUT))


def maximal_repeats(docs: DataFrame) -> DataFrame:
    """(group_id, length, doc_id, start): repeats of LENGTH bytes or more that neither side extends, with all occurrences.

    The occurrences of a group differ in the byte before them, and in the byte behind them; the ends
    of a document differ from all bytes and from each other.  A group is the digest of the common
    bytes, taken round by round.  Rows that repeat an id are occurrences each.  Repeats within
    repeats are groups too, so a text of short period gives groups whose members grow with the
    square of its length.  The occurrences of one window meet in one task.
    """
    slices, windows, n_buckets = _prepared(docs, 1 << 62, every=True)
    places = stored(windows.groupBy("bucket").applyInArrow(_first_places, _ddl(_PLACES)), "places")
    out, at, size = places.where("not open"), LENGTH, FOLLOWED
    while not (open_ := places.where("open")).isEmpty():
        touched = slices.join(small(open_.select("slice").distinct()), "slice", "left_semi")
        texts = touched.groupBy("slice").cogroup(open_.groupBy("slice")).applyInArrow(_next_bytes(at, size), _ddl(_TEXTS))
        buckets = texts.groupBy(F.pmod(F.xxhash64("node"), F.lit(n_buckets)).alias("bucket"))
        places = stored(buckets.applyInArrow(_split(at, size), _ddl(_PLACES)), "places")
        out = out.unionByName(places.where("not open"))
        at, size = at + size, min(4 * size, MOST_FOLLOWED)
    return out.select(F.lower(F.hex("node")).alias("group_id"), "length", "doc_id", "start")
