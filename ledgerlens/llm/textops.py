"""Vectorised text helpers for Arrow batches: byte buffers, word spans, word and shingle hashes.

All functions work on one *slice*: a bounded run of documents held as a single byte buffer with
offsets.  Hashes are 64-bit: a position-weighted sum of random byte values modulo 2**64 with an
odd base, passed through a bijective mixer, so that equal byte strings have equal hashes
everywhere and prefix sums give every span's hash without a Python loop.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of the word separator class [\x20\x09-\x0D].
SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Text bytes in a slice; a longer document is a slice of its own.
SLICE_BYTES = 2 << 20
#: Documents in a slice at most, so that 16 bits number them.
SLICE_DOCS = 1 << 15

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_U = np.uint64
_is_sep = np.zeros(256, dtype=bool)
_is_sep[list(SEPARATORS)] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift, multiply)."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


_byte_value = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xA24BAED4963EE407))


def _powers(n: int) -> np.ndarray:
    global _POW
    if len(_POW) < n:
        size = max(n, 2 * len(_POW))
        p = np.full(size, _BASE, dtype=np.uint64)
        p[0] = 1
        _POW = np.cumprod(p)
    return _POW[:n]


_POW = np.ones(1, dtype=np.uint64)
_INV = _U(pow(int(_BASE), -1, 1 << 64))


def _inverse_powers(n: int) -> np.ndarray:
    global _INV_POW
    if len(_INV_POW) < n:
        size = max(n, 2 * len(_INV_POW))
        p = np.full(size, _INV, dtype=np.uint64)
        p[0] = 1
        _INV_POW = np.cumprod(p)
    return _INV_POW[:n]


_INV_POW = np.ones(1, dtype=np.uint64)


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """P with P[i] = sum of value(buf[j]) * base**j over j < i (mod 2**64)."""
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_byte_value[buf] * _powers(len(buf)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of buf[start:end] for each span, from the prefix sums; the length takes part."""
    inv = _inverse_powers(len(sums))
    length = (end - start).astype(np.uint64)
    return mix((sums[end] - sums[start]) * inv[start] + length * _U(0xC2B2AE3D27D4EB4F))


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _lower[buf]


def word_spans(buf: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = ~_is_sep
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): spans of the words, and the index of each document's first word.

    offsets: where documents start, and the end.  ``first`` has one entry more than documents.
    in_word: for each of the 256 bytes, whether it belongs to a word.
    """
    n = len(buf)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(offsets), dtype=np.int64)
    word = in_word[buf]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    begins[inner] = word[inner]  # a word never runs from one document into the next
    ends[inner - 1] = word[inner - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, doc): the k-word shingles of every document, repeats included.

    A document with 1 to k-1 words has its whole sequence as the only shingle.
    """
    count = np.diff(first)
    n_sh = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), n_sh)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n_sh) - n_sh, n_sh) + first[:-1][doc]
    left = first[1:][doc] - at
    h = np.zeros(len(doc), dtype=np.uint64)
    for j in range(k):
        ok = left > j
        part = np.zeros(len(doc), dtype=np.uint64)
        part[ok] = words[at[ok] + j]
        h = mix(h + part + _U(j + 1))
    return h, doc


def distinct_by_doc(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (hash, doc) pairs, by document, then hash."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], doc[keep]


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buf, offsets) of a string column; null is empty."""
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def cut_slices(batch: pa.RecordBatch, text: str, max_bytes: int = SLICE_BYTES,
               max_docs: int = SLICE_DOCS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut an Arrow batch into (rows, buf, offsets) of a bounded number of text bytes."""
    if not batch.num_rows:
        return
    buf, offsets = column_bytes(batch.column(batch.schema.get_field_index(text)))
    i, n = 0, batch.num_rows
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), i + max_docs, n)
        yield batch.slice(i, j - i), buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j
