"""Operator 4: BPE encoding and decoding with content-defined chunk reuse.

1. A rolling hash over the bytes cuts documents where the content says so, so equal passages give
   equal chunks wherever they stand.  A cut inside a word takes that word out as a *seam*; chunks
   are the runs of whole words between cuts and seams.
2. Slices of documents send their distinct chunks, compressed, to hash buckets.  A bucket encodes
   every distinct chunk once and answers each slice with token ids.
3. A slice puts its documents together.  Every seam is repaired by encoding it with the whole word
   before and after it: where both agree exactly with the tokens of the chunks beside it, what
   stands between them is the seam's tokens; where not, the whole document is encoded again.
4. The ids are decoded, and both directions are hashed.

The tokenizer is a file of the ``tokenizers`` library; its path is a parameter.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textops as T
from ledgerlens.llm.common import ship_code, stored, text_bytes

#: Mean bytes of a chunk: a cut where this many low values of the rolling hash coincide.
CHUNK_BITS = 11
WINDOW_BYTES = 16
SLICE_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
#: Compression of what is shuffled: texts and ids.
LEVEL = 9
#: Words whose ids a worker remembers; the store starts anew beyond it.
MEMO_WORDS = 300_000

_SENT = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), ("chunk", pa.binary()), ("length", pa.binary()),
                   ("bytes", pa.binary())])
_ANSWER = pa.schema([("slice", pa.int64()), ("chunk", pa.binary()), ("length", pa.binary()), ("ids", pa.binary())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.binary()), ("decoded_sha256", pa.binary()),
                  ("seams", pa.int64()), ("again", pa.string())])
_OUT_DDL = "doc_id long, n_tokens long, ids_sha256 binary, decoded_sha256 binary, seams long, again string"


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _id_type(path: str) -> str:
    return "<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"


def encode(path: str, texts: list[str]) -> list[bytes]:
    """The ids of each text, packed."""
    kind = _id_type(path)
    out: list[bytes] = []
    for i in range(0, len(texts), 4096):
        out += [np.array(e.ids, dtype=kind).tobytes() for e in tokenizer(path).encode_batch_fast(texts[i:i + 4096], add_special_tokens=False)]
    return out


_memo: dict[bytes, bytes] = {}


def encode_chunks(path: str, chunks: list[bytes]) -> list[bytes]:
    """The ids of chunks of whole words; each word unknown to this worker is encoded once."""
    words = [c.split() for c in chunks]
    missing = list(set().union(*words) - _memo.keys()) if words else []
    if len(_memo) + len(missing) > MEMO_WORDS:
        _memo.clear()
        missing = list(set().union(*words))
    _memo.update(zip(missing, encode(path, [w.decode() for w in missing])))
    return [b"".join(map(_memo.__getitem__, w)) for w in words]


def cut_points(buf: np.ndarray) -> np.ndarray:
    """Positions after windows of bytes whose rolling hash has its upper bits zero."""
    w = WINDOW_BYTES
    if len(buf) < w:
        return np.zeros(0, dtype=np.int64)
    sums = T.prefix_sums(buf)
    h = (sums[w:] - sums[:-w]) * T._inverse_powers(len(sums))[:len(buf) - w + 1]
    return np.flatnonzero(h * np.uint64(0x9FB21C651E98DF25) >> np.uint64(64 - CHUNK_BITS) == 0) + w


def _layout(buf: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, list[bytes]]:
    """(distinct chunks, items, items of each document, seams): an item is a chunk's number or -1 - a seam's number.

    A seam is three words: the one before, the one cut, the one after (either side may be empty).
    """
    start, end, first = T.word_spans(buf, offsets)
    cuts = cut_points(buf)
    cuts = cuts[cuts - WINDOW_BYTES >= offsets[np.searchsorted(offsets, cuts, side="left") - 1]]  # a window within one document
    word = np.searchsorted(start, cuts, side="left")  # the first word that starts at or after the cut
    inside = np.zeros(len(start), dtype=bool)
    split = np.zeros(len(start) + 1, dtype=bool)
    split[word] = True
    if len(start):
        cut_word = np.maximum(word - 1, 0)
        inside[cut_word[(word > 0) & (start[cut_word] < cuts) & (cuts < end[cut_word])]] = True
    data = buf.tobytes()
    chunks: dict[bytes, int] = {}
    items: list[int] = []
    counts = np.zeros(len(offsets) - 1, dtype="<u4")
    seams: list[bytes] = []
    edges = np.flatnonzero(split[:-1] | inside)  # words that begin a chunk, or are seams
    starts, ends, first = start, end, first.tolist()
    at = np.searchsorted(edges, first).tolist()
    edges = edges.tolist()
    for d in range(len(counts)):
        a, b = first[d], first[d + 1]
        if a == b:
            continue
        before = len(items)
        here = a
        for e in [*edges[at[d]:at[d + 1]], b]:
            if e > here:
                items.append(chunks.setdefault(data[starts[here]:ends[e - 1]], len(chunks)))
            here = e
            if e < b and inside[e]:
                left = data[starts[e - 1]:ends[e - 1]] if e > a and not inside[e - 1] else b""
                right = data[starts[e + 1]:ends[e + 1]] if e + 1 < b and not inside[e + 1] else b""
                items.append(-1 - len(seams))
                seams.append(b" ".join((left, data[starts[e]:ends[e]], right)))
                here = e + 1
        counts[d] = len(items) - before
    return list(chunks), np.array(items, dtype="<i4"), counts, seams


def _sender(n_buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 24
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for rows, buf, offsets in T.cut_slices(batch, "text", SLICE_BYTES):
                at += 1
                chunks, items, counts, seams = _layout(buf, offsets)
                bucket = np.array([int.from_bytes(hashlib.blake2b(c, digest_size=8).digest(), "little") % n_buckets for c in chunks], np.int64)
                out = []
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else []
                for i, j in zip(cuts, [*cuts[1:], len(order)]):
                    mine = order[i:j]
                    out.append((int(bucket[mine[0]]), at, mine.astype("<u4").tobytes(), np.array([len(chunks[k]) for k in mine], "<u4").tobytes(),
                                press.compress(b"".join(chunks[k] for k in mine))))
                ids = rows.column("doc_id")
                head = np.array([rows.num_rows, len(items)], "<i8").tobytes()
                facts = b"".join((head, ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                                  ids.is_null().to_numpy(zero_copy_only=False).astype("u1").tobytes(), counts.tobytes(), items.tobytes()))
                out.append((at * 2654435761 % n_buckets, at, None, press.compress(facts), press.compress(b"\n".join(seams))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _SENT)], schema=_SENT)

    return send


def _encoder(path: str):
    """One bucket: encodes every distinct chunk once; a slice's own facts pass through."""

    def answer(table: pa.Table) -> pa.Table:
        pack, unpack = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        rows = table.drop_columns(["bucket"]).to_pylist()
        number: dict[bytes, int] = {}
        wanted = []
        for row in rows:
            if row["chunk"] is None:
                wanted.append(None)
                continue
            data, ends = unpack.decompress(row["bytes"]), np.cumsum(np.frombuffer(row["length"], "<u4")).tolist()
            wanted.append([number.setdefault(data[a:b], len(number)) for a, b in zip([0, *ends], ends)])
        ids = encode_chunks(path, list(number))
        out = []
        for row, want in zip(rows, wanted):
            if want is None:
                out.append((row["slice"], None, row["length"], row["bytes"]))
            else:
                out.append((row["slice"], row["chunk"], np.array([len(ids[k]) for k in want], "<u4").tobytes(), pack.compress(b"".join(ids[k] for k in want))))
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _ANSWER)], schema=_ANSWER)

    return answer


def repair(path: str, seams: list[bytes]) -> list[tuple[bytes, bytes, bytes] | None]:
    """(ids of the word before, of the seam, of the word after); None where no exact agreement is found."""
    parts = [s.split(b" ") for s in seams]
    whole = encode(path, [s.decode() for s in seams])
    flanks = list({w for p in parts for w in (p[0], p[2])})
    known = dict(zip(flanks, encode(path, [w.decode() for w in flanks])))
    out = []
    for p, ids in zip(parts, whole):
        left, right = known[p[0]], known[p[2]]
        agrees = len(left) + len(right) <= len(ids) and ids.startswith(left) and ids.endswith(right)
        out.append((left, ids[len(left):len(ids) - len(right)], right) if agrees else None)
    return out


@lru_cache(maxsize=2)
def _token_strings(path: str) -> list[str] | None:
    """Every id's token, where the file has no decoder: its texts are the tokens joined by blanks."""
    tok = tokenizer(path)
    if tok.decoder is not None:
        return None
    return [tok.id_to_token(i) or "" for i in range(max(tok.get_vocab(with_added_tokens=True).values()) + 1)]


def decode(path: str, ids: np.ndarray) -> str:
    table = _token_strings(path)
    if table is None:
        return tokenizer(path).decode(ids.tolist(), skip_special_tokens=False)
    return " ".join(map(table.__getitem__, ids.tolist()))


def _digests(path: str, packed: bytes) -> tuple[int, bytes, bytes]:
    ids = np.frombuffer(packed, _id_type(path))
    return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).digest(), hashlib.sha256(decode(path, ids).encode()).digest())


def _assembler(path: str):
    """One slice: its documents from the answered chunks and the repaired seams."""

    def assemble(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        ids_of: dict[int, bytes] = {}
        facts = seams = b""
        for row in table.to_pylist():
            if row["chunk"] is None:
                facts, seams = unpack.decompress(row["length"]), unpack.decompress(row["ids"])
            else:
                data, ends = unpack.decompress(row["ids"]), np.cumsum(np.frombuffer(row["length"], "<u4")).tolist()
                ids_of.update(zip(np.frombuffer(row["chunk"], "<u4").tolist(), (data[a:b] for a, b in zip([0, *ends], ends))))
        n, n_items = np.frombuffer(facts, "<i8", 2).tolist()
        doc_id = np.frombuffer(facts, "<i8", n, 16)
        null = np.frombuffer(facts, "u1", n, 16 + 8 * n)
        counts = np.frombuffer(facts, "<u4", n, 16 + 9 * n).tolist()
        items = np.frombuffer(facts, "<i4", n_items, 16 + 13 * n).tolist()
        repaired = repair(path, seams.split(b"\n")) if n_items and min(items) < 0 else []
        out, at = [], 0
        for d in range(n):
            mine = items[at:at + counts[d]]
            at += counts[d]
            parts, whole = [], True
            for k, item in enumerate(mine):
                if item >= 0:
                    parts.append(ids_of[item])
                    continue
                seam = repaired[-1 - item]
                if seam is None:
                    whole = False
                    break
                before = ids_of[mine[k - 1]] if k and mine[k - 1] >= 0 else b""
                after = ids_of[mine[k + 1]] if k + 1 < len(mine) and mine[k + 1] >= 0 else b""
                whole &= before.endswith(seam[0]) and after.startswith(seam[2])
                parts.append(seam[1])
            doc = None if null[d] else int(doc_id[d])
            if whole:
                out.append((doc, *_digests(path, b"".join(parts)), sum(i < 0 for i in mine), None))
            else:
                out.append((doc, None, None, None, sum(i < 0 for i in mine), f"{table.column('slice')[0].as_py()}:{d}"))
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _OUT)], schema=_OUT)

    return assemble


def _whole(path: str):
    """Documents encoded in one piece, for those whose seams don't agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").fill_null("").to_pylist()
            rows = [_digests(path, p) for p in encode(path, texts)]
            columns = [batch.column("doc_id").to_pylist(), *map(list, zip(*rows)), [0] * len(rows), [None] * len(rows)] if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _OUT)], schema=_OUT)

    return run


def encoded_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and seams (repaired joins) of every row.

    The ids are those of encoding the whole text in one piece without special tokens; decoded is
    their decoding with special tokens kept.  A null text is empty: no ids, an empty decoded text.
    Repeated rows are answered each, other columns are ignored, an empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship_code(spark)
    # one bucket a partition: many small ones would compress worse, and chunks are dealt evenly
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes(docs) // BUCKET_BYTES))
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    sent = rows.mapInArrow(_sender(n_buckets), "bucket int, slice long, chunk binary, length binary, bytes binary")
    answers = sent.groupBy("bucket").applyInArrow(_encoder(path), "slice long, chunk binary, length binary, ids binary")
    out = stored(answers.groupBy("slice").applyInArrow(_assembler(path), _OUT_DDL), "encoded")
    def shown(df: DataFrame) -> DataFrame:
        return df.select("doc_id", "n_tokens", *[F.lower(F.hex(c)).alias(c) for c in ("ids_sha256", "decoded_sha256")], "seams")

    done = shown(out.where("again is null"))
    again = out.where("again is not null").select(F.col("doc_id").alias("again_id")).distinct()
    if again.isEmpty():
        return done
    retried = rows.join(again, F.col("doc_id").eqNullSafe(F.col("again_id")), "left_semi").mapInArrow(_whole(path), _OUT_DDL)
    return done.join(again, F.col("doc_id").eqNullSafe(F.col("again_id")), "left_anti").unionByName(shown(retried))
