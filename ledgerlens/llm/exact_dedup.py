"""Operator 13: exact dedup against a minimal perfect hash over the distinct digests of history.

1. Every text becomes its SHA-256; texts are never shuffled.  Equal digests of one side are one
   class: its size and its winner, the row with the largest (doc_id, place).
2. History's classes are dealt to buckets by digest, a bounded number each.  A bucket builds a
   minimal perfect hash (levels of bit maps: a digest alone on its bit takes the bit's rank, the
   others go to the next level) and lays the full digests, winners and sizes out by slot.  That
   table is the index; it is stored and can be kept for later batches.
3. Classes of incoming rows look their slot up in their bucket and compare all 32 bytes of the
   digest: members join the class of that slot, the others are classes of their own.
4. Rows learn their class's winner.  Classes with more than a thousandth of all rows are at most a
   thousand, so those are broadcast; the rest meet their rows in a shuffle join without hot keys.

Defined results: a null text is the empty text.  Of rows with equal text and equal doc_id the one
read last stays, so exactly one row of a group is kept; a null doc_id loses to any other and gives
a null keep_id only where the whole group has none.  No rows give no rows.  Further columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import bucket_count, ship_code, stored
from ledgerlens.llm.textops import mix

#: Distinct digests in a bucket of the index, about.
BUCKET_DIGESTS = 50_000
#: Bits of a level for each digest that is left.
GAMMA = 2
#: A class with more than this share of all rows is broadcast; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001

CLASS = "digest binary, doc_id long, place long, n long"
INDEX = "bucket long, levels array<binary>, digests binary, doc_ids array<long>, places array<long>, counts array<long>"


# ---------------------------------------------------------------- minimal perfect hash
def _words(digests: pa.Array) -> np.ndarray:
    """The digests as rows of four 64-bit words."""
    data = b"".join(digests.to_pylist())
    return np.frombuffer(data, dtype="<u8").reshape(-1, 4)


def _position(words: np.ndarray, level: int, bits: int) -> np.ndarray:
    h = np.full(len(words), level + 1, dtype=np.uint64)
    for j in range(4):
        h = mix(h ^ words[:, j])
    return (h % np.uint64(bits)).astype(np.int64)


def build_levels(words: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(bit map of each level, slot of each digest); the digests must be distinct."""
    slot, left, levels, base = np.zeros(len(words), dtype=np.int64), np.arange(len(words)), [], 0
    while len(left):
        bits = 8 * -(-max(64, GAMMA * len(left)) // 8)
        at = _position(words[left], len(levels), bits)
        alone = np.bincount(at, minlength=bits) == 1
        mine = alone[at]
        rank = np.cumsum(alone)
        slot[left[mine]] = base + rank[at[mine]] - 1
        levels.append(np.packbits(alone).tobytes())
        base += int(alone.sum())
        left = left[~mine]
    return levels, slot


def find_slots(levels: list[bytes], words: np.ndarray) -> np.ndarray:
    """The slot a digest would have; -1 where no level has its bit.  Digests beyond the index may get any slot."""
    slot, left, base = np.full(len(words), -1, dtype=np.int64), np.arange(len(words)), 0
    for level, packed in enumerate(levels):
        alone = np.unpackbits(np.frombuffer(packed, dtype=np.uint8))
        at = _position(words[left], level, len(alone))
        mine = alone[at] == 1
        rank = np.cumsum(alone, dtype=np.int64)
        slot[left[mine]] = base + rank[at[mine]] - 1
        base += int(rank[-1])
        left = left[~mine]
    return slot


# ---------------------------------------------------------------- classes and index
def digest_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, place, digest) of every row, stored, so that places stay as they are."""
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"))
    return stored(rows.withColumn("place", F.monotonically_increasing_id()), "digests")


def classes(rows: DataFrame) -> DataFrame:
    """One row a distinct digest: its winner and its size (counted within each task first)."""
    return (rows.groupBy("digest").agg(F.max(F.struct("doc_id", "place")).alias("w"), F.count(F.lit(1)).alias("n"))
            .select("digest", "w.doc_id", "w.place", "n"))


def _bucketed(table: DataFrame, n_buckets: int) -> DataFrame:
    return table.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(n_buckets)))


def build_index(history: DataFrame, n_buckets: int) -> DataFrame:
    """The stored index over a class table: one row a bucket."""
    ship_code(history.sparkSession)

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        digests = table.column("digest").combine_chunks()
        levels, slot = build_levels(_words(digests))
        order = pa.array(np.argsort(slot))
        laid = table.take(order)
        return pa.table({
            "bucket": pa.array([key[0].as_py()], pa.int64()), "levels": pa.array([levels], pa.list_(pa.binary())),
            "digests": pa.array([b"".join(laid.column("digest").to_pylist())], pa.binary()),
            **{name: pa.array([laid.column(c).to_pylist()], pa.list_(pa.int64()))
               for name, c in (("doc_ids", "doc_id"), ("places", "place"), ("counts", "n"))}})

    return stored(_bucketed(history, n_buckets).groupBy("bucket").applyInArrow(build, INDEX), "digest_index")


def look_up(incoming: DataFrame, index: DataFrame, n_buckets: int) -> DataFrame:
    """The classes of history and incoming together: members are merged into the class of their slot."""
    ship_code(incoming.sparkSession)

    def merge(new: pa.Table, held: pa.Table) -> pa.Table:
        new = new.select(["digest", "doc_id", "place", "n"])
        if not held.num_rows:
            return new
        row = held.slice(0, 1).to_pylist()[0]
        old = pa.table({"digest": pa.array([row["digests"][i:i + 32] for i in range(0, len(row["digests"]), 32)], pa.binary()),
                        "doc_id": pa.array(row["doc_ids"], pa.int64()), "place": pa.array(row["places"], pa.int64()),
                        "n": pa.array(row["counts"], pa.int64())})
        if not new.num_rows:
            return old
        digests = _words(new.column("digest").combine_chunks())
        slot = find_slots(row["levels"], digests)
        slots = np.frombuffer(row["digests"], dtype="<u8").reshape(-1, 4)
        member = (slot >= 0) & (slots[slot] == digests).all(axis=1)  # byte check: a slot is only a guess
        fresh = new.filter(pa.array(~member))
        doc_id, place, n = old.column("doc_id").to_pylist(), old.column("place").to_pylist(), old.column("n").to_numpy().copy()
        rank = lambda d, p: (d is not None, d or 0, p)
        met = new.filter(pa.array(member))
        for s, d, p, c in zip(slot[member].tolist(), *(met.column(c).to_pylist() for c in ("doc_id", "place", "n"))):
            n[s] += c
            if rank(d, p) > rank(doc_id[s], place[s]):
                doc_id[s], place[s] = d, p
        merged = pa.table({"digest": old.column("digest"), "doc_id": pa.array(doc_id, pa.int64()),
                           "place": pa.array(place, pa.int64()), "n": pa.array(n, pa.int64())})
        return pa.concat_tables([merged, fresh.cast(merged.schema)])

    return (_bucketed(incoming, n_buckets).groupBy("bucket")
            .cogroup(index.groupBy("bucket")).applyInArrow(merge, CLASS))


# ---------------------------------------------------------------- rows
def with_winner(rows: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    total = rows.count()
    table = table.select("digest", F.col("doc_id").alias("keep_id"), F.col("place").alias("keep_place"),
                         F.col("n").alias("group_size"))
    is_hot = F.col("group_size") > HOT_SHARE * total
    hot = F.broadcast(table.where(is_hot))  # at most 1 / HOT_SHARE rows: sizes sum to the number of rows
    tried = rows.join(hot, "digest", "left")
    rest = tried.where("group_size is null").select("digest", "doc_id", "place").join(table.where(~is_hot), "digest")
    found = tried.where("group_size is not null").unionByName(rest)
    return found.select("doc_id", "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"))


def dedup(history: DataFrame, incoming: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows with their winner, given the digest rows of history and incoming (``rows`` is both)."""
    spark = rows.sparkSession
    old = stored(classes(history), "history_classes")
    n_buckets = bucket_count(spark, old.count(), BUCKET_DIGESTS)
    index = build_index(old, n_buckets)
    return with_winner(rows, stored(look_up(classes(incoming), index, n_buckets), "digest_classes"))


def exact_copies(docs: DataFrame) -> DataFrame:
    """All documents with their group's winner: the older half of the doc_id range is history, the rest incoming."""
    rows = digest_rows(docs)
    ends = rows.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    middle = F.lit(None).cast("long") if ends["a"] is None else F.lit((ends["a"] + ends["b"]) // 2)
    older = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    return dedup(rows.where(older), rows.where(~older), rows)
