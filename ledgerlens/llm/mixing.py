"""Operator 1: mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source's documents stand in a pseudo-random order and form one stream of words, repeated up
to three times; the mix takes its first ``target`` words, cut into blocks.  The blocks are dealt to
output shards by a binary tree: at a node the left half's share of every source's blocks is one
multivariate-hypergeometric draw, seeded by the node, so all shards together hold exactly the
quotas and each is a fair sample.  A task walks from the root to its own shards only and needs no
other task's draws.  A shard's blocks are a disjoint run of a permutation of the source's blocks,
shuffled within the shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import ship_code, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, null last, repeated as often as needed.
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK_WORDS = 4096
SHARD_BLOCKS = 256
SEED = 20240229
#: The weights are a mixture's settings and stand in every task; more sources than this are an error.
MAX_SOURCES = 1_000_000


@dataclass(frozen=True)
class Quotas:
    """A mix: for each source its size, target and words to take; the words of a block, the shards."""

    sources: list[str | None]
    sizes: list[int]
    targets: list[float]
    take: list[int]
    block_words: int
    shards: int

    @property
    def blocks(self) -> np.ndarray:
        return -(-np.array(self.take, dtype=np.int64) // self.block_words)


def targets(sizes: list[int], weights: list[float]) -> list[float]:
    """Shares of the total by weight; none above MAX_REPEATS times its size, the excess reshared by weight."""
    left, open_sources = float(sum(sizes)), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while open_sources:
        total = sum(weights[i] for i in open_sources)
        full = {i for i in open_sources if left * weights[i] > MAX_REPEATS * sizes[i] * total}
        if not full:
            for i in open_sources:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(MAX_REPEATS * sizes[i])
        left -= sum(MAX_REPEATS * sizes[i] for i in full)
        open_sources -= full
    return out


def quotas(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> Quotas:
    """Source sizes (one aggregated row a source) and what the mix takes of each."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).orderBy(F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = [r["size"] for r in rows]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
    take = [min(round(t), MAX_REPEATS * n) for t, n in zip(wanted, sizes)]
    block = max(BLOCK_WORDS, -(-sum(take) // (1 << 29)))  # the draws need fewer than 1e9 blocks
    return Quotas([r["source"] for r in rows], sizes, wanted, take, block, max(1, sum(take) // (block * SHARD_BLOCKS)))


def permuted(positions: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A pseudo-random bijection of range(n): a four-round Feistel network, walked until it falls below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.SeedSequence([SEED, seed]).generate_state(4, np.uint64)
    out = positions.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for key in keys:
            f = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            left, right = right, left ^ (f >> np.uint64(64 - half) if half < 64 else f)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def shard_draws(blocks: np.ndarray, shards: int, first: int, last: int, seed: int = SEED) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, start, count) by source for the shards in [first, last), from the splitting tree."""
    total = int(blocks.sum())
    stack = [(0, shards, blocks, np.zeros_like(blocks))]
    while stack:
        low, high, count, start = stack.pop()
        if high <= first or low >= last:
            continue
        if high - low == 1:
            yield low, start, count
            continue
        middle = (low + high) // 2
        share = total * middle // shards - total * low // shards
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(count, share, method="marginals") if count.sum() else np.zeros_like(count)
        stack.append((middle, high, count - left, start + left))
        stack.append((low, middle, left, start))


_BLOCKS = pa.schema([("source_no", pa.int32()), ("block", pa.int64()), ("shard", pa.int64()), ("slot", pa.int64())])


def _dealer(q: Quotas):
    blocks, n = q.blocks, q.shards

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.sort(batch.column(0).to_numpy())
            for run in np.split(ids, np.flatnonzero(np.diff(ids) > 1) + 1):
                if not len(run):
                    continue
                for shard, start, count in shard_draws(blocks, n, int(run[0]), int(run[-1]) + 1):
                    source = np.repeat(np.arange(len(blocks)), count)
                    own = [permuted(np.arange(a, a + c), int(blocks[s]), s) for s, (a, c) in enumerate(zip(start, count)) if c]
                    slot = np.random.default_rng([SEED, 7, shard]).permutation(len(source))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(source.astype(np.int32)), pa.array(np.concatenate(own) if own else np.zeros(0, np.int64)),
                         pa.array(np.full(len(source), shard)), pa.array(slot)], schema=_BLOCKS)

    return deal


def dealt_blocks(docs: DataFrame, q: Quotas) -> DataFrame:
    """(source_no, block, shard, slot): every block of every quota, once."""
    spark = docs.sparkSession
    ship_code(spark)
    tasks = min(q.shards, max(1, 4 * spark.sparkContext.defaultParallelism))
    return spark.range(0, q.shards, 1, tasks).mapInArrow(_dealer(q), "source_no int, block long, shard long, slot long")


def sized_documents(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Stored: a row number, doc_id, source, size in words, and the place ``u`` in the source's order."""
    text = F.coalesce("text", F.lit(""))
    return stored(docs.select(F.col(row) if row else F.monotonically_increasing_id().alias("rid"), "doc_id", "source",
                              F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                              F.xxhash64(F.lit(SEED), "doc_id", text).bitwiseAND(F.lit((1 << 62) - 1)).alias("u")), "sized")


def _numbered(sized: DataFrame, q: Quotas) -> DataFrame:
    """With the source's number, size, target and words to take."""
    spark = sized.sparkSession
    rows = [(i, s, n, float(t), k) for i, (s, n, t, k) in enumerate(zip(q.sources, q.sizes, q.targets, q.take))]
    table = spark.createDataFrame(rows, "source_no int, name string, source_size long, target double, take long")
    table = F.broadcast(table) if len(rows) <= 100_000 else table
    return sized.join(table, F.col("source").eqNullSafe(F.col("name"))).drop("name")


def mixed_segments(sized: DataFrame, q: Quotas) -> DataFrame:
    """The mix: (shard, slot, rid, doc_id, repeat, block, first_word, end_word), words of a document.

    first_word and end_word count from 0 in the document's own words, end exclusive.  Documents
    stand in their source's order by hash; places come from sums within hash ranges and over them,
    so no source's rows meet in one task.
    """
    spark = sized.sparkSession
    ranges = max(1, int(sized.count() ** 0.5))
    rows = _numbered(sized.where("size > 0"), q).withColumn(
        "range", (F.col("u") / F.lit(float(1 << 62)) * F.lit(ranges)).cast("int"))
    sums = rows.groupBy("source_no", "range").agg(F.sum("size").alias("in_range"))
    over = Window.partitionBy("source_no").orderBy("range")
    before = sums.select("source_no", "range", (F.sum("in_range").over(over) - F.col("in_range")).alias("before"))
    within = Window.partitionBy("source_no", "range").orderBy("u", "rid").rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("earlier", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(before, ["source_no", "range"]).withColumn("at", F.col("before") + F.col("earlier")))
    repeats = placed.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(MAX_REPEATS - 1))))
    place = F.col("repeat") * F.col("source_size") + F.col("at")
    words = repeats.withColumn("place", place).withColumn("stop", F.least(F.col("take"), F.col("place") + F.col("size"))).where("place < stop")
    size = F.lit(q.block_words).cast("long")
    segments = words.withColumn("block", F.explode(F.sequence(F.expr(f"place div {q.block_words}"), F.expr(f"(stop - 1) div {q.block_words}"))))
    segments = segments.select(
        "source_no", "block", "rid", "doc_id", "repeat",
        (F.greatest(F.col("block") * size, F.col("place")) - F.col("place")).alias("first_word"),
        (F.least((F.col("block") + 1) * size, F.col("stop")) - F.col("place")).alias("end_word"))
    return segments.join(dealt_blocks(sized, q), ["source_no", "block"]).select(
        "shard", "slot", "rid", "doc_id", "repeat", "block", "first_word", "end_word")


def document_mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) of every row.

    A null source is a source of its own, last in order.  Null, empty and blank texts have size 0
    and nothing is taken of them.  Rows are told apart by their place, so repeated ids are rows of
    their own.  Reruns over the same rows agree: all draws are seeded.
    """
    sized = sized_documents(docs)
    q = quotas(sized)
    taken = mixed_segments(sized, q).groupBy("rid").agg(F.sum(F.col("end_word") - F.col("first_word")).alias("taken"))
    return _numbered(sized, q).join(taken, "rid", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it, with its columns as they are.

    Only one document of a source can be cut by its quota; it is taken whole if at least half of
    its words are in the mix, else not.  Rows of size 0 aren't taken.
    """
    columns = docs.columns
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*[docs[f"`{c}`"] for c in columns]).alias("row")), "numbered")
    sized = sized_documents(numbered.select("rid", "row.doc_id", "row.source", "row.text"), "rid")
    copies = (mixed_segments(sized, quotas(sized)).groupBy("rid", "repeat").agg(F.sum(F.col("end_word") - F.col("first_word")).alias("words"))
              .join(sized.select("rid", "size"), "rid").where("2 * words >= size").groupBy("rid").agg(F.count("*").cast("int").alias("copies")))
    whole = numbered.join(copies, "rid")
    return whole.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
