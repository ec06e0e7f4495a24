"""Operator 2: exact n-gram Jaccard join by grouped prefixes.

1. Documents become sets of hashed k-word shingles.  Whole slices of documents send their distinct
   shingle hashes to hash buckets as packed arrays; a bucket counts in how many documents each
   shingle occurs and answers every slice with the shingles that others have too.
2. Each set is ordered by (frequency class, hash), rarest first.  Shingles no other document has
   stand first, cannot match, and are only counted.  Two sets that reach the threshold share a
   shingle in their prefixes; most documents have nothing but unshared shingles there and are done.
3. Documents with equal sets are one node.  Nodes with the same size and the same prefix are one
   group; postings and pairs are between groups, filtered by size and by position.
4. Linear work first: for every prefix shingle each group is paired with one centre of its posting
   list and each member with its group's representative; verified pairs give components.  Then all
   group pairs that still join two components are expanded to members and verified, so no link
   that matters to a component is missed, and a large cluster of near copies is not multiplied out.

Exactness: every candidate is verified by its exact intersection size.  The only error is that of
the hashes (64 bits for sets, 48 bits when two sets are compared).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textops as T
from ledgerlens.llm.common import bucket_count, ship_code, small, stored, text_bytes
from ledgerlens.llm.components import connected_components

#: Similarity of at least 75 / 100, on shingles of five words.
THRESHOLD_PCT = 75
SHINGLE_WORDS = 5
#: Shingles in a counting bucket, about; bounds a task's memory.
BUCKET_SHINGLES = 1_500_000

_SENT = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), ("rows", pa.binary()), ("hashes", pa.binary()),
                   ("meta", pa.binary())])
_ANSWER = pa.schema([("slice", pa.int64()), ("rows", pa.binary()), ("hashes", pa.binary()), ("freq", pa.binary()),
                     ("meta", pa.binary())])
_SETS = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("version", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()),
                   ("d2", pa.int64()), ("unshared", pa.int64()), ("tokens", pa.list_(pa.int64()))])
_META = np.dtype([("doc_id", "<i8"), ("null", "<i8"), ("version", "<i8"), ("n", "<i8"), ("d1", "<u8"), ("d2", "<u8")])


def _pack48(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(b, dtype=np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _sender(k: int, n_buckets: int):
    """Slices to packed messages: to each bucket its hashes, and the slice's own document facts."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 24
        for batch in batches:
            for rows, buf, offsets in T.cut_slices(batch, "text"):
                at += 1
                start, end, first = T.word_spans(buf, offsets)
                words = T.span_hashes(T.prefix_sums(T.lower_ascii(buf)), start, end)
                h, doc = T.distinct_by_doc(*T.shingle_hashes(words, first, k))
                meta = np.zeros(rows.num_rows, dtype=_META)
                ids = rows.column("doc_id")
                meta["null"] = ids.is_null().to_numpy(zero_copy_only=False)
                meta["doc_id"] = ids.fill_null(0).to_numpy()
                meta["version"] = rows.column("version").to_numpy()
                meta["n"] = np.bincount(doc, minlength=rows.num_rows)
                sums = np.zeros(len(h) + 1, dtype=np.uint64)
                ends = np.cumsum(meta["n"])
                for d, salt in (("d1", 0x51ED27), ("d2", 0x2545F4914F6CDD1D)):
                    np.cumsum(T.mix(h ^ np.uint64(salt)), out=sums[1:])
                    meta[d] = sums[ends] - sums[ends - meta["n"]]
                low = h & np.uint64((1 << 48) - 1)
                bucket = ((h >> np.uint64(48)) * np.uint64(n_buckets) >> np.uint64(16)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket, low, doc = bucket[order], low[order], doc[order].astype("<u2")
                cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
                ends = np.r_[cuts[1:], len(bucket)]
                out = [(int(bucket[i]), at, doc[i:j].tobytes(), _pack48(low[i:j]), None) for i, j in zip(cuts, ends)]
                out.append((int(at * 2654435761 % n_buckets), at, b"", b"", meta.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _SENT)], schema=_SENT)

    return send


def _count(table: pa.Table) -> pa.Table:
    """One bucket: how many documents have each hash; answers with the hashes that two or more have."""
    rows, hashes = table.column("rows").to_pylist(), table.column("hashes").to_pylist()
    parts = [_unpack48(b) for b in hashes]
    h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    ordered = np.sort(h)
    edge = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(h) else np.zeros(0, np.int64)
    count = np.diff(np.r_[edge, len(h)])
    many = count > 1
    keys = ordered[edge][many]
    level = np.minimum(255, np.floor(8 * np.log2(np.maximum(count[many], 1)))).astype(np.uint8)
    out_rows, out_hashes, out_freq = [], [], []
    for r, p in zip(rows, parts):
        i = np.minimum(np.searchsorted(keys, p), max(len(keys) - 1, 0))
        hit = keys[i] == p if len(keys) else np.zeros(len(p), dtype=bool)
        out_rows.append(np.frombuffer(r, "<u2")[hit].tobytes())
        out_hashes.append(_pack48(p[hit]))
        out_freq.append(level[i[hit]].tobytes() if len(keys) else b"")
    arrays = [table.column("slice").combine_chunks(), pa.array(out_rows, pa.binary()), pa.array(out_hashes, pa.binary()),
              pa.array(out_freq, pa.binary()), table.column("meta").combine_chunks()]
    answer = pa.Table.from_arrays(arrays, schema=_ANSWER)
    return answer.filter(pa.array([bool(a) or m is not None for a, m in
                                   zip(out_rows, table.column("meta").to_pylist())], pa.bool_()))


def required(n: np.ndarray, pct: int) -> np.ndarray:
    """Least intersection with any set that may match a set of size n: ceil(pct * n / 100)."""
    return -(-pct * n // 100)


def _assembler(pct: int):
    """One slice: its documents' shared shingles in order; kept only where the prefix has any."""

    def assemble(table: pa.Table) -> pa.Table:
        meta = np.frombuffer(next(m for m in table.column("meta").to_pylist() if m is not None), _META)
        doc = np.frombuffer(b"".join(table.column("rows").to_pylist()), "<u2").astype(np.int64)
        h = _unpack48(b"".join(table.column("hashes").to_pylist()))
        freq = np.frombuffer(b"".join(table.column("freq").to_pylist()), np.uint8)
        order = np.lexsort((h, freq, doc))
        h, doc = h[order].astype(np.int64), doc[order]
        shared = np.bincount(doc, minlength=len(meta))
        unshared = meta["n"] - shared
        ends = np.cumsum(shared)
        live = (shared > 0) & (unshared < meta["n"] - required(meta["n"], pct) + 1)
        keep = live[doc]
        offsets = np.r_[0, np.cumsum(np.where(live, shared, 0))].astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h[keep]))
        rid = (table.column("slice")[0].as_py() << 16) + np.arange(len(meta))
        return pa.Table.from_arrays(
            [pa.array(rid), pa.array(meta["doc_id"], mask=meta["null"] != 0), pa.array(meta["version"]), pa.array(meta["n"]),
             pa.array(meta["d1"].astype(np.int64)), pa.array(meta["d2"].astype(np.int64)), pa.array(unshared), tokens],
            schema=_SETS)

    return assemble


_DDL = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {_DDL[f.type]}" for f in schema)


def shingle_sets(docs: DataFrame, k: int = SHINGLE_WORDS, pct: int = THRESHOLD_PCT) -> DataFrame:
    """A row for each document: rid, doc_id, version (hash of the text), n (set size), d1 and d2 (digest), unshared, tokens.

    tokens: the shingles that other documents have as well, rarest first, where the prefix holds
    any; else empty.  Stored, so that later steps read it more than once.
    """
    spark = docs.sparkSession
    ship_code(spark)
    n_buckets = min(1 << 16, bucket_count(spark, text_bytes(docs) // 6, BUCKET_SHINGLES))
    version = F.xxhash64(F.coalesce("text", F.lit(""))).alias("version")
    sent = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", version).mapInArrow(_sender(k, n_buckets), _ddl(_SENT))
    answers = sent.groupBy("bucket").applyInArrow(_count, _ddl(_ANSWER))
    return stored(answers.groupBy("slice").applyInArrow(_assembler(pct), _ddl(_SETS)), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The (a, b) pairs whose sets reach the threshold, by exact intersection."""
    left = sets.select(F.col("rid").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb"))
    return (pairs.join(left, "a").join(right, "b")
            .where(common * (100 + pct) >= pct * (F.col("na") + F.col("nb"))).select("a", "b"))


def _may_match(pct: int) -> Column:
    """Size and position filter on postings x and y of one shingle: what is left can still suffice."""
    need = F.ceil(F.lit(pct) * (F.col("x.n") + F.col("y.n")) / F.lit(100 + pct))
    return (F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) >= need)


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("x.gid", "y.gid").alias("a"), F.greatest("x.gid", "y.gid").alias("b")).distinct()


def linked_documents(docs: DataFrame, k: int = SHINGLE_WORDS, pct: int = THRESHOLD_PCT, grouped: bool = False) -> DataFrame:
    """doc_id, version (hash of the text), n_shingles, component_id, and component if ``grouped``, for every row of ``docs`` (columns doc_id and text are read).

    Two documents link when 100 * |A and B| >= pct * |A or B| on their sets of distinct k-word
    shingles (words split at ASCII white space, A-Z lower-cased; a text of 1 to k-1 words has its
    whole sequence as one shingle).  component_id is the smallest doc_id reachable by links, the
    document's own included.  Null, empty and blank texts have no shingles and link with nothing.
    Repeated doc_ids are rows of their own; a null doc_id is never the smallest but among nulls.
    Texts are read whole; other columns are ignored.  An empty table gives an empty table.
    component numbers the groups (groups of versions can share their smallest doc_id); it is null
    where a document shares no shingle.
    """
    sets = shingle_sets(docs, k, pct)
    live = sets.where(F.size("tokens") > 0)
    copies = stored(live.groupBy("n", "d1", "d2").agg(F.min("rid").alias("rep"), F.min("doc_id").alias("first_id")), "copies")
    need = F.ceil(F.lit(pct) * F.col("n") / F.lit(100))
    prefix = F.slice("tokens", 1, (F.col("n") - need + 1 - F.col("unshared")).cast("int"))
    nodes = stored(live.join(copies.select(F.col("rep").alias("rid")), "rid", "left_semi")
                   .select("rid", "n", "unshared", "tokens", prefix.alias("prefix"),
                           F.xxhash64("n", "unshared", prefix).alias("g1"), F.hash(prefix).alias("g2")), "nodes")
    groups = nodes.groupBy("n", "unshared", "g1", "g2").agg(F.min("rid").alias("gid"))
    members = stored(nodes.drop("tokens").join(groups, ["n", "unshared", "g1", "g2"]), "members")
    postings = stored(members.where("rid = gid").select("gid", "n", "unshared", F.posexplode("prefix").alias("i", "token"))
                      .select("token", "gid", "n", (F.col("unshared") + F.col("i")).alias("pos")), "postings")

    linked = members.where("rid <> gid").select(F.col("gid").alias("a"), F.col("rid").alias("b"))
    for salt in (1, 2):
        centre = F.struct((F.col("n") - F.col("pos")).alias("left"), F.xxhash64("gid", F.lit(salt)).alias("h"), "gid", "n", "pos")
        centres = postings.groupBy("token").agg((F.max(centre) if salt == 1 else F.min_by(centre, "gid")).alias("c"), F.count("*").alias("m"))
        centres = centres.where("m > 1").select("token", "c.gid", "c.n", "c.pos")
        linked = linked.unionByName(_pairs(postings.alias("x").join(centres.alias("y"), "token")
                                           .where("x.gid <> y.gid").where(_may_match(pct))))
    edges = stored(_verified(linked.distinct(), nodes, pct), "links")
    component = stored(connected_components(edges), "component")

    # every group pair that may still join two components, expanded to members
    placed = (members.join(component, members["rid"] == component["node"], "left")
              .select("gid", "rid", F.coalesce("component", "rid").alias("component")))
    spread = placed.groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    placed = stored(placed, "placed")
    sided = stored(postings.join(spread, "gid"), "sided")
    apart = (F.col("x.low") != F.col("y.low")) | (F.col("x.low") != F.col("x.high")) | (F.col("y.low") != F.col("y.high"))
    across = _pairs(sided.alias("x").join(sided.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.gid") < F.col("y.gid"))
                                          & apart & _may_match(pct)))
    within = spread.where("low <> high").select(F.col("gid").alias("a"), F.col("gid").alias("b"))
    x = placed.select(F.col("gid").alias("ga"), F.col("rid").alias("a"), F.col("component").alias("ca"))
    y = placed.select(F.col("gid").alias("gb"), F.col("rid").alias("b"), F.col("component").alias("cb"))
    expanded = (across.unionByName(within).select(F.col("a").alias("ga"), F.col("b").alias("gb")).join(x, "ga").join(y, "gb")
                .where("ca <> cb and a <> b").select("a", "b"))
    more = stored(_verified(expanded, nodes, pct), "links")
    component = connected_components(edges.unionByName(more))

    found = (copies.join(component, copies["rep"] == component["node"], "left")
             .select("n", "d1", "d2", "first_id", F.coalesce("component", "rep").alias("component")))
    ids = found.groupBy("component").agg(F.min("first_id").alias("component_id"))
    group = ["component"] if grouped else []
    classes = stored(found.join(ids, "component").select("n", "d1", "d2", "component_id", *group), "classes")
    rows = sets.select("doc_id", "version", "n", "d1", "d2", (F.size("tokens") > 0).alias("live"))
    columns = ["doc_id", "version", F.col("n").alias("n_shingles")]
    joined = rows.where("live").join(classes, ["n", "d1", "d2"]).select(*columns, "component_id", *group)
    alone = [F.lit(None).cast("long").alias(c) for c in group]
    return joined.unionByName(rows.where("not live").select(*columns, F.col("doc_id").alias("component_id"), *alone))


def similar_documents(docs: DataFrame, k: int = SHINGLE_WORDS, pct: int = THRESHOLD_PCT) -> DataFrame:
    """doc_id, n_shingles, component_id: ``linked_documents`` without the texts' hashes."""
    return linked_documents(docs, k, pct).drop("version")


def keep_one_of_each_group(docs: DataFrame, k: int = SHINGLE_WORDS, pct: int = THRESHOLD_PCT) -> DataFrame:
    """The rows of ``docs`` of which no earlier near copy exists, with their columns as they are.

    Of each group of linked documents the one with the smallest doc_id stays (null ids come last, of
    equal ids the smallest hash of the text); of rows that repeat doc_id and text, one.  Rows with one
    doc_id and different texts are versions of one document and are judged each by its own links.
    """
    linked = stored(linked_documents(docs, k, pct, grouped=True), "linked")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "version")
    first = stored(linked.where("component is not null").groupBy("component").agg(F.min(place).alias("first")), "first_places")
    gone = stored(linked.join(small(first), "component").where(place != F.col("first")).select("doc_id", "version").distinct(), "gone")
    repeated = stored(linked.groupBy("doc_id", "version").agg(F.count("*").alias("m")).where("m > 1").select("doc_id", "version"), "repeated")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = rows.withColumn("version", F.xxhash64(F.coalesce("row.text", F.lit(""))))

    def same(keys: DataFrame) -> Column:
        return F.col("row.doc_id").cast("long").eqNullSafe(keys["doc_id"]) & (rows["version"] == keys["version"])

    kept = rows.join(small(gone), same(gone), "left_anti")
    if repeated.isEmpty():
        return kept.select("row.*")
    many = small(repeated)
    once = kept.join(many, same(repeated), "left_semi").groupBy("row.doc_id", "version").agg(F.first("row").alias("row"))
    return kept.join(many, same(repeated), "left_anti").select("row.*").unionByName(once.select("row.*"))
