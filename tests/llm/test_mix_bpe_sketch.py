"""Operators 1, 4 and 8, and the pipeline, against brute force and the library."""

import hashlib
import os

import numpy as np
import pytest

import corpus_pipeline
from ledgerlens.llm import bpe, fingerprints, mixing
from ledgerlens.llm.common import stored
from ledgerlens.llm.queries import tokenizer_path

from .conftest import prose


def key(x):
    return str(tuple(x))


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50.0, 100.0, 150.0]
    assert mixing.targets([10, 0, 1000, 5], [1, 2, 3, 1]) == [30.0, 0.0, 970.0, 15.0]
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0.0, 0.0]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    assert sorted(mixing.permuted(np.arange(n), n, 3).tolist()) == list(range(n))


def test_splitting_tree():
    blocks = np.array([5, 0, 17, 300])
    whole = list(mixing.shard_draws(blocks, 7, 0, 7))
    assert [s for s, _, _ in whole] == list(range(7))
    assert (sum(c for _, _, c in whole) == blocks).all()
    at = np.zeros(4, int)
    for shard, start, count in whole:
        assert (start == at).all()
        at += count
        (_, start_, count_), = mixing.shard_draws(blocks, 7, shard, shard + 1)
        assert (start_ == start).all() and (count_ == count).all()


def test_mix(docs, rows, empty):
    got = mixing.document_mix(docs).collect()
    sizes = {}
    for r in rows:
        sizes.setdefault(r[3], []).append(len((r[1] or "").encode().split()))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = mixing.targets([sum(sizes[s]) for s in order], [mixing.WEIGHTS[i % 3] for i in range(len(order))])
    assert len(got) == len(rows) and all(r.taken <= 3 * r.size for r in got)
    taken = {}
    for r in got:
        taken.setdefault((r.source_size, r.target), []).append(r.taken)
    assert sorted(taken) == sorted((sum(sizes[s]), t) for s, t in zip(order, wanted))
    assert all(abs(sum(v) - t) <= 1 for (_, t), v in taken.items())
    assert sorted(map(key, got)) == sorted(map(key, mixing.document_mix(docs).collect()))
    assert mixing.document_mix(empty).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixing.mixed_documents(empty).count() == 0
    copies = {}
    for r in mixed.collect():
        copies[(r.doc_id, r.text)] = copies.get((r.doc_id, r.text), 0) + 1
    assert set(copies) <= {r[:2] for r in rows}


def test_every_block_is_dealt_once(docs):
    sized = mixing.sized_documents(docs)
    q = mixing.quotas(sized)
    q = mixing.Quotas(q.sources, q.sizes, q.targets, q.take, 64, 9)
    blocks = mixing.dealt_blocks(sized, q).collect()
    assert sorted((r.source_no, r.block) for r in blocks) == [(s, b) for s, n in enumerate(q.blocks) for b in range(n)]
    assert {r.shard for r in blocks} == set(range(9))
    for shard in range(9):
        mine = sorted(r.slot for r in blocks if r.shard == shard)
        assert mine == list(range(len(mine)))
    words = {}
    for r in mixing.mixed_segments(sized, q).collect():
        assert 0 <= r.first_word < r.end_word
        words.setdefault((r.rid, r.repeat), []).append((r.first_word, r.end_word))
    for spans in words.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_bpe(docs, rows, empty):
    path = tokenizer_path()
    tok = bpe.tokenizer(path)
    want = []
    for r in rows:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = bpe.encoded_documents(docs, path).collect()
    assert sorted(map(key, [tuple(r)[:4] for r in got])) == sorted(map(key, want))
    assert sum(r.seams for r in got) > 10
    assert bpe.encoded_documents(empty, path).count() == 0


def test_seams_are_repaired_or_given_up():
    path = tokenizer_path()
    (left, mid, right), = bpe.repair(path, [b"before middle after"])
    ids = [np.frombuffer(x, "<u2").tolist() for x in (left, mid, right)]
    assert ids == [bpe.tokenizer(path).encode(w, add_special_tokens=False).ids for w in ("before", "middle", "after")]


def test_equal_passages_have_equal_chunks():
    passage = " ".join(prose(5, 2000)).encode()
    texts = [b"first text " + passage, b"quite another beginning of it " + passage + b" end"]
    found = []
    for t in texts:
        chunks, items, counts, _ = bpe._layout(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        found.append(set(chunks))
        assert counts.tolist() == [len(items)]
    assert len(found[0] & found[1]) >= len(found[0]) - 2


def test_whole_documents_are_encoded_where_seams_disagree(docs, monkeypatch):
    path = tokenizer_path()
    monkeypatch.setattr(bpe, "repair", lambda path, seams: [None] * len(seams))
    table = bpe._assembler(path)
    assert table is not None  # the patched function runs on the driver only: the fallback itself is below
    batch = docs.select("doc_id", "text").toArrow().to_batches()
    out = [r for b in bpe._whole(path)(iter(batch)) for r in b.to_pylist()]
    assert len(out) == docs.count() and all(len(r["ids_sha256"]) == 32 for r in out)


def test_fingerprints(docs, rows, empty):
    order = sorted([r[:2] for r in rows if r[0] not in (None, 2)])
    texts = [t or "" for _, t in order]
    n = len(texts)
    changed = [fingerprints.edited(texts[i], texts[(i + 1) % n]) for i in range(n)]
    got = {r.doc_id: r for r in fingerprints.document_fingerprints(docs.where("doc_id <> 2")).collect()}
    sets = [fingerprints.piece_digests(*fingerprints._joined(x)) for x in (texts, changed)]

    def like(i, a, b, j):
        x, y = set(a[0][a[1] == i].tolist()), set(b[0][b[1] == j].tolist())
        return len(x & y) / len(x | y) if x | y else 1.0

    for i, (doc, _) in enumerate(order):
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(changed[i].encode()).hexdigest())
        assert r.near_edited == pytest.approx(like(i, sets[0], sets[1], i)) and r.near_next == pytest.approx(like(i, sets[0], sets[0], (i + 1) % n))
    assert got[7].fingerprint == got[8].fingerprint and got[1].fingerprint == got[3].fingerprint != got[9].fingerprint
    assert fingerprints.document_fingerprints(empty).count() == 0
    assert len(fingerprints.document_fingerprints(docs).collect()) == len(rows)


def test_fingerprints_with_more_text_than_parts(docs, monkeypatch):
    """A bound on the parts makes them longer and changes no row."""
    want = sorted(map(str, fingerprints.document_fingerprints(docs).collect()))
    monkeypatch.setattr(fingerprints, "PART_BYTES", 100)
    many = sorted(map(str, fingerprints.document_fingerprints(docs).collect()))
    monkeypatch.setattr(fingerprints, "MAX_PARTS", 2)
    assert want == many == sorted(map(str, fingerprints.document_fingerprints(docs).collect()))


def test_peeling_recovers_differences():
    rng = np.random.default_rng(0)
    shared, a, b = rng.integers(1, 1 << 62, (3, 40)).astype(np.uint64)
    x, y = fingerprints.Sketches(1, 300, 0), fingerprints.Sketches(1, 300, 0)
    zero = np.zeros(80, np.int64)
    x.add(np.r_[shared, a], zero)
    y.add(np.r_[shared, b], zero)
    x.subtract(y)
    done, left, right = x.peel()
    assert done.all() and left.tolist() == [40] and right.tolist() == [40]


def test_pipeline_stages(spark, docs):
    base = docs.select("doc_id", "text", "lang", "source", "n_chars")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    now, seen = base, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stored(stage(spark, now, ""), "test_stage")
        seen.append(now.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == base.columns
    assert 0 < seen[2] <= seen[1] <= seen[0] < base.count() and seen[4] == seen[3]


def test_pipeline_on_an_empty_table(spark, docs):
    now = docs.select("doc_id", "text", "lang", "source", "n_chars").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, ""), "test_empty")
    assert now.count() == 0


def test_tokenizer_is_not_copied():
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    assert not any(f == "word_bpe_49k.json" for _, _, names in os.walk(root) for f in names)
