"""What fails only on larger tables: copies of blocks, many blocks, ties over blocks."""

import numpy as np
import pytest

from spark_marts.llm import common, substrings, topk


def brute(ids, v, asked, k=5):
    whole = [[int(np.floor(256 * x)) for x in row] for row in v]
    out = []
    for q in asked:
        mine = whole[ids.index(q)]
        best = sorted((-max(topk.MIN, min(topk.MAX, sum(a * b for a, b in zip(mine, w, strict=True)))), i) for i, w in zip(ids, whole, strict=True) if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("size", [0.2, 1e4, 1e7])
def test_top_k_over_many_blocks_and_both_rounds(spark, monkeypatch, size):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 4 * 8 * 16)  # 16 vectors a row block
    monkeypatch.setattr(topk, "LEAST_ROWS", 1)
    monkeypatch.setattr(topk, "SPREAD", 1)
    rng = np.random.default_rng(3)
    v = rng.normal(0, size, (400, 8))
    v[100:260] = v[7]  # a vector that many rows share
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    again = [(i, [float(x) for x in r + 1e-3]) for i, r in list(enumerate(v))[::9] for _ in range(4)]  # the smaller one counts
    frame = spark.createDataFrame(rows + again, "vec_id long, embedding array<double>").repartition(5)
    asked = list(range(0, 400, 7))
    blocks, n, width = topk.vector_blocks(frame, frame.limit(0))
    assert n > topk.ROUND and width == 8 and blocks.count() == n
    got = topk.top_k(frame, spark.createDataFrame([(i,) for i in [*asked, 900, None]], "vec_id long"))
    assert sorted(tuple(r) for r in got.collect()) == brute(list(range(400)), v, asked)


@pytest.mark.parametrize(("size", "kind"), [(40, np.float32), (1e5, np.float64), (1e11, None)])
def test_tiles_of_every_kind_find_what_a_full_product_finds(size, kind):
    rng = np.random.default_rng(4)
    x, q_ids = np.floor(rng.normal(0, size, (2500, 12))), np.arange(0, 2500, 300)
    x[500:1500] = x[0]
    search = topk.Search(q_ids, x[q_ids], np.arange(2500), x, 3)
    assert search.kind is kind
    i, j, score = search.best(slice(0, 512), np.full(len(q_ids), topk.MIN))
    want = [(a, b, s) for a, q in enumerate(q_ids.tolist()) for s, b in sorted(((min(topk.MAX, max(topk.MIN, sum(int(m) * int(n) for m, n in zip(x[q], r, strict=True)))), b) for b, r in enumerate(x) if b != q), key=lambda e: (-e[0], e[1]))[:3]]
    assert sorted(zip(i.tolist(), j.tolist(), score.tolist(), strict=True)) == sorted(want)


def test_query_copies_of_a_large_table_stay_below_it(spark):
    """A query block is copied once a row block: 300,000 vectors of 64 components, one in 50 asked for."""
    few = spark.range(300_000).selectExpr("id AS vec_id", "transform(sequence(1, 64), j -> float(((id * j) % 97) / 97.0 - 0.5)) AS embedding")
    blocks, n, _ = topk.vector_blocks(few, few.where("vec_id % 50 = 0").select("vec_id"))
    asked = blocks.selectExpr("sum(octet_length(q_matrix)) AS q", "sum(octet_length(r_matrix)) AS r").first()
    assert asked.r == 300_000 * 64 * 2 and asked.q * n < 2 * asked.r


def removed(docs):
    """Plain Python: of every (doc_id, text) the bytes in no 50-byte string that a smaller doc_id has too."""
    firsts: dict = {}
    for i, t in docs:
        for at in range(len(t) - 49):
            firsts[t[at : at + 50]] = min(i, firsts.get(t[at : at + 50], i))
    out = []
    for i, t in docs:
        gone = bytearray(len(t))
        for at in range(len(t) - 49):
            if firsts[t[at : at + 50]] < i:
                gone[at : at + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), sum(1 for a, b in zip(b"\0" + gone, gone, strict=False) if b and not a), kept))
    return sorted(out)


@pytest.mark.parametrize("part_bytes", [500, 1 << 20])
def test_substrings_by_parts_of_shards(spark, monkeypatch, part_bytes):
    """Blocks and shards grow beyond MANY, and a shard has several parts."""
    for module in (common, substrings):
        monkeypatch.setattr(module, "BLOCK_BYTES", 800)
    monkeypatch.setattr(substrings, "MANY", 2)
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    shared = [word(int(n)) for n in rng.integers(40, 200, 6)]
    docs = [(int(i) * 10_000_000_000, "".join(shared[j] + word(20) for j in rng.integers(0, 6, 3))) for i in rng.permutation(40) - 10]
    docs += [(7, docs[0][1]), (7, docs[0][1]), (8, docs[1][1]), (-5, docs[1][1]), (9, "x" * 300), (11, "x" * 70), (12, shared[0] * 2)]
    blocks, shards, subs = substrings.dealt(sum(len(t) for _, t in docs))
    assert blocks > 2 and shards > 2 and subs > 1
    got = substrings.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), part_bytes)
    assert sorted((*r[:4], bytes(r[4])) for r in got.collect()) == removed([(i, t.encode()) for i, t in docs])


def test_copies_go_whole_and_send_nothing(spark):
    rng = np.random.default_rng(8)
    texts = ["".join(rng.choice(list("abcdefgh "), 120)) for _ in range(4)]
    docs = [(i, texts[i % 4]) for i in (5, -3, 2, 8, 9, 1, 12, 13)]
    docs += [(13, texts[1]), (20, texts[0] + "end"), (21, "short"), (22, "short"), (None, texts[2])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = frame.where("doc_id IS NOT NULL AND length(text) >= 50").selectExpr("unhex(sha2(text, 256)) AS sha", "doc_id")
    assert {int.from_bytes(r.payload[32:], "big", signed=True) for r in substrings.copies_of(rows, 3).collect()} == {1, 5, 9, 12, 13}
    got = {(r.doc_id, r.n_bytes): (r.n_removed, r.n_spans, bytes(r.kept)) for r in substrings.dedup_substrings(frame).collect() if r.doc_id is not None}
    want = {(i, n): rest for i, n, *rest in removed([(i, t.encode()) for i, t in docs if i is not None])}
    assert {k: list(v) for k, v in got.items()} == want


def test_messages_of_a_large_corpus_are_few_and_answered_at_once():
    """Every block of 4 MB sent every shard of 4 MB a message, and each was held against the whole shard."""
    blocks, shards, subs = substrings.dealt(10 << 30)
    assert blocks * shards < 1_000_000 and shards * subs >= common.blocks_for(10 << 30)
    rng = np.random.default_rng(6)
    sizes = rng.integers(1, 30, 5000)
    begins = np.append(0, np.cumsum(sizes))
    least = rng.integers(0, 50, begins[-1])
    piece, doc = rng.integers(0, 5000, 40_000), rng.integers(0, 50, 40_000)
    spans, come = substrings.going(least, begins, piece, np.arange(40_000), np.full(40_000, 100), doc)
    got = {(int(c), int(x)) for c, (r, a, b) in zip(come, spans, strict=True) for x in range(a - 100, b - 99) if r == c}
    assert got == {(i, x) for i in range(40_000) for x in range(sizes[piece[i]]) if least[begins[piece[i]] + x] < doc[i]}


@pytest.mark.parametrize("values", [[5], [-(1 << 63), (1 << 63) - 1, 0], [300, 7, 7], list(range(70_000))])
def test_numbers_come_back_from_few_bytes(values):
    a = np.array(values, np.int64)
    assert (substrings.long(substrings.short(a)) == a).all() and len(substrings.short(a)) <= 9 + 8 * len(a)
