"""Cases that earlier rounds got wrong: large scores, long toxic texts, clashing names, frames of other origin."""

import time

import numpy as np
import pytest

from spark_marts.llm import neardup, topk, toxicity


@pytest.mark.parametrize("size", [1e4, 1e6, 1e7, 3e8])
def test_top_k_is_exact_at_every_magnitude(spark, size):
    rng = np.random.default_rng(int(size))
    rows = [(i, [float(x) for x in size + rng.normal(0, 3, 8)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    use = [[int(np.floor(256 * x)) for x in v] for _, v in rows]
    want = []
    for q in range(60):
        best = sorted((-min(2**63 - 1, sum(a * b for a, b in zip(use[q], use[i], strict=True))), i) for i in range(60) if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in topk.top_k(frame, frame.select("vec_id")).collect()) == want


def test_the_second_half_is_scored_for_few_rows():
    rng = np.random.default_rng(0)
    q, x = np.floor(rng.normal(0, 256, (20, 16))), np.floor(rng.normal(0, 256, (2000, 16)))
    score = q @ x.T
    cut = np.sort(score, axis=1)[:, -5].astype(np.int64)
    rows, total, reach = topk.resolved(q, x, 8, cut, np.ones(score.shape, bool))
    assert len(rows) < 1500 and (total == score[:, rows]).all()
    assert (reach.sum(axis=1) == (score >= cut[:, None]).sum(axis=1)).all()


def test_toxic_hits_of_a_long_text_take_linear_time():
    lexicon = toxicity.Lexicon({"vile": 1.0, "foul$": 2.0}, ("not vile", "vile green"), (1.0, 0.0, 0.0))
    assert lexicon.hits("vile foul not vile vile green") == 3.0
    text = "vile not vile foul " * 55_000
    start = time.time()
    assert lexicon.hits(text) == 55_000 * 3.0
    assert time.time() - start < 20


def test_near_dup_stage_with_clashing_columns(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(30)), 1, 2, 3) for i in (4, 2)] + [(9, "other", 1, 2, 3), (None, "x", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_id int, component_id int, rep int")
    out = neardup.drop_near_duplicates(docs)
    assert out.columns == docs.columns and sorted((r.doc_id for r in out.collect()), key=str) == [2, 9, None]


def test_lm_scores_do_not_go_by_the_layout(spark, monkeypatch):
    from spark_marts.llm import lm

    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join(rng.choice(words, 40))) for i in range(150)] + [(7, "a copy"), (7, "a copy"), (None, "no id"), (200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(lm, "blocks_for", lambda size: 8)  # several blocks and an average of them
    scores = [sorted(((r.doc_id, r.n_tokens, r.score) for r in lm.score_documents(docs.repartition(n)).collect()), key=str) for n in (1, 4)]
    assert scores[0] == scores[1]


def _all_texts():
    rng = np.random.default_rng(11)
    words = "The don't Été (x_y) 12,345 naïve we'LL <|x|> 東京 a.b... straße µm".split()
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 5, 400, 3000, 900, 2048, 7000, 33)]
    return [*enumerate(texts), (100, None), (101, ""), (3, texts[3])]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", None])
def test_packed_ids_are_the_tokenizers(spark, name):
    """Every id of every text lies in one piece at its place; sequences have no gaps; by any vocabulary."""
    from pathlib import Path
    from zlib import crc32

    import public_tokenizers
    from tokenizers import Tokenizer

    from spark_marts.llm import packing

    file = public_tokenizers.path(name) if name else next(str(f) for f in sorted(Path(public_tokenizers.path("word_bpe_49k.json")).parent.glob("*.json")) if f.name != "word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(file)
    rows = _all_texts()
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), file).collect()
    want = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        assert p.ids_crc32 == crc32(want[p.doc_id][p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(want[p.doc_id])
    for i, ids in want.items():
        times = 2 if i == 3 else 1
        covered = np.zeros(len(ids), int)
        for p in by_doc[i]:
            covered[p.start : p.start + p.length] += 1
        assert (covered == times).all()
    for s in {p.sequence_id for p in pieces}:
        at = 0
        for p in sorted((p for p in pieces if p.sequence_id == s), key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048


def _cut_by_brute_force(rows):
    first: dict = {}
    for i, t in sorted(rows):
        for j in range(len(t) - 49):
            first.setdefault(t[j : j + 50], i)
    out = {}
    for i, t in rows:
        gone = bytearray(len(t))
        for j in range(len(t) - 49):
            if first[t[j : j + 50]] < i:
                gone[j : j + 50] = b"\1" * 50
        out[i] = bytes(c for c, g in zip(t, gone, strict=True) if not g)
    return out


def test_substrings_of_long_runs_and_one_hot_anchor(spark):
    """Runs of one, two and three characters, and a 40-byte phrase that every document follows with other words."""
    from spark_marts.llm import substrings

    rng = np.random.default_rng(5)
    word = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8))
    phrase, tail = word(40), word(30)
    rows = [(1, b"a" * 30_000), (2, b"x" * 20 + b"a" * 90_000 + b"y" * 49), (3, b"ab" * 20_000), (4, b"ba" * 9_000 + word(200)), (5, b"abc" * 7_000)]
    rows += [(6, b"cab" * 20 + b"a" * 50 + b"y" * 50), (7, b"y" * 49 + b"a" * 49)]
    rows += [(10 + i, word(int(rng.integers(0, 90))) + phrase + (word(12) if i % 3 else tail) + word(60)) for i in range(300)]
    frame = spark.createDataFrame([(i, t.decode()) for i, t in rows], "doc_id long, text string").repartition(3)
    got = {r.doc_id: bytes(r.kept) for r in substrings.dedup_substrings(frame, 4_000).collect()}
    assert got == _cut_by_brute_force(rows)


def test_a_worker_drops_what_another_stage_kept(spark):
    """Packing's words stay in a reused worker from task to task, but not through the next operator's tasks."""
    from public_tokenizers import path

    from spark_marts.llm import packing
    from spark_marts.llm.common import keep_rows

    def held(batches):
        import gc

        import pyarrow as pa

        for _ in batches:
            pass
        yield pa.RecordBatch.from_pydict({"n": [sum(type(x).__name__ in ("Tokens", "WordHashes") for x in gc.get_objects())]})

    docs = spark.createDataFrame([(i, f"some words of text {i} and more of them") for i in range(40)], "doc_id long, text string").repartition(8)
    count = lambda: max(r.n for r in spark.range(8, numPartitions=8).mapInArrow(held, "n long").collect())
    packing.pack(docs, path("word_bpe_49k.json")).collect()
    assert count() >= 1
    for _ in range(6):  # every worker gets a task
        keep_rows(docs, lambda texts: [True] * len(texts)).collect()
        neardup.drop_near_duplicates(docs, shingle=5).collect()
    packing.pack(docs, path("word_bpe_49k.json")).collect()
    assert count() == 1
    keep_rows(docs, lambda texts: [True] * len(texts)).collect()


def test_lm_ids_of_many_texts_are_those_of_their_words():
    """One id a word wherever it stands, whatever its length; its class is that of its spelling; other words have other ids."""
    from zlib import crc32

    from spark_marts.llm import lm

    rng = np.random.default_rng(2)
    words = [b"a", b"A", b"ab", b"abc\x00", b"abc", b"abcdefg", b"abcdefg\x0f", b"abcdefgh", b"abcdefgh\x00", b"12345678" * 2, b"12345678" * 8, b"12345678" * 9, "é東 \u0085京".encode(), b"\x1c\x00"]
    words += [bytes(rng.integers(97, 123, n).tolist()) for n in range(1, 140)]
    spaces = [" ", "\t", "\n", "\x0b", "\x0c", "\r", " \n "]
    texts = ["", " ", *("".join(rng.choice(spaces) + words[i].decode() for i in rng.integers(0, len(words), n)) for n in rng.integers(0, 40, 700)), "tail ", "x" * 9]
    ids, ends = lm.all_ids(texts)
    want = [[*t.encode().lower().split(), b""] for t in texts]
    assert ends.tolist() == np.cumsum([len(w) for w in want]).tolist()
    id_of = {}
    for w, i in zip((w for ws in want for w in ws), ids.tolist(), strict=True):
        assert id_of.setdefault(w, i) == i
        assert i >> 57 == (1 + crc32(w[-2:] + (b"+" if len(w) > 4 else b"-")) % (lm.CLASSES - 1) if w else 0)
    assert len(set(id_of.values())) == len(id_of) > 140
    assert [a.tolist() for a in lm.cut(ids, ends)] == [lm.ids_of(t).tolist() for t in texts] and lm.all_ids([])[0].size == 0


def test_lm_training_takes_each_exponential_once(monkeypatch):
    """The class softmax took two of each class and token, the gates one more: most of the time of op6."""
    from spark_marts.llm import lm

    rng, taken, plain = np.random.default_rng(5), [], np.exp

    def counted(a, *args, **kwargs):
        taken.append(np.size(a))
        return plain(a, *args, **kwargs)

    x, y, slot = (rng.integers(0, n, (8, 16)).astype(np.int16) for n in (lm.CLASSES, lm.CLASSES, lm.SLOTS))
    net, mass = lm.Gru.start(np.ones(lm.CLASSES)), np.ones((lm.CLASSES, lm.SLOTS))
    monkeypatch.setattr(np, "exp", counted)
    net.gradient(x, y, np.zeros(x.shape, bool), np.zeros((16, lm.HIDDEN), np.float32), slot, mass)
    assert sum(taken) <= x.size * (lm.CLASSES + lm.SLOTS)


def test_lm_scores_of_large_weights_are_finite_and_right():
    """Logits beyond what exp of a float32 holds: by each row's largest, as in float64."""
    from spark_marts.llm import lm

    rng = np.random.default_rng(6)
    flat = rng.normal(0, 30, len(lm.Gru.start(np.ones(lm.CLASSES)).flat))
    mass, seqs = rng.integers(1, 50, (lm.CLASSES, lm.SLOTS)) + 0.5, [rng.integers(0, lm.CLASSES, n).astype(np.int16) for n in (9, 1, 30)]
    slots = [rng.integers(0, lm.SLOTS, len(s)).astype(np.int16) for s in seqs]
    h, kind, slot = rng.uniform(-1, 1, (40, lm.HIDDEN)), rng.integers(0, lm.CLASSES, 40), rng.integers(0, lm.SLOTS, 40)
    net = lm.Gru(flat)
    y = h @ net.o + net.c
    y -= y.max(1, keepdims=True)
    assert np.allclose(net.class_softmax(h, kind), (y - np.log(np.exp(y).sum(1, keepdims=True)))[np.arange(40), kind])
    e = np.einsum("th,tsh->ts", h, net.w[kind])
    top = e.max(1)
    assert np.allclose(net.word_softmax(h, kind, slot, mass), e[np.arange(40), slot] - top - np.log((np.exp(e - top[:, None]) * mass[kind]).sum(1)))
    for p in lm.class_scores(lm.Gru(flat.astype(np.float32)), seqs, slots, mass):
        assert np.isfinite(p).all()
