"""Operators against brute force on small tables with nulls, ties, copies, odd columns and long texts."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from spark_marts.llm import decontam, langid, lines, lm, neardup, packing, pii, substrings, topk, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block long, n int, row string"
WORDS = "ash birch cedar elm fir hazel larch maple oak pine rowan spruce willow yew alder beech".split()


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, 16, n), rng.integers(0, 9, n), strict=True))


def texts() -> list:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    shared = "This line is shared by many documents.\n" + prose(2, 40)
    return [
        (0, base), (1, base), (2, " ".join(near)), (3, None), (4, ""), (5, " \t\n "), (6, "a b"), (7, "A  B"),
        (8, shared), (9, "x\n  THIS line is shared by many documents. \nend"), (9, "x\n  THIS line is shared by many documents. \nend"),
        (10, prose(3, 4000) + base[:200]), (11, "é" * 90), (12, "zz" + "é" * 60), (13, "q" * 300), (14, "q" * 60), (None, base), (15, base.upper()),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0, 7, 1, "r") for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_pii_spans_and_base_kinds():
    text = "a@b.c@d.e x@y.zz. 1.2.3.4.5 1.2.3.256 0001.2.3.4; 4111 1111 1111 1111; 4111111111111112; +1 (555) 123-4567 +12"
    found = pii.spans(text)
    got = [(pii.KINDS[k], text[s:e]) for s, k, e, _ in found]
    assert got == [("email", "a@b.c"), ("email", "x@y.zz"), ("ip", "1.2.3.4"), ("ip", "0001.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 123-4567")]
    assert [pii.KINDS[k] for _, k, _, _ in pii.spans("IBAN: DE89370400440532013000 ssn 123-45-6789")] == ["iban", "ssn"]
    assert pii.spans("code 123-45-6789") == [] and not pii.mod97("DE89370400440532013001")


def test_pii_matches_the_plain_patterns():
    rng = np.random.default_rng(5)
    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        t = "".join(rng.choice(list("a1@.. -+9"), 40))
        assert list(pii.emails(t)) == [m.span() for m in plain.finditer(t)]
        want = [m.span() for m in ip.finditer(t) if all(int(x) < 256 for x in m[0].split("."))]
        assert [(s, e) for k, s, e in pii.propose(t) if k == "ip"] == want
    for hard in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "+1" + "(" * 100_000):
        pii.spans(hard)


def test_pii_query_digest(docs, empty):
    rows = pii.digest(pii.find_pii(docs)).collect()
    assert len(rows) == len(texts()) and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert pii.digest(pii.find_pii(empty)).count() == 0


def test_substring_dedup_equals_brute_force(docs, empty):
    first: dict = {}
    for i, t in sorted(((i, (t or "").encode()) for i, t in texts() if i is not None)):
        for j in range(len(t) - 49):
            first.setdefault(t[j : j + 50], i)
    want = []
    for i, t in ((i, (t or "").encode()) for i, t in texts()):
        gone = bytearray(len(t))
        for j in range(len(t) - 49):
            if i is not None and first[t[j : j + 50]] < i:
                gone[j : j + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        want.append((i, len(t), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()), kept))
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    for part_bytes in (2 << 20, 400):
        got = [(*r[:4], bytes(r[4])) for r in by_row(substrings.dedup_substrings(docs, part_bytes), *cols)]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert substrings.dedup_substrings(empty).count() == 0


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(3)
    pieces = sorted({bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in rng.integers(50, 84, 60)})
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(np.append(0, sizes[:-1] + 1))
    s = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int16) + 1
    s[starts + sizes] = 0
    order = substrings.suffix_array(s)
    flat = s.tolist()
    assert order.tolist() == sorted(range(len(s)), key=lambda i: flat[i:])
    shared = substrings.common_prefixes(s, order, starts, sizes)
    for k in range(1, len(order)):
        a, b = order[k - 1], order[k]
        if flat[b]:
            n = next((i for i in range(50) if a + i >= len(s) or b + i >= len(s) or s[a + i] != s[b + i]), 50)
            assert shared[k] == n


def test_decontamination(spark, docs, empty):
    item = "The quick brown fox jumps over the lazy dog near the old river bank, twice a day."
    long = prose(9, 120)
    bench = spark.createDataFrame([(1, item), (2, long), (3, None), (4, "short"), (None, "no item carries this text anywhere at all")], "item_id long, text string")
    edited = item.replace("lazy", "lzy").replace("twice", "twise").upper()
    cases = [(0, "before " + item + " after"), (1, "x " + edited + " y"), (2, prose(4, 300)), (3, prose(5, 30) + " " + long[150:420] + " end"), (4, None), (5, "The quick brown fox sleeps")]
    leaks = decontam.find_leaks(spark.createDataFrame(cases, "doc_id long, text string"), bench)
    assert by_row(leaks, "doc_id", "item_id", "edits") == [(0, 1, 0), (1, 1, 2), (3, 2, 0)]
    assert decontam.find_leaks(docs, bench).count() == 0 and decontam.find_leaks(empty, bench).count() == 0
    assert decontam.drop_contaminated(docs, bench).count() == len(texts())
    several = decontam.find_leaks(spark.createDataFrame(cases, "doc_id long, text string"), bench, chunk_chars=100)
    assert by_row(several, "doc_id", "item_id") == [(0, 1), (1, 1), (3, 2)]


def test_passages_of_items_of_every_length_are_found(spark):
    items = {n: prose(n, 80)[:n] for n in (100, 150, 200, 240, 241, 400)}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    around = prose(900, 40), prose(901, 40)
    cases = [(n * 10 + i, f"{around[0]} {part} {around[1]}") for n, t in items.items() for i, part in enumerate((t[:90], t[-90:], t[5:97].replace("a", "o", 1)))]
    lined = items[240]
    cases += [(1, f"{around[0]}\n{lined[:100]}\n{lined[140:]}\n{around[1]}"), (2, f"{around[0]} {lined[:45]} {around[1]}")]  # inner line gone; too short
    leaks = decontam.find_leaks(spark.createDataFrame(cases, "doc_id long, text string"), bench)
    assert by_row(leaks, "doc_id", "item_id") == sorted([(d, d // 10) for d, _ in cases[:-2]] + [(1, 240)], key=str)


def test_short_items_are_found():
    items = decontam.Items([(1, "Forty  Two"), (2, "abcdefghijklmnopqrstuvwxy"), (3, "0123456789abcdefghijklmnop"), (4, " "), (5, None)])
    assert items.matches("it is forty two, they say") == {1: (0, 15)} and items.matches("fortytwo") == {}
    found = items.matches("- abcdefgh!jklmnop!rstuvwxy -  01234567!9abcdefg!ijklmnop -")
    assert {i: e for i, (e, _) in found.items()} == {2: 2, 3: 2}
    assert items.matches("- abcdefgh!jklmnop!rst!vwxy -") == {}


def test_banded_alignment_equals_full_table():
    rng = np.random.default_rng(8)
    for _ in range(60):
        s, r = rng.integers(0, 3, 12).astype(np.uint32), rng.integers(0, 3, 40).astype(np.uint32)
        full = np.zeros((13, 41), int)
        full[:, 0] = range(13)
        for i in range(1, 13):
            for j in range(1, 41):
                full[i, j] = min(full[i - 1, j - 1] + (s[i - 1] != r[j - 1]), full[i - 1, j] + 1, full[i, j - 1] + 1)
        gap = np.full(12, decontam.GAP, np.uint32)  # room on both sides, so that the band holds every alignment
        assert decontam.banded_edits(s, np.concatenate([gap, r, gap, gap]))[0] == full[12].min()


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6)], 0) for i in range(120)]
    rows += [(i, rows[0][1], 0) for i in range(120, 160)]
    rows += [(200, None, 0), (201, [1.0, None], 0), (202, [float("nan")], 0), (203, [], 0), (250, [1.0], 0), (None, [1.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    use = {i: np.floor(256 * np.array([*v, *[0.0] * (6 - len(v))])) for i, v, _ in rows if i is not None and v is not None and None not in v and not any(map(math.isnan, v))}
    want = []
    for q in (i for i in use if i % 50 == 0):
        best = sorted((-int(use[q] @ use[i]), i) for i in use if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    got = topk.top_k(frame, frame.where("vec_id % 50 = 0").select("vec_id"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    none = frame.limit(0)
    assert topk.top_k(none, none.select("vec_id")).count() == 0
    huge = spark.createDataFrame([(0, [1e7, -3e7]), (1, [2e7, 5e6])], "vec_id long, embedding array<double>")
    assert [r.score for r in topk.top_k(huge, huge.select("vec_id")).collect()] == [int(256e7) * int(512e7) - int(768e7) * int(128e7)] * 2


def test_near_duplicates_equal_brute_force(spark, docs, empty):
    def sets(t, size=4):
        w = (t or "").encode().lower().split()
        return {b" ".join(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()

    chain = prose(20, 400).split()
    more = []
    for i in range(30):  # each differs a little from the last, so that only a chain of links joins them
        chain = list(chain)
        chain[(i * 37) % 400] = f"v{i}"
        more.append((100 + i, " ".join(chain), "en", "s", 0, 7, 1, "r"))
    every = docs.union(spark.createDataFrame(more, SCHEMA))
    own = {i: sets(t) for i, t, *_ in [*texts(), *more] if i is not None}
    parent = {i: i for i in own}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in own:
        for b in own:
            if a < b and own[a] and own[b] and 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    rows = neardup.near_duplicates(every, shingle=4).collect()
    assert len(rows) == len(texts()) + len(more)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(own[r.doc_id]), root(r.doc_id), root(r.doc_id) == r.doc_id)
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.drop_near_duplicates(every, shingle=4)
    assert kept.columns == every.columns and kept.where("doc_id BETWEEN 101 AND 129").count() == 0


def test_every_turn_finds_the_same(docs, monkeypatch):
    want = by_row(neardup.near_duplicates(docs, 4), "doc_id", "component_id")
    monkeypatch.setattr(neardup, "ENOUGH", 0)
    assert by_row(neardup.near_duplicates(docs, 4), "doc_id", "component_id") == want


def test_lm_base_score_and_probability(docs, empty):
    count = collections.Counter()
    token = lambda t: [*(t or "").encode().lower().split(), None]
    for i, t in texts():
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(token(t))
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), len(token(t)), sum(w in count for w in token(t)), round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in token(t)), 6)) for i, t in texts())
    rows = lm.score_documents(docs, train_share=1, rounds=1).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == want
    assert {r.train_tokens for r in rows} == {n} and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert lm.score_documents(empty).count() == 0


def test_every_training_document_trains_the_network_by_default(docs):
    scores = lambda **share: by_row(lm.score_documents(docs, rounds=1, **share), "doc_id", "score")
    assert scores() == scores(train_share=1) != scores(train_share=16)


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    net = lm.Gru.start(np.ones(lm.CLASSES))
    net.flat = net.flat.astype(np.float64)
    net = lm.Gru(net.flat + rng.normal(0, 0.1, len(net.flat)))
    seqs = [rng.integers(0, lm.CLASSES, 7).astype(np.int16) for _ in range(3)]
    x, y, fresh, _ = lm.lanes_of(seqs, 2)
    h = np.zeros((2, lm.HIDDEN))
    g, _ = net.gradient(x, y, fresh, h)
    loss = lambda flat: -sum(p.sum() for p in lm.class_scores(lm.Gru(flat), seqs)) / sum(map(len, seqs))
    worst = np.argsort(-np.abs(g))[:20]
    for i in worst:
        step = np.zeros(len(g))
        step[i] = 1e-3
        assert abs((loss(net.flat + step) - loss(net.flat - step)) / 2e-3 - g[i]) < 1e-3
    single = [lm.class_scores(net, [s])[0] for s in seqs]
    for a, b in zip(lm.class_scores(net, seqs), single, strict=True):
        assert np.allclose(a, b, atol=1e-4)


def test_word_given_class_follows_the_state(spark):
    rows = [(i, "red cat blue bat " * 300) for i in range(20)] + [(100, "red cat blue bat"), (101, "red bat blue cat")]
    ids = lm.ids_of("bat cat")[:2]
    assert len({int(i) >> 57 for i in ids}) == 1 and len(set(lm.slots_of(ids).tolist())) == 2
    score = {r.doc_id: r.score for r in lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()}
    assert score[100] > score[101] + 1e-3


def test_word_softmax_sums_to_one_and_its_gradient_matches_differences():
    rng = np.random.default_rng(3)
    net = lm.Gru(rng.normal(0, 0.3, len(lm.Gru.start(np.ones(lm.CLASSES)).flat)))
    mass = rng.integers(0, 5, (lm.CLASSES, lm.SLOTS)) + 0.5
    h = rng.normal(0, 1, (lm.SLOTS, lm.HIDDEN))
    same, every = np.repeat(h[:1], lm.SLOTS, 0), np.arange(lm.SLOTS)
    assert abs((np.exp(net.word_softmax(same, np.full(lm.SLOTS, 5), every, mass)) * mass[5]).sum() - 1) < 1e-9
    ids = [rng.integers(0, 5, 9).astype(np.uint64) << np.uint64(57) | rng.integers(0, 1 << 56, 9).astype(np.uint64) for _ in range(3)]
    seqs, slots = [(i >> np.uint64(57)).astype(np.int16) for i in ids], [lm.slots_of(i) for i in ids]
    x, y, fresh, placed = lm.lanes_of(seqs, 2)
    g, _ = net.gradient(x, y, fresh, np.zeros((2, lm.HIDDEN)), lm.laid_out(slots, placed, y), mass)
    loss = lambda flat: -sum(p.sum(dtype=np.float64) for p in lm.class_scores(lm.Gru(flat), seqs, slots, mass)) / sum(map(len, seqs))
    at_w = len(g) - net.w.size
    for i in [*np.argsort(-np.abs(g))[:10], *(at_w + np.argsort(-np.abs(g[at_w:]))[:10])]:
        step = np.zeros(len(g))
        step[i] = 1e-3
        assert abs((loss(net.flat + step) - loss(net.flat - step)) / 2e-3 - g[i]) < 1e-3


def test_toxicity(spark, empty):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(400):
        words = prose(i + 50, 60).split()
        if i % 4 == 0:
            for at in rng.integers(0, 60, 4):
                words[at] = rng.choice(["blorg", "fnarkest", "fnarking"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(1000, "you bl0rg and f​nаrking fool"), (1001, "all is well"), (1002, None), (None, ""), (1003, "the blorgs"), (1004, "BLORG")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([*labels, (None, 1), (5000, 1), (1, None)], "doc_id long, toxic int"))
    assert {t.rstrip("$") for t in model.weights} >= {"biorg"} and any(t.startswith("fnark") for t in model.weights)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert got[1000].predicted == 1 and got[1001].predicted == 0 and got[1002].predicted == 0 and got[None].held_out is False
    held = [r for r in got.values() if r.held_out and r.doc_id < 400]
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in got.values())
    none = toxicity.fit(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert none.score("anything") < 0.5 and toxicity.score_toxicity(empty, none).count() == 0
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    shield = toxicity.Lexicon({"moby$": 1.0}, ("moby dick",), (1.0, 0.0, 0.0))
    assert shield.hits("moby dick and moby") == 1.0


def test_language_id(spark, empty):
    rows = [(i, " ".join(np.random.default_rng(i).choice(["ach", "und", "der", "nicht"], 30)), "de") for i in range(60)]
    rows += [(100 + i, " ".join(np.random.default_rng(i).choice(["the", "of", "and", "with"], 30)), "en") for i in range(60)]
    rows += [(300, None, "de"), (301, "123 !?", None), (302, "the and of", None), (None, "und der", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(docs, langid.learn(docs)).collect()}
    assert got[300].lang_pred == got[301].lang_pred == "und" and got[302].lang_pred == "en" and got[None].lang_pred == "de"
    assert all(got[i].lang_pred == w for i, _, w in rows if i is not None and i < 300)
    assert langid.identify(empty, langid.learn(empty)).count() == 0


def test_line_dedup_equals_brute_force(docs, empty):
    blank = " \t\n\r\x0b\x0c"
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(blank))
    holders = collections.defaultdict(set)
    for i, t in texts():
        if i is not None:
            for x in (t or "").split("\n"):
                holders[key(x)].add(i)
    want = []
    for i, t in texts():
        own = (t or "").split("\n")
        kept = [x for x in own if i is None or len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        want.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    assert by_row(lines.dedup_lines(docs), "doc_id", "n_lines", "n_dropped", "text") == sorted(want, key=str)
    kept = lines.dedup_lines(docs, keep_columns=True)
    assert kept.dtypes == docs.dtypes and by_row(kept, "block", "n", "row") == [(7, 1, "r")] * len(texts())
    assert lines.dedup_lines(empty).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(4)
    h1, h2 = rng.integers(0, 1 << 63, (2, 5000)).astype(np.uint64)
    table = lines.PerfectHash(h1, h2)
    assert sorted(table.index(h1, h2).tolist()) == list(range(5000))


def test_packing_is_a_partition_of_all_ids(docs, empty):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path("word_bpe_49k.json"))
    odd = "It's naïve <|endoftext|>x ½ ﬁn é 日本語 don't 12.5% ÀÉ b İ"
    assert packing.Tokens(path("word_bpe_49k.json"), most=3).of(odd) == np.array([*whole.encode(odd, add_special_tokens=False).ids, 1], "<u4").tobytes()
    rows = packing.pack(docs, path("word_bpe_49k.json"), length=64).collect()
    ids = collections.Counter()
    for i, t in texts():
        ids[i] += len(whole.encode(t or "", add_special_tokens=False).ids) + 1
    found, at = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        found[r.doc_id] += r.length
        at[r.sequence_id].append((r.offset, r.length))
    assert found == ids
    for pieces in at.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end == 64 or end & (end - 1) == 0
    assert packing.pack(empty, path("word_bpe_49k.json")).count() == 0


def test_packer_keeps_the_sum_of_squares_small_and_drains():
    done = []
    p = packing.Packer(done.append, length=16, most_open=3)
    rng = np.random.default_rng(6)
    sizes = rng.integers(1, 40, 300)
    for i, n in enumerate(sizes):
        p.add(i, np.full(n, i, "<u4").tobytes())
        assert p.counts.sum() == p.open <= 4
    p.drain()
    total = collections.Counter()
    for window in done:
        size = sum(len(x[2]) // 4 for x in window)
        assert size == 16 or size & (size - 1) == 0
        for doc, _, ids, _ in window:
            total[doc] += len(ids) // 4
    assert [total[i] for i in range(300)] == sizes.tolist()


def test_parity_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(200):
        base = rng.integers(0, 2**63, rng.integers(1, 400), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([base, rng.integers(0, 2**63, rng.integers(0, 200), dtype=np.uint64)])) for _ in "ab")
        odd = int(np.bitwise_count((neardup.parities(a) ^ neardup.parities(b)).view(np.uint64)).sum())
        assert odd <= len(np.setxor1d(a, b)) and odd % 2 == len(np.setxor1d(a, b)) % 2
