"""run() of the pipeline against plain Python on a planted fixture: copies, near copies, shared lines, a benchmark passage."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer
from zlib import crc32

import corpus_pipeline

WORDS = "ash birch cedar elm fir hazel larch maple oak pine rowan spruce willow yew alder beech".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, 16, n), rng.integers(0, 99, n), strict=True))


def planted():
    passage = prose(900, 40)
    near = prose(1, 120).split()
    near[60] = "changed"
    shared = "This line is in several documents."
    rows = [(i, prose(i, 60 + 10 * i)) for i in range(2, 14)]
    rows += [(1, prose(1, 120)), (20, " ".join(near)), (21, prose(5, 110)), (22, f"{prose(30, 80)}\n{shared}\n{prose(31, 80)}"), (23, f"{shared}\n{prose(32, 90)}\n  {shared.upper()} ")]
    rows += [(24, f"{prose(33, 30)} {passage} {prose(34, 30)}"), (25, "short\nshort"), (26, None), (27, "")]
    return rows, passage


def plain(rows, passage):
    """Text of every document that is left, stage by stage (no label teaches a toxic word, so toxicity drops nothing)."""
    texts = {i: t or "" for i, t in sorted(rows)}
    key = lambda line: line.strip(" \t\n\r\x0b\x0c").lower()  # noqa: E731 (the fixture is ASCII)
    holders: dict = {}
    for i, t in texts.items():
        for line in t.split("\n"):
            holders.setdefault(key(line), i)
    texts = {i: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or holders[key(x)] == i) for i, t in texts.items()}
    sets = {}
    for i, t in texts.items():
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    kept = []
    for i in texts:
        if not any(sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in kept):
            kept.append(i)
    return {i: texts[i] for i in kept if passage not in texts[i]}


def test_run_equals_plain_python(spark, tmp_path):
    rows, passage = planted()
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = plain(rows, passage)
    assert {20, 24} & want.keys() == set() and want[21] == "" and "several" not in want[23]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in want.items()}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == set(want)
    for i, own in ids.items():
        mine = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert [p.start for p in mine] == [0, *np.cumsum([p.length for p in mine])[:-1]] and sum(p.length for p in mine) == len(own)
        assert all(p.ids_crc32 == crc32(own[p.start : p.start + p.length].tobytes()) for p in mine)


def test_run_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
