"""Phrase collocations by SON partitioning.

1. *Shards.* Documents are dealt by a hash of doc_id to blocks, and blocks to ``SHARDS`` shards. Each shard
   is mined completely at the support lowered in proportion, ``ceil(support / SHARDS)``: a phrase with fewer
   in every shard cannot reach ``support``. Blocks count their distinct phrases and send a 32-bit
   fingerprint and the count, packed, to the phrase's bucket, which adds them up a shard at a time.
2. *Union.* A bucket answers every block, a bit a phrase, which of its phrases are frequent in some shard.
   Fingerprints that collide can only add candidates.
3. *Exact global counts.* Blocks send the texts of the candidates with their counts to the bucket, which
   adds them up by the text itself. All occurrences of a candidate come, so the sums are exact.

Cuts, scores, the test against longer phrases and the report follow in Spark SQL over the frequent phrases, with
38-digit decimals. A phrase that a third of all documents hold costs a bucket one entry a block.

Defined cases: null text is empty, null ``lang`` is ``und``; a repeated row counts again; rows with a null
``doc_id`` are dealt by their text; a table without words gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ..session import materialize
from .common import blocks_for, by_cogroup, by_group, mix, ship, split_by, table, text_bytes
from .runs import Numbers

SHARDS, SALTS = 4, 64
LONGEST, SUPPORT, COVER, TOP = 3, 10, 50, 2000
END = b"\xff"  # in no UTF-8 text: stands for the end of a piece
CUTS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + CUTS, b"abcdefghijklmnopqrstuvwxyz" + END * len(CUTS))
STEP = np.uint64(0x9E3779B97F4A7C15)


class Phrases:
    """The distinct phrases of up to ``longest`` words in some texts, shortest first, with their counts."""

    def __init__(self, lang: str, texts: list[str], longest: int):
        words = END.join(t.encode() for t in texts).translate(FOLD).replace(END, b" \xff ").split()
        number = Numbers()
        number[END]  # the end of a piece is word 0
        codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        self.words = list(number)
        seen = np.bincount(codes, minlength=len(number))
        self.total = int(len(codes) - seen[0])
        word_hash = np.fromiter(map(xxh3_64_intdigest, self.words), np.uint64, len(number))
        seed = np.uint64(xxh3_64_intdigest(lang.encode()))
        # per level: number of the phrase one word shorter, last word, count, hash
        self.levels = [(None, np.arange(1, len(number)), seen[1:], mix(word_hash[1:] + seed))]
        place, at = codes - 1, np.flatnonzero(codes)  # where phrases of the level begin, and their number there
        for size in range(2, longest + 1):
            at = at[at + size <= len(codes)]
            at = at[codes[at + size - 1] > 0]
            key, inverse, count = np.unique(place[at] << 32 | codes[at + size - 1], return_inverse=True, return_counts=True)
            shorter, last = key >> 32, key & 0xFFFFFFFF
            self.levels.append((shorter, last, count, mix(self.levels[-1][3][shorter] * STEP + word_hash[last])))
            place = np.full(len(codes), -1, np.int64)
            place[at] = inverse

    @property
    def hashes(self) -> np.ndarray:
        return np.concatenate([x[3] for x in self.levels])

    @property
    def counts(self) -> np.ndarray:
        return np.concatenate([x[2] for x in self.levels])

    def texts(self, wanted: np.ndarray) -> list[list[bytes]]:
        """Texts of the wanted phrases of each level (a mask over all); every shorter phrase at their front must be wanted."""
        out, known, at = [], [], 0
        for shorter, last, _, _ in self.levels:
            here = np.flatnonzero(wanted[at : at + len(last)])
            ends = map(self.words.__getitem__, last[here].tolist())
            if shorter is None:
                found = list(ends)
            else:
                found = [known[s] + b" " + w for s, w in zip(shorter[here].tolist(), ends, strict=True)]
            out.append(found)
            known = dict(zip(here.tolist(), found, strict=True))
            at += len(last)
        return out

    def with_fronts(self, wanted: np.ndarray) -> np.ndarray:
        """Adds the front of each wanted phrase: as frequent as the phrase, so missing only by ``wanted``'s false members."""
        wanted = wanted.copy()
        begins = np.cumsum([0, *(len(x[1]) for x in self.levels)])
        for k in range(len(self.levels) - 1, 0, -1):
            here = np.flatnonzero(wanted[begins[k] : begins[k + 1]])
            wanted[begins[k - 1] + self.levels[k][0][here]] = True
        return wanted


def dealt(docs: DataFrame) -> tuple[DataFrame, int]:
    """``(block, lang, text)`` and the number of blocks."""
    n = blocks_for(text_bytes(docs))
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    block = F.pmod(F.xxhash64(key), F.lit(n)).alias("block")
    return docs.select(block, F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")), n


def by_lang(t: pa.Table, longest: int) -> list[tuple[str, Phrases]]:
    """Phrases of a block, language by language, in a fixed order."""
    texts: dict = {}
    for lang, text in sorted(zip(t.column("lang").to_pylist(), t.column("text").to_pylist(), strict=True)):
        texts.setdefault(lang, []).append(text)
    return [(lang, Phrases(lang, rows, longest)) for lang, rows in texts.items()]


def phrase_counts(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> DataFrame:
    """``lang, phrase, f``: exact counts of every phrase found ``support`` times or more; the empty phrase counts all words."""
    ship(docs.sparkSession)
    blocks, n = dealt(docs)
    least = -(-support // SHARDS)

    def buckets(hashes: np.ndarray) -> list[tuple[int, np.ndarray]]:
        return split_by(((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.int64), n) if len(hashes) else []

    def send(t: pa.Table) -> dict:
        found = [p for _, p in by_lang(t, longest)]
        hashes = np.concatenate([p.hashes for p in found])
        counts = np.minimum(np.concatenate([p.counts for p in found]), 255).astype(np.uint8)
        prints, parts = hashes.astype(np.uint32), buckets(hashes)
        return {
            "bucket": [b for b, _ in parts],
            "block": [t.column("block")[0].as_py()] * len(parts),
            "prints": [prints[i].tobytes() for _, i in parts],
            "counts": [counts[i].tobytes() for _, i in parts],
        }

    def answer(t: pa.Table) -> dict:
        sent = [np.frombuffer(x, np.uint32) for x in t.column("prints").to_pylist()]
        shard = t.column("block").to_numpy() % SHARDS
        size = [len(x) for x in sent]
        key = np.concatenate(sent).astype(np.uint64) << np.uint64(3) | np.repeat(shard, size).astype(np.uint64)
        count = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.uint8)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        frequent = np.unique(key[first][np.add.reduceat(count[order].astype(np.int64), first) >= least] >> np.uint64(3)).astype(np.uint32)
        prints = np.concatenate(sent)
        at = np.searchsorted(frequent, prints)
        hit = np.append(frequent, np.uint32(0))[at] == prints
        hit &= at < len(frequent)
        bits = [np.packbits(x).tobytes() for x in np.split(hit, np.cumsum(size)[:-1])]
        has = [i for i, b in enumerate(bits) if any(b)]
        return {"block": t.column("block").take(pa.array(has, pa.int64())), "bucket": t.column("bucket").take(pa.array(has, pa.int64())), "bits": [bits[i] for i in has]}

    def candidates(t: pa.Table, answers: pa.Table) -> dict:
        found = by_lang(t, longest)
        out: dict = {"bucket": [], "lang": [], "phrases": [], "counts": []}
        if not found:
            return out
        bits = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True))
        hashes = np.concatenate([p.hashes for _, p in found])
        wanted = np.zeros(len(hashes), bool)
        for b, i in buckets(hashes):
            if b in bits:
                wanted[i] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=len(i)).astype(bool)
        at = 0
        for lang, p in found:
            some, hashes, counts = wanted[at : at + len(p.hashes)], p.hashes, p.counts
            at += len(some)
            whole = p.with_fronts(some)
            texts = np.array([x for level in p.texts(whole) for x in level], object)
            keep = np.flatnonzero(some[whole])
            texts, hashes, counts = texts[keep], hashes[some], counts[some].astype(np.int64)
            out["bucket"].append(xxh3_64_intdigest(lang.encode()) % n)
            out["lang"].append(lang)
            out["phrases"].append(b"")
            out["counts"].append(np.int64(p.total).tobytes())
            for b, i in buckets(hashes):
                out["bucket"].append(b)
                out["lang"].append(lang)
                out["phrases"].append(b"\n".join(texts[i].tolist()))
                out["counts"].append(counts[i].tobytes())
        return out

    def add_up(t: pa.Table) -> dict:
        totals: dict = {}
        for lang, phrases, counts in zip(*(t.column(c).to_pylist() for c in ("lang", "phrases", "counts")), strict=True):
            mine = totals.setdefault(lang, {})
            had = mine.get
            for phrase, count in zip(phrases.split(b"\n"), np.frombuffer(counts, np.int64).tolist(), strict=True):
                mine[phrase] = had(phrase, 0) + count
        rows = [(lang, phrase.decode(), f) for lang, mine in totals.items() for phrase, f in mine.items() if f >= support or not phrase]
        return dict(zip(("lang", "phrase", "f"), map(list, zip(*rows, strict=True)) if rows else ([], [], []), strict=True))

    ddl = "bucket long, block long, prints binary, counts binary"
    sent = blocks.groupBy("block").applyInArrow(by_group(ddl, send), ddl)
    ddl = "block long, bucket long, bits binary"
    answered = sent.groupBy("bucket").applyInArrow(by_group(ddl, answer), ddl)
    ddl = "bucket long, lang string, phrases binary, counts binary"
    found = blocks.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(by_cogroup(ddl, candidates), ddl)
    ddl = "lang string, phrase string, f long"
    return found.groupBy("bucket").applyInArrow(by_group(ddl, add_up), ddl)


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, cover: int = COVER, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words by the score of their weakest cut.

    A phrase inside a longer one that is at least ``cover`` percent as frequent is left out.
    """
    counts = materialize(phrase_counts(docs, support, longest), "phrase-counts")
    words = F.split("phrase", " ", -1)
    longer = counts.where(F.instr("phrase", " ") > 0).select("lang", "phrase", F.col("f").alias("a"), words.alias("w"))
    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = longer.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("front"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("back")
    )
    of = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    scored = cuts.join(of("front", "l"), ["lang", "front"]).join(of("back", "r"), ["lang", "back"])
    d = lambda c: F.col(c).cast("decimal(19,0)")
    scored = scored.withColumn("l19", d("l")).withColumn("r19", d("r")).withColumn("a19", d("a"))
    scored = scored.withColumn("score", F.expr("(cast(1000000 as decimal(7,0)) * a19 * a19) div (l19 * r19)"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = longer.where(F.size("w") > 2).select(
        "lang", "a", F.explode(F.filter(F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda size: F.transform(
            F.sequence(F.lit(1), F.size("w") - size + 1), lambda start: F.array_join(F.slice("w", start, size), " ")))), lambda x: x != "")).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    left = weakest.join(inside, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("held").cast("decimal(19,0)") < cover * F.col("a").cast("decimal(19,0)"), F.lit(True)))
    rows = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase"))
    rows = rows.withColumn("salt", F.pmod(F.hash("phrase"), F.lit(SALTS)))
    rows = rows.withColumn("rank", ranked("lang", "salt")).where(F.col("rank") <= top)  # a language in parts: at most SALTS * top rows are left
    best = rows.withColumn("rank", ranked("lang").cast("long")).where(F.col("rank") <= top)
    totals = counts.where(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents), LATERAL (SELECT list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w)),
grams AS (
  SELECT lang, s AS words, array_to_string(w[i : i + s - 1], ' ') AS phrase
  FROM (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) AS sizes(s))),
counts AS MATERIALIZED (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE words = 1 GROUP BY lang),
cands AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE words > 1 AND f >= 10),
parts AS MATERIALIZED (
  SELECT lang, phrase, words, a, k, lang || ' ' || array_to_string(w[1 : k], ' ') AS front,
         lang || ' ' || array_to_string(w[k + 1 :], ' ') AS back
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cands)),
keyed AS MATERIALIZED (SELECT lang || ' ' || phrase AS part, f FROM counts WHERE f >= 10),
fronts AS MATERIALIZED (SELECT p.*, f AS l FROM parts p JOIN keyed ON part = front),
cuts AS MATERIALIZED (
  SELECT p.*, f AS r, 1000000::HUGEINT * a * a // (l::HUGEINT * f) AS score
  FROM fronts p JOIN keyed ON part = back),
weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, part, max(a) AS held
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM cands WHERE words = 3)
  GROUP BY ALL),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN inside i ON i.lang || ' ' || i.part = w.lang || ' ' || w.phrase
  WHERE held IS NULL OR 100 * held < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
