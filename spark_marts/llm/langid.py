"""Language identification by rank-order profiles (out-of-place distance).

A profile is the list of the most frequent character n-grams (1 to 3 letters, words padded with a
space) in order of frequency. A document's own list is compared with every language's: each of
its n-grams adds the difference of ranks, or the largest difference if the language lacks it. The
nearest language wins; ties go to the smaller name.

Learning: at most ``rows_per_lang`` documents of each language, chosen by a hash of doc_id from rows
that are not held out. Profiling and comparing a document covers its whole text.

Defined cases: null text, or text without a letter, is ``und`` with score 0.0; rows with null lang
teach nothing; without any learned language every row is ``und``; a null doc_id is predicted
and is not held out; texts with no n-gram known to any profile go to the smallest name, score 0.0.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import is_held_out, map_texts, table

ROWS_PER_LANG = 1500
PROFILE = 400
SALTS = 64  # parts of a language that are ranked apart, so that a frequent one is not one task's work
SPACE = 32


@lru_cache(1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """All n-grams of the text, each packed into 63 bits (21 a code point)."""
    a = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    a = np.where(letters()[a], a, SPACE)
    a = a[~((a == SPACE) & np.append(False, a[:-1] == SPACE))]
    if len(a) < 3:
        return np.empty(0, np.int64)
    two = (a[:-1] << 21) | a[1:]
    return np.concatenate([a[a != SPACE], two, (two[:-1] << 21) | a[2:]])


def ranked(all_grams: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by code."""
    found, n = np.unique(all_grams, return_counts=True)
    return found[np.lexsort((found, -n))[:most]]


class Profiles:
    """``ranks[i, j]``: place of n-gram ``i`` in language ``j`` (PROFILE where it has none)."""

    def __init__(self, by_lang: dict):
        self.langs = sorted(by_lang)
        self.grams = np.unique(np.concatenate([*by_lang.values(), np.empty(0, np.int64)])).astype(np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), PROFILE, np.int32)
        for j, lang in enumerate(self.langs):
            own = by_lang[lang]
            self.ranks[np.searchsorted(self.grams, own), j] = np.arange(len(own))

    def predict(self, text: str) -> tuple[str, float]:
        own = ranked(grams(text)) if self.langs else ()
        if not len(own):
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        rows = self.ranks[np.where(self.grams[at] == own, at, len(self.grams))]
        far = np.where(rows < PROFILE, np.abs(rows - np.arange(len(own))[:, None]), PROFILE).sum(0)
        best = int(far.argmin())
        return self.langs[best], float(1 - far[best] / (PROFILE * len(own)))


def learn(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> Profiles:
    """Counts n-grams of the sample in Spark; PROFILE n-grams a language reach the driver."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    ids = ids.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(~is_held_out(0))
    ids = ids.withColumn("by", F.xxhash64("doc_id")).withColumn("salt", F.pmod("by", F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):  # the first of a language are among the first of its salts
        order = Window.partitionBy(*keys).orderBy("by", "doc_id")
        ids = ids.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= rows_per_lang).drop("nth")
    ids = ids.select(F.col("doc_id").alias("id"), "lang")
    text = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    sample = text.join(F.broadcast(ids.distinct()), ["id", "lang"]).select("lang", "text")

    def count(batches):
        schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
        for b in batches:
            of: dict = {}
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                of.setdefault(lang, []).append(grams(t))
            for lang, parts in of.items():
                g, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], schema=schema)

    n = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = n.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= PROFILE)
    by: dict = {}
    for r in sorted(top.collect(), key=lambda r: r["rank"]):
        by.setdefault(r.lang, []).append(r.gram)
    return Profiles({k: np.array(v, np.int64) for k, v in by.items()})


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    def make(ids, texts):
        found = [profiles.predict(t) for t in texts]
        return {"doc_id": ids, "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]}

    out = map_texts(docs, "doc_id long, lang_pred string, score double", make)
    return out.select("doc_id", is_held_out(0).alias("held_out"), "lang_pred", "score")


def op8_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
