"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other scripts to Latin ones and digit or sign
substitutions to letters (``l``, ``1`` and ``i`` become one letter, as do ``o`` and ``0``), so that a
disguised word meets its lexicon form. A lexicon term is a whole word or a stem; it matches only where
a word begins, a whole word only if it ends there too. Exception phrases (a word pair found as often
in clean documents) match as longer patterns and cancel the term. The sum of weights S enters a
logistic curve normalised by the length n in words: S / sqrt(n) against sqrt(n), so that a few
chance matches in a long text weigh little.

Learning: terms, exception phrases and the curve come from a bounded sample of labelled rows
(``sample_rows``, chosen by a hash of doc_id, from rows that are not held out); of near copies in it
(equal smallest hash of five words) one counts. Scoring covers every whole text.

Defined cases: null or empty text scores like a text of one word without a match; documents without
a label teach nothing; conflicting labels of one document each count; an empty label table, or one
with a single class, gives a model that scores by the share of toxic labels (0.0 without any);
a null doc_id is scored and is not held out.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ..session import materialize
from .common import is_held_out, keep_rows, map_texts, table, texts_of, words_of

# Look-alikes: Cyrillic and Greek letters beside the Latin letters they resemble.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "ё": "e", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ӏ": "i",
}
SUBSTITUTES = {"0": "o", "1": "i", "l": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
FOLD = str.maketrans(LOOKALIKES | SUBSTITUTES | {chr(c): None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)} | {chr(0xFF01 + i): chr(0x21 + i).lower() for i in range(94)})
WORD = re.compile(r"[^\W\d_]+")
SAMPLE_ROWS = 8_000
STEMS = range(4, 9)  # lengths of the stems tried
LEAST_SHARE = 0.02  # a term must occur in this share of the toxic documents
LEAST_ODDS = 4.0  # and be so many times as frequent in them as in the others
LEAST_DOC_ODDS = 1.9  # and its documents so many times as frequent among them
MOST_TERMS = 2_000


def fold(text: str) -> str:
    return text.lower().translate(FOLD)


def terms_of(word: str) -> list[str]:
    """A folded word as a whole (with a closing ``$``) and its stems."""
    return [word + "$", *(word[:n] for n in STEMS if n <= len(word))]


@dataclass
class Lexicon:
    weights: dict
    exceptions: tuple
    curve: tuple  # of S / sqrt(n), of sqrt(n), bias

    @cached_property
    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for term, x in self.weights.items():
            word = term.rstrip("$")
            a.add_word(word, (len(word), x, word != term))
        for p in self.exceptions:
            a.add_word(p, (len(p), 0.0, True))
        a.make_automaton()
        return a

    def hits(self, folded: str) -> float:
        """Sum of weights of the matches that no exception phrase covers."""
        found, shield = [], []
        for end, (n, x, whole) in self.automaton.iter(folded):
            start, stop = end - n + 1, end + 1
            if (start and folded[start - 1].isalpha()) or (whole and stop < len(folded) and folded[stop].isalpha()):
                continue
            if x:
                found.append((start, x))
            else:
                shield.append((start, stop))
        starts, ends = [], []  # of the covered stretches, apart from one another
        for start, stop in sorted(shield):
            if ends and start <= ends[-1]:
                ends[-1] = max(ends[-1], stop)
            else:
                starts.append(start)
                ends.append(stop)
        covered = lambda at: bool(starts) and at < ends[bisect_right(starts, at) - 1] and at >= starts[0]
        return sum(x for at, x in found if not covered(at))

    def feature(self, text: str) -> tuple[float, float]:
        root = float(np.sqrt(max(1, len(text.split()))))
        return (self.hits(fold(text)) / root if self.weights else 0.0), root

    def score(self, text: str) -> float:
        a, b, c = self.curve
        x, root = self.feature(text) if self.weights else (0.0, 0.0)
        return float(1 / (1 + np.exp(-np.clip(a * x + b * root + c, -30, 30))))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """At most ``sample_rows`` labelled documents (the bound that allows the broadcast), near copies merged."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    ids = ids.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~is_held_out(0))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample_rows)
    rows = texts_of(docs).join(F.broadcast(ids), "doc_id").select("text", "toxic")

    def keyed(batches):
        schema = pa.schema([("text", pa.string()), ("toxic", pa.int32()), ("likeness", pa.string())])
        for b in batches:
            keys = []
            for t in b.column(0).to_pylist():
                words = words_of(t)
                keys.append(str(min((xxh3_64_intdigest(b" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))), default=0)))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1).cast(pa.int32()), pa.array(keys)], schema=schema)

    rows = rows.mapInArrow(keyed, "text string, toxic int, likeness string")
    return materialize(rows.dropDuplicates(["likeness", "toxic"]).select("text", "toxic"), "toxic-sample")


def count_terms(sample: DataFrame, make) -> DataFrame:
    """Occurrences and documents of each term that ``make(words)`` yields, by label."""

    def count(batches):
        schema = pa.schema([("term", pa.string()), *((c, pa.int64()) for c in ("bad", "good", "bad_docs", "good_docs"))])
        for b in batches:
            seen: dict = {}
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for term, n in Counter(make(WORD.findall(fold(text)))).items():
                    row = seen.setdefault(term, [0, 0, 0, 0])
                    row[1 - toxic] += n
                    row[3 - toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), *(pa.array([x[i] for x in seen.values()], pa.int64()) for i in range(4))], schema=schema)

    rows = sample.select("text", "toxic").mapInArrow(count, "term string, bad long, good long, bad_docs long, good_docs long")
    return rows.groupBy("term").agg(*(F.sum(c).alias(c) for c in ("bad", "good", "bad_docs", "good_docs")))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Lexicon:
    """Learns the lexicon; at most MOST_TERMS candidate terms and ``sample_rows`` features reach the driver."""
    sample = labelled_sample(docs, labels, sample_rows)
    counts = sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    n_bad, n_good = (int(x or 0) for x in counts)
    if not n_bad or not n_good:
        share = n_bad / max(1, n_bad + n_good)
        return Lexicon({}, (), (0.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9)))))
    terms = count_terms(sample, lambda words: (t for w in words for t in ("", *terms_of(w))))
    terms = materialize(terms.where(f"bad_docs >= {max(2, LEAST_SHARE * n_bad)} OR term = ''"), "toxic-terms")
    words = terms.where("term = ''").first()
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5)) - F.lit(float(np.log((words.bad + 0.5) / (words.good + 0.5))))
    found = terms.where("term <> ''").withColumn("w", odds).where(F.col("w") >= float(np.log(LEAST_ODDS)))
    found = found.where(F.col("bad_docs") * n_good >= F.col("good_docs") * n_bad * LEAST_DOC_ODDS)
    weights: dict = {}
    for r in found.orderBy(F.desc(F.round(F.col("bad") * F.col("w"))), F.desc(F.length("term")), "term").limit(MOST_TERMS).collect():
        stem = r.term.rstrip("$")
        if not any(stem.startswith(t.rstrip("$")) or t.startswith(stem) for t in weights):
            weights[r.term] = r.w
    if not weights:
        return Lexicon({}, (), (0.0, 0.0, float(np.log((n_bad + 0.5) / (n_good + 0.5)))))
    stems = tuple(t.rstrip("$") for t in weights)
    pairs = count_terms(sample, lambda words: (f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if a.startswith(stems) or b.startswith(stems)))
    pairs = pairs.where(f"good_docs >= {max(3, 0.01 * n_good)} AND good_docs * {n_bad} >= bad_docs * {n_good}")
    model = Lexicon(weights, tuple(sorted(r.term for r in pairs.orderBy(F.desc("good_docs"), "term").limit(MOST_TERMS).collect())), (0.0, 0.0, 0.0))

    def features(batches):
        schema = pa.schema([("x", pa.float64()), ("root", pa.float64()), ("toxic", pa.int32())])
        for b in batches:
            x = [model.feature(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([v[0] for v in x], pa.float64()), pa.array([v[1] for v in x], pa.float64()), b.column(1).cast(pa.int32())], schema=schema)

    rows = sample.select("text", "toxic").mapInArrow(features, "x double, root double, toxic int").collect()
    model.curve = logistic(np.array([[r.x, r.root, 1.0] for r in rows]), np.array([r.toxic for r in rows]))
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple:
    """Coefficients by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * len(x) * np.diag([1.0, 1e-3, 0.0]) + 1e-9 * np.eye(len(w))
        g = x.T @ (p - y) + ridge * len(x) * np.array([1.0, 1e-3, 0.0]) * w
        w = w - np.clip(np.linalg.solve(h, g), -3, 3)
    return tuple(float(v) for v in w)


def score_toxicity(docs: DataFrame, model: Lexicon) -> DataFrame:
    def make(ids, texts):
        return {"doc_id": ids, "score": [model.score(t) for t in texts]}

    out = map_texts(docs, "doc_id long, score double", make)
    return out.select("doc_id", is_held_out(0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Lexicon) -> DataFrame:
    """Rows of ``docs`` that are not predicted toxic; every column stays."""
    return keep_rows(docs, lambda texts: [model.score(t) < 0.5 for t in texts])


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
