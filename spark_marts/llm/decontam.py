"""Benchmark decontamination by the q-gram lemma.

Texts are lower-cased and runs of white space become one space. An item is sought whole, or, beyond
``LONG`` characters, as overlapping segments, and besides, beyond ``PIECE`` characters, in overlapping
pieces (a passage of PIECE + HOP - 1 characters holds one), each within an edit budget of k = RATE of
its length; items of fewer than ``LEAST`` characters are sought verbatim. A text region within k edits of a segment of m characters shares at least m + 1 - Q * (k + 1) of its
q-grams with it, on diagonals at most k apart; so shared q-grams are counted in bands of 2 (k + 1)
diagonals that overlap by half, bands that reach the bound are retained, and a banded
alignment inside the band verifies them. Where that bound falls below 1 (25 and 26 characters),
q-grams of one character less are counted.

The benchmark travels to the tasks in chunks of at most ``chunk_chars`` characters (the bound of what
is sent); documents pass once for each chunk and nothing is shuffled.

Defined cases: null or empty text matches nothing; items that are null or blank are not sought; repeated items or rows give a row each; a null doc_id or item_id is passed
on; a document in several matches of one item gives one row, of the whole item or a segment before a
piece, with the fewest edits (ties: the earliest); other columns are ignored, or kept by ``drop_contaminated``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, map_texts, table

Q = 9
RATE = 0.08
LEAST = 20
LONG, SEGMENT, STRIDE = 240, 120, 60
PIECE, HOP = 60, 30
TABLE_BITS = 22
CHUNK_CHARS = 16 << 20
MUL = np.uint64(0x9E3779B97F4A7C15)
GAP = 0x110000  # between documents; equal to no character


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def bound_of(size, budget, q: int):
    return size + 1 - q * (budget + 1)


def gram_hashes(a: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of the q (Q or Q - 1) characters from each position on, by doubling (1, 2, 4, 8, and one more)."""
    if len(a) < q:
        return np.empty(0, np.uint64)
    h, power = a.astype(np.uint64) + np.uint64(1), MUL
    for n in (1, 2, 4):
        h = h[:-n] * power + h[n:]
        power = np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
    if q < Q:
        return h
    return h[: len(a) - Q + 1] * MUL + a[Q - 1 :]


def banded_edits(segment: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Fewest edits from the segment to a part of the region, and that part's end; start diagonals 0..len(region)-m."""
    m, width = len(segment), len(region) - len(segment)
    exact = [at for at in np.flatnonzero(region[: width] == segment[0]).tolist() if region[at + m - 1] == segment[-1] and (region[at : at + m] == segment).all()]
    if exact:
        return 0, exact[0] + m
    steps = np.arange(width)
    row = np.zeros(width, np.int64)
    for i in range(m):
        down = np.append(row[1:] + 1, m + 1)
        best = np.minimum(row + (region[i : i + width] != segment[i]), down)
        row = np.minimum.accumulate(best - steps) + steps
    at = int(row.argmin())
    return int(row[at]), m + at


class Items:
    """Segments of a benchmark chunk and the postings of their q-grams."""

    def __init__(self, items: list[tuple], q: int = Q):
        self.q, self.short, narrow = q, {}, []
        self.item, self.segments, self.piece = [], [], []
        for item, text in items:
            a = codes(normal(text or ""))
            if len(a) < LEAST:
                if len(a):
                    self.short.setdefault(len(a), {}).setdefault(normal(text), []).append(item)
                continue
            if q == Q and bound_of(len(a), int(len(a) * RATE), Q) < 1:
                narrow.append((item, text))
                continue
            spans = [(0, len(a))] if len(a) <= LONG else [(s, SEGMENT) for s in (*range(0, len(a) - SEGMENT, STRIDE), len(a) - SEGMENT)]
            pieces = [(s, PIECE) for s in (*range(0, len(a) - PIECE, HOP), len(a) - PIECE)] if len(a) > PIECE else []
            for s, size in spans + pieces:
                self.item.append(item)
                self.segments.append(a[s : s + size])
            self.piece += [False] * len(spans) + [True] * len(pieces)
        self.narrow = Items(narrow, Q - 1) if narrow else None
        sizes = np.array([len(s) for s in self.segments], np.int64)
        self.budget = (sizes * RATE).astype(np.int64)
        self.bound = np.maximum(1, bound_of(sizes, self.budget, q))
        hashes = [gram_hashes(s, q) for s in self.segments]
        flat = np.concatenate([*hashes, np.empty(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.grams, self.first = np.unique(flat[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(flat)))
        self.seg = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])[order] if hashes else np.empty(0, np.int64)
        self.off = np.concatenate([*(np.arange(len(h)) for h in hashes), np.empty(0, np.int64)]).astype(np.int64)[order]
        self.present = np.zeros(1 << TABLE_BITS, bool)
        self.present[self.slot(self.grams)] = True

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return (h * MUL) >> np.uint64(64 - TABLE_BITS)

    def matches(self, text: str) -> dict:
        """item number -> (edits, end) of its best match; positions in the normalised text."""
        text = normal(text)
        a = codes(text)
        hits = [*self.near(a), *(self.narrow.near(a) if self.narrow else []), *self.verbatim(text)]
        best: dict = {}
        for item, hit in hits:
            best[item] = min(best.get(item, hit), hit)
        return {item: hit[1:] for item, hit in best.items()}

    def verbatim(self, text: str) -> list:
        """Short items at their earliest places, as ``near`` gives them."""
        out: dict = {}
        for size, wanted in self.short.items():
            for at in range(len(text) - size + 1):
                part = text[at : at + size]
                if part in wanted and part not in out:
                    out[part] = [(item, (False, 0, at + size)) for item in wanted[part]]
        return [hit for hits in out.values() for hit in hits]

    def near(self, a: np.ndarray) -> list:
        """(item, (is a piece, edits, end)) of the segments within their budgets."""
        h = gram_hashes(a, self.q)
        if not len(self.segments) or not len(h):
            return []
        pos = np.flatnonzero(self.present[self.slot(h)])
        g = np.minimum(np.searchsorted(self.grams, h[pos]), len(self.grams) - 1)
        same = self.grams[g] == h[pos]
        pos, g = pos[same], g[same]
        if not len(pos):
            return []
        n = self.count[g]
        post = np.repeat(self.first[g] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        seg, diagonal = self.seg[post], np.repeat(pos, n) - self.off[post]
        step = self.budget[seg] + 1
        band = diagonal // step
        wide = np.int64(len(a) + 2 * LONG + 8)
        keys, found = np.unique(np.concatenate([seg * wide + band + LONG, seg * wide + band - 1 + LONG]), return_counts=True)
        out: dict = {}
        for key in keys[found >= self.bound[keys // wide]].tolist():
            s, b = key // wide, key % wide - LONG
            k, m = int(self.budget[s]), len(self.segments[s])
            start = b * (k + 1) - k
            stop = (b + 2) * (k + 1) + k + m
            region = np.full(stop - start, GAP, np.uint32)
            lo, hi = max(0, start), min(len(a), stop)
            if lo >= hi:
                continue
            region[lo - start : hi - start] = a[lo:hi]
            edits, end = banded_edits(self.segments[s], region)
            if edits <= k:
                out[s] = min(out.get(s, (k + 1, 0)), (edits, min(start + end, len(a))))
        return [(self.item[s], (self.piece[s], *hit)) for s, hit in sorted(out.items())]


def chunks(benchmark: DataFrame, chunk_chars: int):
    """The benchmark's items in chunks of about ``chunk_chars`` characters."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.select(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // chunk_chars))
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else items
        yield Items([(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()])


def find_leaks(docs: DataFrame, benchmark: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id, item_id, edits, match_end``: one row per document and item found in it."""
    out = None
    for items in chunks(benchmark, chunk_chars):

        def make(ids, texts, items=items):
            rows = [(i, item, *hit) for i, t in zip(ids, texts, strict=True) for item, hit in items.matches(t).items()]
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            return dict(zip(("doc_id", "item_id", "edits", "match_end"), cols, strict=True))

        part = map_texts(docs, "doc_id long, item_id long, edits long, match_end long", make)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Rows of ``docs`` in which no item is found; every column stays."""
    for items in chunks(benchmark, chunk_chars):
        docs = keep_rows(docs, lambda texts, items=items: [not items.matches(t) for t in texts])
    return docs


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
