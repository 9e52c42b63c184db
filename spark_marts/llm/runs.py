"""Runs of repeated words: branching squares from an enhanced suffix array.

A document's words become numbers, and the documents of a slice stand behind one another with a number of
its own after each, so that nothing repeats across documents. On the suffix array, its inverse (ISA)
and the common prefixes (LCP) of the slice:

1. Every LCP interval of depth d and its child intervals are found from the nearest smaller LCP values on
   either side. No tree is built.
2. For each suffix i of all children but the largest, i + d and i - d are looked up: if their ISA lies in
   the interval, the two suffixes share exactly d words, or else more and lie in the same child. Sharing
   exactly d means a square of period d that the next word breaks: a branching square.
3. A branching square is rotated to the left as long as the words one period apart agree. Squares that
   give the same stretch are one run, whose period is the smallest of theirs.

A run is kept if its length is at least ``max(least, times * period)``, so ``times`` must be 2 or more.

Defined cases: null or empty text has no words and no run; a repeated row gives a repeated result; a null
``doc_id`` is passed on; other columns are ignored; an empty table gives an empty result. A text of any
length is one slice at most, with about 150 bytes of memory a word.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, ship, table

LEAST, TIMES = 24, 3
SLICE_WORDS = 1 << 17
CHECKS = 1 << 20  # suffixes checked at a time


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, rank)`` of the suffixes of small non-negative numbers: pairs of ranks with doubled reach, unsorted groups only."""
    n, reach = len(s), 2
    key = s * (int(s.max()) + 2) + np.append(s[1:] + 1, 0)
    order = np.argsort(key)
    new = np.append(True, key[order][1:] != key[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    left = np.arange(n)
    while True:
        left = left[~(new[left] & np.append(new, True)[left + 1])]
        if not len(left):
            return order, rank
        at = order[left]
        ahead = np.where(at + reach < n, rank[np.minimum(at + reach, n - 1)], -1)
        by = np.argsort(rank[at] * (n + 1) + ahead)
        at, ahead = at[by], ahead[by]
        group = rank[at]
        split = np.append(True, (group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1]))
        order[left], new[left] = at, split
        rank[at] = left[np.maximum.accumulate(np.where(split, np.arange(len(left)), 0))]
        reach *= 2


def common_prefixes(s: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Words that the suffixes at places k - 1 and k of ``order`` share (0 at place 0): Kasai's values.

    Kasai walks the text; where the left neighbour of the next suffix is the next position as well, the
    value falls by one. Only the last position of such a stretch is measured here, all at once.
    """
    n = len(s)
    front = np.full(n, -1, np.int64)  # the suffix in front, by position
    front[order[1:]] = order[:-1]
    falls = np.append((front[:-1] >= 0) & (front[1:] == front[:-1] + 1) & (s[:-1] == s[np.maximum(front[:-1], 0)]), False)
    last = np.flatnonzero(~falls & (front >= 0))
    other, shared = front[last], np.zeros(len(last), np.int64)
    wide, go = np.append(s, -1), np.arange(len(last))
    while len(go):
        go = go[wide[last[go] + shared[go]] == wide[other[go] + shared[go]]]
        shared[go] += 1
    value = np.zeros(n, np.int64)
    value[last] = shared
    end = np.minimum.accumulate(np.where(falls, n, np.arange(n))[::-1])[::-1]
    inner = np.flatnonzero(falls)
    value[inner] = value[end[inner]] + end[inner] - inner
    return value[order]


def nearest_smaller(v: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``places`` the next place to its left and to its right with a smaller value (-1 and len if none)."""
    n = len(v)
    levels = [v.astype(np.int32)]  # minima of 1, 2, 4, ... values
    while 2 << (len(levels) - 1) <= n:
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    left, right, v = places.copy(), places + 1, v[places]
    for j in range(len(levels) - 1, -1, -1):
        low, size = levels[j], 1 << j
        go = np.flatnonzero(left >= size)
        left[go[low[left[go] - size] >= v[go]]] -= size
        go = np.flatnonzero(right + size <= n)
        right[go[low[right[go]] >= v[go]]] += size
    return left - 1, right


def branching_squares(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(start, period)`` of the squares that the word after them breaks; each once."""
    n = len(s)
    order, rank = suffix_array(s)
    shared = common_prefixes(s, order, rank)
    cut = np.flatnonzero(shared > 0)  # places where two children of an interval meet
    (low, high), depth = nearest_smaller(shared, cut), shared[cut]
    by = np.argsort(low * (n + 1) + high, kind="stable")
    cut, low, high, depth = cut[by], low[by], high[by], depth[by]
    if not len(cut):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))
    final = np.append(first[1:], True)
    # children: from the cut before (or the interval's low end) to each cut, and from the last cut to the high end
    begin = np.where(first, low, np.append(0, cut[:-1]))
    begin, end = np.concatenate([begin, cut[final]]), np.concatenate([cut, high[final]])
    group = np.cumsum(first) - 1
    group = np.concatenate([group, group[final]])
    low, high, depth = (np.concatenate([x, x[final]]) for x in (low, high, depth))
    by = np.lexsort((begin - end, group))  # the largest child first
    small = by[~np.append(True, group[by][1:] != group[by][:-1])]
    begin, end, low, high, depth = (x[small] for x in (begin, end, low, high, depth))
    found = []
    sizes = np.cumsum(end - begin)
    at = 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHECKS, "right")))
        size = (end - begin)[at:to]
        child = np.repeat(np.arange(at, to), size)
        place = np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + begin[child]
        i, d = order[place], depth[child]
        for start, other in ((i, i + d), (i - d, i - d)):
            ok = np.flatnonzero((other >= 0) & (other < n))
            r, c = rank[other[ok]], child[ok]
            hit = ok[(r >= low[c]) & (r < high[c]) & ((r < begin[c]) | (r >= end[c]))]
            found.append((start[hit], d[hit]))
        at = to
    start, period = (np.concatenate(x) for x in zip(*found, strict=True))
    key = np.unique(start * (n + 1) + period)
    return key // (n + 1), key % (n + 1)


def rotated(s: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How far each square can be rotated to the left: the start of its stretch."""
    at, go = start.copy(), np.arange(len(start))
    for _ in range(64):
        go = go[at[go] > 0]
        go = go[s[at[go] - 1] == s[at[go] - 1 + period[go]]]
        at[go] -= 1
        if not len(go):
            return at
    for g in go.tolist():  # the long ones in slices of doubling size
        a, d, size = int(at[g]), int(period[g]), 64
        while a:
            low = max(0, a - size)
            differ = np.flatnonzero(s[low:a] != s[low + d : a + d])
            if len(differ):
                a = low + int(differ[-1]) + 1
                break
            a, size = low, size * 2
        at[g] = a
    return at


def runs_of(s: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """``(start, end, period)`` rows of all runs of at least ``max(least, times * period)`` words, by start, then period."""
    start, period = branching_squares(s) if len(s) > 1 else (np.empty(0, np.int64),) * 2
    end = start + 2 * period
    by = np.lexsort((period, end))
    start, period, end = start[by], period[by], end[by]
    out = []
    while len(start):  # of each end the smallest period left; its multiples inside the stretch are the same run
        head = np.append(True, end[1:] != end[:-1])
        first, p, e = rotated(s, start[head], period[head]), period[head], end[head]
        out.append(np.column_stack([first, e, p]))
        of = np.cumsum(head) - 1
        rest = ~head & ~((period % p[of] == 0) & (start >= first[of]))
        start, period, end = start[rest], period[rest], end[rest]
    if not out:
        return np.empty((0, 3), np.int64)
    runs = np.concatenate(out)
    runs = runs[runs[:, 1] - runs[:, 0] >= np.maximum(least, times * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def slices(words: list[list]):
    """``(first, last)`` of consecutive documents of about SLICE_WORDS words, one document at least."""
    at = 0
    while at < len(words):
        to, size = at + 1, len(words[at])
        while to < len(words) and size + len(words[to]) <= SLICE_WORDS:
            size += len(words[to])
            to += 1
        yield at, to
        at = to


class Numbers(dict):
    """A number for each word, in order of first sight."""

    def __missing__(self, word) -> int:
        n = self[word] = len(self)
        return n


def runs_of_documents(words: list[list], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """Per document its ``(start, end, period)`` rows, in words."""
    out: list = []
    for at, to in slices(words):
        number = Numbers()
        begins = np.cumsum([0, *(len(w) + 1 for w in words[at:to])])
        s = np.empty(begins[-1], np.int64)
        for doc, begin in zip(words[at:to], begins.tolist(), strict=False):
            s[begin : begin + len(doc)] = np.fromiter(map(number.__getitem__, doc), np.int64, len(doc))
        s[begins[1:] - 1] = len(number) + np.arange(to - at)  # behind each document a word of its own
        runs = runs_of(s, least, times)
        cuts = np.searchsorted(runs[:, 0], begins)
        out += [runs[cuts[k] : cuts[k + 1]] - [begins[k], begins[k], 0] for k in range(to - at)]
    return out


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """``(start, length, period)`` of the greatest length / period, exactly; ties to the smallest start, then period."""
    best = None
    for start, end, period in runs.tolist():
        if best is None or (end - start) * best[2] > best[1] * period:
            best = (start, end - start, period)
    return best


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds beyond its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    return [w for w, d in zip(words, np.cumsum(depth).tolist(), strict=False) if not d]


FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, best struct<start:long,length:long,period:long>, text string"


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, edit: Callable | None = None) -> DataFrame:
    """One row per document: its runs by start, then period, the strongest one, and the text without repeats.

    ``edit(doc_id, words)`` may change a document's words beforehand. ``text`` is the kept words joined by spaces.
    """
    ship(docs.sparkSession)
    fields = ("start", "length", "period")

    def make(ids, texts):
        words = [t.encode().split() for t in texts]
        if edit:
            words = [edit(i, w) for i, w in zip(ids, words, strict=True)]
        found = runs_of_documents(words, least, times)
        best = [strongest(r) for r in found]
        return {
            "doc_id": ids,
            "n_words": [len(w) for w in words],
            "runs": [[dict(zip(fields, (s, e - s, p), strict=True)) for s, e, p in r.tolist()] for r in found],
            "best": [b and dict(zip(fields, b, strict=True)) for b in best],
            "text": [b" ".join(collapsed(w, r)).decode() for w, r in zip(words, found, strict=True)],
        }

    return map_texts(docs, FOUND, make)


def repeat_some(doc_id: int | None, words: list) -> list:
    """The contract's rule: in one document of ten, by crc32 of doc_id, the words from some word on repeat."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * -(-(n - a) // p))[: n - a]


def op11_word_runs(spark, sf_dir: str) -> DataFrame:
    found = find_runs(table(spark, sf_dir, "documents"), edit=repeat_some)
    line = lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


# DuckDB: a run repeats at least 16 words one period on, so equal 16-word strings of a text propose the periods.
ORACLE_SQL = r"""
WITH hashed AS (
  SELECT doc_id, row_number() OVER () AS row,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         xor(4294967295::UBIGINT, list_reduce(
           [4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT),
           lambda c, x: list_reduce([xor(c, x)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0], lambda d, z:
             CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384::UBIGINT) ELSE d // 2 END)))::BIGINT AS h
  FROM documents),
sized AS (SELECT doc_id, row, w, len(w) AS n, h // 10 AS g, h % 10 = 0 AND len(w) > 0 AS edit FROM hashed),
planned AS (SELECT *, CASE WHEN edit THEN g % n END AS a FROM sized),
texts AS MATERIALIZED (
  SELECT doc_id, row, n, CASE WHEN edit THEN list_transform(range(n), lambda i:
           w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w
  FROM planned),
grams AS MATERIALIZED (
  SELECT row, n, i, array_to_string(w[i + 1 : i + 16], ' ') AS gram
  FROM (SELECT row, n, w, unnest(range(n - 15)) AS i FROM texts WHERE n >= 24)),
again AS (SELECT row FROM grams GROUP BY row HAVING count(DISTINCT gram) < count(*)),
keyed AS MATERIALIZED (SELECT row || ':' || gram AS gram, row, n, i FROM grams WHERE row IN (SELECT row FROM again)),
pairs AS (SELECT x.row, x.i, y.i - x.i AS q FROM keyed x JOIN keyed y ON x.gram = y.gram WHERE y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM pairs),
runs AS MATERIALIZED (
  SELECT row, start, length, min(q) AS period
  FROM (SELECT row, q, min(i) AS start, count(*) + 15 + q AS length FROM islands GROUP BY row, q, island)
  WHERE length >= greatest(24, 3 * q) GROUP BY row, start, length),
best AS (
  SELECT * FROM runs
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY 1000000000000::HUGEINT * length // period DESC, start, period) = 1),
listed AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS list
  FROM runs GROUP BY row),
gone AS (SELECT row, list(DISTINCT i) AS gone FROM (SELECT row, unnest(range(start + period, start + length)) AS i FROM runs) GROUP BY row),
words AS (
  SELECT t.row, string_agg(word, ' ' ORDER BY i) AS kept
  FROM (SELECT row, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts WHERE row IN (SELECT row FROM gone)) t JOIN gone USING (row)
  WHERE NOT list_contains(gone, i) GROUP BY t.row)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
       sha256(coalesce(list, '')) AS runs_sha256,
       sha256(coalesce(CASE WHEN n_runs > 0 THEN kept ELSE array_to_string(w, ' ') END, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed USING (row) LEFT JOIN best b USING (row) LEFT JOIN words USING (row)
"""
