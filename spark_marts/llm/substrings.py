"""Exact substring dedup with sharded suffix arrays.

A byte goes if a WINDOW-byte string that covers it also starts in a document with a smaller doc_id.

0. Copies. A row of WINDOW bytes or more whose whole text (by SHA-256) a smaller doc_id has too loses all of it,
   and whatever it holds stands in that document as well: it is cut whole and takes no part in what follows.
1. Candidates. Every window has an anchor, its leftmost 16-byte gram of smallest hash, and reaches at
   least SIDE bytes beyond it on one side, so equal windows have equal anchors and an equal *side*
   (the gram with those bytes). Blocks of documents send short prints of their distinct sides to the
   print's shard, which answers those found in two documents; a collision only adds candidates.
2. Shards. The text around such an anchor (all windows that have it and a repeated side: a *piece*)
   goes to the anchor's shard, once a block, with the places where it stands. A shard merges equal
   pieces and builds suffix arrays over parts of at most ``part_bytes``: Larsson-Sadakane refinement
   (sort by a packed prefix, then by pairs of ranks with doubled reach, only groups that are still
   unsorted), Kasai's common prefixes with one lane a piece. Neighbours that share a whole window form
   a run, with the smallest doc_id in it. Runs of several parts are merged by binary search in their
   sorted windows.
3. Blocks get back which windows of which rows go, and cut. Both steps number the rows of a block by
   (doc_id, text), so no hash is computed again.

Every block sends every shard a message, so on large inputs blocks hold more text, and a shard is dealt
by anchor into parts of its own that its task handles one after the other; a shard answers all its messages at once.

Equal windows always meet in one shard, and a passage that a third of all documents hold reaches it
once per block of documents. A run of one character is one piece with many places.

Defined cases: null or empty text, or under WINDOW bytes, loses nothing; rows that share a doc_id are
one document and take nothing from each other; rows with a null doc_id neither lose bytes nor take
any from others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import BLOCK_BYTES, block_docs, blocks_for, by_cogroup, by_group, mix, split_by, table, texts_of, unpack

WINDOW, GRAM = 50, 16
REACH = WINDOW - GRAM + 1  # grams in a window
SIDE = (WINDOW - GRAM) // 2  # a window goes on for SIDE bytes behind its anchor, or for more before it
PRINT_BITS = 31
PART_BYTES = 2 << 20
MANY = 256  # blocks, and shards, that are enough work for a cluster; beyond them they grow first
BLOCK_GROWTH, SHARD_GROWTH = 2, 4
CHUNK = 1 << 15
COPIES = -1  # in place of a shard: the payload is the SHA-256 and the doc_id of a copy
HIGH = np.uint64(0xFFFFFFFF00000000)
NONE = np.iinfo(np.int64).max
MUL = np.uint64(0x9E3779B97F4A7C15)


def packed(a: np.ndarray, n: int, bits: int) -> np.ndarray:
    """``n`` symbols from each position on, packed big end first; beyond the end are zeros."""
    out = np.zeros(len(a), np.uint64)
    wide = np.append(a.astype(np.uint64), np.zeros(n, np.uint64))
    for i in range(n):
        out = (out << np.uint64(bits)) | wide[i : i + len(a)]
    return out


def eights(a: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number (an unaligned view)."""
    return np.ndarray(len(a) - 7, np.dtype("<u8"), a, strides=(1,))


def gram_hash(a: np.ndarray) -> np.ndarray:
    g = eights(a)
    h = g[:-8] * MUL + g[8:]
    h ^= h >> np.uint64(29)
    h *= MUL
    h ^= h >> np.uint64(32)
    return h


class Block:
    """The texts of a block end to end; rows are numbered by (doc_id, text), whatever order they came in."""

    def __init__(self, t: pa.Table, told: pa.Table):
        docs, texts = t.column("doc_id").to_pylist(), [v.encode() for v in t.column("text").to_pylist()]
        order = sorted(range(len(docs)), key=lambda i: (docs[i] is None, docs[i] or 0, texts[i]))
        self.docs, self.texts = [docs[i] for i in order], [texts[i] for i in order]
        self.owner = np.array([d or 0 for d in self.docs], np.int64)
        copies: dict = {}
        for p in told.filter(pc.equal(told.column("shard"), COPIES)).column("payload").to_pylist():
            copies.setdefault(int.from_bytes(p[32:], "big", signed=True), set()).add(p[:32])
        self.copy = np.array([d in copies and sha256(x).digest() in copies[d] for d, x in zip(self.docs, self.texts, strict=True)], bool)
        self.known = np.array([d is not None for d in self.docs], bool) & ~self.copy
        self.sizes = np.array([len(x) for x in self.texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.raw = b"".join(self.texts)
        self.bytes = np.frombuffer(self.raw, np.uint8)

    def runs(self) -> tuple[np.ndarray, ...]:
        """``(row, first window, last window, anchor)`` of each run of windows with one anchor, as places in the block."""
        a, firsts, places, last = self.bytes, [], [], -1
        for at in range(0, len(a) - WINDOW + 1, CHUNK):
            h = gram_hash(a[at : at + CHUNK + WINDOW - 1])
            least = (h & HIGH) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the leftmost
            for n in (1, 2, 4, 8, 16, REACH - 32):
                least = np.minimum(least[n:], least[:-n])
            place = (least & ~HIGH).astype(np.int64)
            new = np.append(place[0] + at != last, place[1:] != place[:-1])
            i, j = np.searchsorted(self.starts, (at, at + len(new)))
            new[self.starts[i:j] - at] = True
            first = np.flatnonzero(new)
            firsts.append(first + at)
            places.append(place[first] + at)
            last = place[-1] + at
        if not firsts:
            return (np.empty(0, np.int64),) * 4
        first, place = np.concatenate(firsts), np.concatenate(places)
        row = np.searchsorted(self.starts, first, "right") - 1
        end = np.minimum(np.append(first[1:] - 1, len(a) - WINDOW), (self.starts + self.sizes)[row] - WINDOW)
        keep = (end >= first) & self.known[row]
        return row[keep], first[keep], end[keep], place[keep]

    def sides(self, first: np.ndarray, last: np.ndarray, place: np.ndarray, shards: int) -> list:
        """``(which runs, their prints)`` for the side behind the anchor, then for the one before it.

        A print is the shard's number followed by PRINT_BITS bits.
        """
        out, g = [], eights(self.bytes) if len(first) else None
        behind, before = (0, 8, 16, SIDE + GRAM - 8), (-SIDE - 1, -SIDE + 7, -SIDE + 15, -SIDE + 23, GRAM - 8)
        for has, ats in ((last >= place - SIDE, behind), (first < place - SIDE, before)):
            which = np.flatnonzero(has)
            h = np.zeros(len(which), np.uint64)
            for at in ats:
                h = mix((h ^ g[place[which] + at]) * MUL) if len(which) else h
            out.append((which, (h % np.uint64(shards) << np.uint64(PRINT_BITS)) | (h >> np.uint64(64 - PRINT_BITS))))
        return out


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffixes of ``s`` (symbols 0..256) in order, by Larsson-Sadakane refinement."""
    n, reach = len(s), 7
    key = packed(s, reach, 9)
    order = np.argsort(key)
    new = np.append(True, key[order][1:] != key[order][:-1])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while True:
        ends = np.append(new[1:], True)
        left = np.flatnonzero(~(new & ends))  # places in groups that are still unsorted
        if not len(left):
            return order
        at = order[left]
        ahead = rank[np.minimum(at + reach, n)]
        by = np.argsort(rank[at] * (n + 1) + ahead)
        order[left], ahead = at[by], ahead[by]
        group = rank[order[left]]
        split = np.append(True, (group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1]))
        new[left] = split
        rank[order[left]] = left[np.maximum.accumulate(np.where(split, np.arange(len(left)), 0))]
        reach *= 2


def common_prefixes(s: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Kasai: what each suffix shares with the one before it in order, up to WINDOW; a lane for each piece."""
    before = np.empty(len(s), np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    end = np.append(s, np.full(WINDOW + 1, 300, s.dtype))
    out = np.zeros(len(s), np.int64)
    lane = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[lane], sizes[lane]
    shared = np.zeros(len(starts), np.int64)
    for j in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -j, "left"))  # pieces longer than j
        at = starts[:n] + j
        prev = before[at]
        know = np.maximum(shared[:n] - 1, 0)
        know[prev < 0] = 0
        go = np.flatnonzero((prev >= 0) & (know < WINDOW))
        while len(go):
            go = go[end[at[go] + know[go]] == end[prev[go] + know[go]]]
            know[go] += 1
            go = go[know[go] < WINDOW]
        out[at] = know
        shared[:n] = know
    return out[order]


class Part:
    """Suffix array over some pieces: windows of equal text form runs."""

    def __init__(self, pieces: list[bytes], docs: np.ndarray):
        sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(np.append(0, sizes[:-1] + 1))
        s = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int16) + 1
        s[self.starts + sizes] = 0
        order = suffix_array(s)
        shared = common_prefixes(s, order, self.starts, sizes)
        piece = np.repeat(np.arange(len(pieces)), sizes + 1)
        left = self.starts[piece] + sizes[piece] - np.arange(len(s))
        whole = left[order] >= WINDOW
        self.at = order[whole]  # whole windows in order; equal ones share a prefix of WINDOW throughout
        joined = shared >= WINDOW
        run = np.cumsum(~joined)[whole]
        first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        self.run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(run))))
        self.least = np.minimum.reduceat(docs[piece[self.at]], first)
        self.text, self.first = s, first
        self.whole = np.flatnonzero(left >= WINDOW)

    def windows(self) -> np.ndarray:
        """The sorted distinct windows as fixed-width strings (a closing byte keeps their zeros)."""
        from numpy.lib.stride_tricks import sliding_window_view

        rows = sliding_window_view(self.text, WINDOW)[self.at[self.first]] - 1
        return np.hstack([rows.astype(np.uint8), np.ones((len(rows), 1), np.uint8)]).copy().view(f"S{WINDOW + 1}").ravel()

    def by_position(self, least: np.ndarray) -> np.ndarray:
        out = np.full(len(self.text), NONE, np.int64)
        out[self.at] = least[self.run]
        return out


def merge_parts(parts: list[Part]) -> None:
    """Gives equal windows of different parts one smallest doc_id, by binary search among sorted windows."""
    keys, least = parts[0].windows(), parts[0].least.copy()
    for part in parts[1:]:
        own = part.windows()
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        same = keys[at] == own
        least[at[same]] = np.minimum(least[at[same]], part.least[same])
        keys, least = np.append(keys, own[~same]), np.append(least, part.least[~same])
        by = np.argsort(keys, kind="stable")
        keys, least = keys[by], least[by]
    for part in parts:
        part.least = least[np.searchsorted(keys, part.windows())]


def window_minima(names: list[bytes], docs: np.ndarray, part_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest doc_id of every window of the pieces, end to end, and where each piece begins there."""
    parts, at = [], 0
    while at < len(names):
        stop, size = at, 0
        while stop < len(names) and (stop == at or size + len(names[stop]) < part_bytes):
            size += len(names[stop]) + 1
            stop += 1
        parts.append(Part(names[at:stop], docs[at:stop]))
        at = stop
    if len(parts) > 1:
        merge_parts(parts)
    least = [part.by_position(part.least)[part.whole] for part in parts]
    begins = np.cumsum([0, *(len(p) - WINDOW + 1 for p in names)])
    return np.concatenate(least), begins


def going(least: np.ndarray, begins: np.ndarray, piece: np.ndarray, row: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, first window, last window)`` of the windows that a smaller doc_id has too, a piece at each place;
    and which place each comes from."""
    low, high = np.minimum.reduceat(least, begins[:-1]), np.maximum.reduceat(least, begins[:-1])
    size = np.diff(begins)
    every = np.flatnonzero(high[piece] < doc)
    out, come = [np.stack([row[every], at[every], at[every] + size[piece[every]] - 1], 1)], [every]
    some = np.flatnonzero((low[piece] < doc) & (high[piece] >= doc))
    for some in np.split(some, range(CHUNK, len(some), CHUNK)):
        n = size[piece[some]]
        own = np.repeat(np.arange(len(some)), n)
        step = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        hit = least[begins[piece[some]][own] + step] < doc[some][own]
        opens = hit & ~(np.append(False, hit[:-1]) & (step > 0))[: len(hit)]
        closes = hit & ~(np.append(hit[1:], False) & np.append(step[1:] > 0, False))[: len(hit)]
        first, last = np.flatnonzero(opens), np.flatnonzero(closes)
        of = some[own[first]]
        out.append(np.stack([row[of], at[of] + step[first], at[of] + step[last]], 1))
        come.append(of)
    return np.concatenate(out).astype(np.int32), np.concatenate(come)


def short(a: np.ndarray) -> bytes:
    """Whole numbers as the smallest, and the differences to it in as few bytes as hold them all."""
    a = a.astype(np.int64)
    least = a.min(initial=NONE)
    over = (a - least).view(np.uint64)
    kind = np.min_scalar_type(over.max(initial=0))
    return least.tobytes() + np.uint8(kind.itemsize).tobytes() + over.astype(kind).tobytes()


def long(body: bytes) -> np.ndarray:
    return (np.frombuffer(body, f"<u{body[8]}", offset=9).astype(np.uint64) + np.frombuffer(body, np.uint64, 1)).view(np.int64)


def pieces_of(block: Block, wanted: np.ndarray, shards: int, subs: int = 1) -> list[tuple]:
    """``(shard, part, pieces, places of each, rows, places in the text)``: pieces whose sides are ``wanted``.

    A shard has ``subs`` parts; equal windows have equal anchors, so they meet in one of them.
    """
    row, first, last, place = block.runs()
    found = []
    for which, prints in block.sides(first, last, place, shards):
        hit = np.zeros(len(first), bool)
        if len(wanted):
            hit[which] = wanted[np.minimum(np.searchsorted(wanted, prints), len(wanted) - 1)] == prints
        found.append(hit)
    behind, before = found
    lo = np.where(before, first, np.maximum(first, place - SIDE))
    hi = np.where(behind, last, np.minimum(last, place - SIDE - 1))
    at = np.flatnonzero(behind | before)
    if not len(at):
        return []
    row, lo, hi, place = row[at], lo[at], hi[at], place[at]
    # in a run of one character each window equals the one before it
    level = np.append(0, np.cumsum(block.bytes[1:] == block.bytes[:-1], dtype=np.int32))
    one = (lo == hi) & (level[np.minimum(lo + WINDOW - 1, len(level) - 1)] - level[np.maximum(lo - 1, 0)] == WINDOW)
    again = np.append(False, one[1:] & (lo[1:] == lo[:-1] + 1) & (lo == hi)[:-1] & (row[1:] == row[:-1]))
    texts: dict = {}
    raw, ids, heads = block.raw, [], np.flatnonzero(~again)
    for a, b in zip(lo[heads].tolist(), (hi[heads] + WINDOW).tolist(), strict=True):
        ids.append(texts.setdefault(raw[a:b], len(texts)))
    piece = np.array(ids, np.int64)[np.cumsum(~again) - 1]
    shard = np.empty(len(texts), np.int64)
    g = eights(block.bytes)
    shard[piece] = (mix(g[place] * MUL + g[place + 8]) % np.uint64(shards * subs)).astype(np.int64)
    shard, part = np.divmod(shard, subs)
    names, order = list(texts), np.argsort(piece, kind="stable")
    counts = np.bincount(piece, minlength=len(names))
    ends = np.cumsum(counts)
    out = []
    for s, own in split_by(shard, shards):
        n = counts[own]
        of = np.repeat(ends[own] - np.cumsum(n), n) + np.arange(n.sum())  # places of the shard's pieces, piece by piece
        of = order[of]
        out.append((s, part[own], [names[i] for i in own.tolist()], n, row[of], lo[of] - block.starts[row[of]]))
    return out


def dealt(total: int) -> tuple[int, int, int]:
    """Blocks of the text, shards, and parts of a shard; their product, the messages, grows slowly."""
    least = blocks_for(total)
    grown = lambda by: max(min(least, MANY), -(-total // (BLOCK_BYTES * by)))
    shards = grown(SHARD_GROWTH)
    return grown(BLOCK_GROWTH), shards, -(-least // shards)


def copies_of(rows: DataFrame, n_blocks: int) -> DataFrame:
    """``shard, block, payload`` of each row whose text a smaller doc_id has."""
    firsts = rows.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    later = rows.join(materialize(firsts, "firsts"), "sha").where("doc_id > first")  # a join of its own, so that a text of many rows is split
    name = F.concat("sha", F.unhex(F.lpad(F.hex("doc_id"), 16, "0"))).alias("payload")
    return materialize(later.select(F.lit(COPIES).cast("long").alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).alias("block"), name), "copies")


def dedup_substrings(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes)."""
    flat = texts_of(docs)
    size = F.octet_length("text")
    rows = materialize(flat.select("doc_id", size.alias("n"), F.when(size >= WINDOW, F.unhex(F.sha2("text", 256))).alias("sha")), "text-hashes")
    n_blocks, shards, subs = dealt(rows.select(F.sum("n")).first()[0] or 0)
    blocks = block_docs(flat, n_blocks)
    copies = copies_of(rows.where("sha IS NOT NULL AND doc_id IS NOT NULL").select("sha", "doc_id"), n_blocks)
    low_bits = np.uint64((1 << PRINT_BITS) - 1)

    def send_sides(t: pa.Table, told: pa.Table) -> dict:
        if not t.num_rows:
            return {"shard": [], "block": [], "payload": []}
        block = Block(t, told)
        row, first, last, place = block.runs()
        sides = block.sides(first, last, place, shards)
        prints = np.concatenate([p for _, p in sides])
        owner = block.owner[row[np.concatenate([w for w, _ in sides])]]
        order = np.argsort(prints)
        prints, owner = prints[order], owner[order]
        new = np.append(True, prints[1:] != prints[:-1])[: len(prints)]
        heads = np.flatnonzero(new)
        other = np.append(False, owner[1:] != owner[:-1])[: len(prints)] & ~new
        several = np.logical_or.reduceat(other, heads) if len(heads) else other
        sent = (((prints[heads] & low_bits) << np.uint64(1)) | several).astype(np.uint32)
        shard, at = np.unique(prints[heads] >> np.uint64(PRINT_BITS), return_index=True)
        return {"shard": shard.astype(np.int64), "block": [t.column("block")[0].as_py()] * len(shard), "payload": [p.tobytes() for p in np.split(sent, at[1:])][: len(shard)]}

    def repeated(t: pa.Table) -> dict:
        flat, ends = unpack(t.column("payload").to_pylist(), np.uint32)
        keys, several = flat >> np.uint32(1), (flat & np.uint32(1)).astype(bool)
        ordered = np.sort(keys)
        twice = np.union1d(ordered[1:][ordered[1:] == ordered[:-1]], keys[several])
        hit = twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys if len(twice) else np.zeros(len(keys), bool)
        replies = [keys[a:b][hit[a:b]].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
        has = pa.array([i for i, r in enumerate(replies) if r], pa.int64())
        return {"block": t.column("block").take(has), "shard": t.column("shard").take(has), "payload": [r for r in replies if r]}

    def send_pieces(texts: pa.Table, told: pa.Table) -> dict:
        answers = told.filter(pc.not_equal(told.column("shard"), COPIES))
        own, ends = unpack(answers.column("payload").to_pylist(), np.uint32)
        of = np.repeat(np.array(answers.column("shard").to_pylist(), np.uint64), np.diff(ends))
        wanted = np.sort((of << np.uint64(PRINT_BITS)) | own)
        cols: dict = {c: [] for c in ("shard", "block", "parts", "sizes", "body", "counts", "rows", "places", "docs")}
        block = Block(texts, told)
        for shard, part, names, counts, row, at in pieces_of(block, wanted, shards, subs):
            packs = [short(part), short(np.array([len(n) for n in names])), b"".join(names), short(counts), short(row), short(at), short(block.owner[row])]
            for c, value in zip(cols, (shard, texts.column("block")[0].as_py(), *packs), strict=True):
                cols[c].append(value)
        return cols

    def minima(t: pa.Table) -> dict:
        names: dict = {}
        pieces, parts = [], []
        for part, sizes, body, counts in zip(*(t.column(c).to_pylist() for c in ("parts", "sizes", "body", "counts")), strict=True):
            ends = np.cumsum(np.append(0, long(sizes))).tolist()
            own = np.array([names.setdefault(body[a:b], len(names)) for a, b in zip(ends, ends[1:], strict=False)], np.int64)
            pieces.append(np.repeat(own, long(counts)))
            parts.append((own, long(part)))
        row, at, doc = (np.concatenate([long(b) for b in t.column(c).to_pylist()]) for c in ("rows", "places", "docs"))
        message, piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces]), np.concatenate(pieces)
        part, texts = np.empty(len(names), np.int64), list(names)
        part[np.concatenate([own for own, _ in parts])] = np.concatenate([of for _, of in parts])
        first = np.full(len(names), NONE, np.int64)
        np.minimum.at(first, piece, doc)
        sent = [[] for _ in pieces]
        place = np.empty(len(names), np.int64)
        for _, own in split_by(part, subs):
            least, begins = window_minima([texts[i] for i in own.tolist()], first[own], part_bytes)
            place[own] = np.arange(len(own))
            here = np.flatnonzero(part[piece] == part[own[0]])
            spans, come = going(least, begins, place[piece[here]], row[here], at[here], doc[here])
            for i, which in split_by(message[here[come]], len(pieces)) if len(come) else ():
                sent[i].append(spans[which].tobytes())
        has = pa.array([i for i, r in enumerate(sent) if r], pa.int64())
        return {"shard": t.column("shard").take(has), "block": t.column("block").take(has), "payload": [b"".join(r) for r in sent if r]}

    def cut(texts: pa.Table, replies: pa.Table) -> dict:
        block = Block(texts, replies)
        replies = replies.filter(pc.not_equal(replies.column("shard"), COPIES))
        row, first, last = unpack(replies.column("payload").to_pylist(), np.int32)[0].reshape(-1, 3).astype(np.int64).T
        covers = np.zeros(len(block.bytes) + 1, np.int32)
        np.add.at(covers, block.starts[row] + first, 1)
        np.add.at(covers, block.starts[row] + last + WINDOW, -1)
        np.add.at(covers, block.starts[block.copy], 1)
        np.add.at(covers, (block.starts + block.sizes)[block.copy], -1)
        gone = np.cumsum(covers)[:-1] > 0
        opens = gone & ~np.append(False, gone[:-1])[: len(gone)]
        inner = block.starts[block.sizes > 0]
        opens[inner] = gone[inner]
        total = lambda flags: np.diff(np.append(0, np.cumsum(flags))[np.append(block.starts, len(gone))])
        removed, spans = total(gone), total(opens)
        kept = [x if not n else block.bytes[a : a + len(x)][~gone[a : a + len(x)]].tobytes() for x, n, a in zip(block.texts, removed.tolist(), block.starts.tolist(), strict=True)]
        return {"doc_id": block.docs, "n_bytes": block.sizes, "n_removed": removed, "n_spans": spans, "kept": kept}

    asked = "shard long, block long, payload binary"
    sent = blocks.groupBy("block").cogroup(copies.groupBy("block")).applyInArrow(by_cogroup(asked, send_sides), asked)
    told = sent.groupBy("shard").applyInArrow(by_group(asked, repeated), asked).unionByName(copies)
    carried = "shard long, block long, parts binary, sizes binary, body binary, counts binary, rows binary, places binary, docs binary"
    pieces = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(by_cogroup(carried, send_pieces), carried)
    replies = pieces.groupBy("shard").applyInArrow(by_group(asked, minima), asked).unionByName(copies)
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(by_cogroup(out, cut), out)


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
