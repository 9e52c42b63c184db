"""Line dedup through sharded minimal perfect hashes.

Every block of documents sends its distinct line hashes (128 bits), packed, to the shard of each
hash. A shard gathers the distinct lines, builds a minimal perfect hash over them and fills compact
arrays at its indexes: a fingerprint, the number of documents and the smallest doc_id. The blocks'
lines then probe these arrays, and only lines found in two documents or more are answered. No
line is joined, and a line that a third of all documents hold costs a shard one entry per block.

Defined cases: null or empty text is one empty line; lines with keys under ``least`` code points stay;
rows that share a doc_id are one document (its lines all stay where it is the smallest); rows with a
null doc_id neither count nor lose lines; an empty table gives an empty result; other columns
are ignored, or passed through by ``keep_columns``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .common import arrow_schema, as_table, blocks_for, by_group, mix, ship, split_by, table, text_bytes

BLANK = " \t\n\r\x0b\x0c"
LEAST = 10
SENT = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8"), ("n", "<i4")])
ANSWER = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8")])


class PerfectHash:
    """Minimal perfect hash: at each level the keys alone at their position settle there, the rest go on."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, gamma: float = 2.0):
        self.sizes, bits, left = [], [], np.arange(len(h1))
        while len(left):
            size = max(8, int(gamma * len(left)))
            at = self.place(h1[left], h2[left], len(self.sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            self.sizes.append(size)
            left = left[~alone[at]]
        self.bits = np.concatenate(bits) if bits else np.zeros(0, bool)
        self.rank = np.cumsum(self.bits, dtype=np.int64) - 1

    @staticmethod
    def place(h1, h2, level: int, size: int) -> np.ndarray:
        return (mix(h1 ^ mix(h2 + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """0..n-1 for keys it was built from; any index, or -1, for others."""
        out, left, base = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = base + self.place(h1[left], h2[left], level, size)
            out[left[self.bits[at]]] = self.rank[at[self.bits[at]]]
            left, base = left[~self.bits[at]], base + size
        return out


class LineIndex:
    """Arrays over the distinct lines of a shard, addressed by a perfect hash."""

    def __init__(self, sent: np.ndarray):
        sent = sent[np.lexsort((sent["h2"], sent["h1"]))]
        new = np.append(True, (sent["h1"][1:] != sent["h1"][:-1]) | (sent["h2"][1:] != sent["h2"][:-1])) if len(sent) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        keys = sent[at]
        self.hash = PerfectHash(keys["h1"], keys["h2"])
        place = self.hash.index(keys["h1"], keys["h2"])
        self.fingerprint, self.count, self.first = np.empty(len(at), "<u8"), np.empty(len(at), "<i8"), np.empty(len(at), "<i8")
        if len(at):
            self.fingerprint[place] = keys["h2"]
            self.count[place] = np.add.reduceat(sent["n"].astype(np.int64), at)
            self.first[place] = np.minimum.reduceat(sent["doc"], at)

    def probe(self, h1, h2) -> tuple[np.ndarray, np.ndarray]:
        """``(documents, smallest doc_id)`` of each line; no documents where the fingerprint differs."""
        if not len(self.fingerprint):
            return np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64)
        at = self.hash.index(h1, h2)
        known = (at >= 0) & (self.fingerprint[at] == h2)
        return np.where(known, self.count[at], 0), self.first[at]


def key_of(line: str, least: int) -> bytes | None:
    key = line.strip(BLANK)
    return key.encode().lower() if len(key) >= least else None


def row_docs(docs: DataFrame, keep_columns: bool) -> tuple[DataFrame, int]:
    """Blocks with the other columns packed into ``row`` (a constant if they are not kept)."""
    ship(docs.sparkSession)
    n = blocks_for(text_bytes(docs))
    rest = [c for c in docs.columns if c.lower() not in ("doc_id", "text")] if keep_columns else []
    row = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest))) if rest else F.lit(0)
    flat = docs.select("doc_id", "text", row.alias("row"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    return flat.select(F.pmod(F.xxhash64(key), F.lit(n)).alias("block"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "row"), n


def dedup_lines(docs: DataFrame, least: int = LEAST, keep_columns: bool = False) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text``; with ``keep_columns`` the columns of ``docs`` instead."""
    blocks, n_blocks = row_docs(docs, keep_columns)
    shards = max(1, n_blocks // 4)

    def hashes(t: pa.Table) -> dict:
        pairs = set()
        for doc, text in zip(t.column("doc_id").to_pylist(), t.column("text").to_pylist(), strict=True):
            if doc is not None:
                pairs.update((xxh3_128_digest(k), doc) for line in text.split("\n") if (k := key_of(line, least)) is not None)
        found: dict = {}
        for h, doc in pairs:
            had = found.setdefault(h, [doc, 0])
            had[0], had[1] = min(had[0], doc), had[1] + 1
        h = np.frombuffer(b"".join(found), "<u8").reshape(-1, 2)
        sent = np.empty(len(found), SENT)
        sent["h1"], sent["h2"] = h[:, 0], h[:, 1]
        sent["doc"], sent["n"] = [x[0] for x in found.values()], [x[1] for x in found.values()]
        parts = split_by((sent["h1"] % np.uint64(shards)).astype(np.int64), shards)
        return {"shard": [s for s, _ in parts], "block": [t.column("block")[0].as_py()] * len(parts), "payload": [sent[i].tobytes() for _, i in parts]}

    def answers(t: pa.Table) -> dict:
        payloads = t.column("payload").to_pylist()
        sent = [np.frombuffer(p, SENT) for p in payloads]
        index = LineIndex(np.concatenate(sent))
        out = []
        for s in sent:
            n, first = index.probe(s["h1"], s["h2"])
            a = np.empty(int((n > 1).sum()), ANSWER)
            a["h1"], a["h2"], a["doc"] = s["h1"][n > 1], s["h2"][n > 1], first[n > 1]
            out.append(a.tobytes())
        has = [i for i, a in enumerate(out) if a]
        return {"block": t.column("block").take(pa.array(has, pa.int64())), "payload": [out[i] for i in has]}

    sent = blocks.groupBy("block").applyInArrow(by_group("shard long, block long, payload binary", hashes), "shard long, block long, payload binary")
    answered = sent.groupBy("shard").applyInArrow(by_group("block long, payload binary", answers), "block long, payload binary")
    out_ddl = f"doc_id long, n_lines long, n_dropped long, text string, row {blocks.schema['row'].dataType.simpleString()}"
    schema = arrow_schema(out_ddl)

    def apply(texts: pa.Table, replies: pa.Table) -> pa.Table:
        first: dict = {}
        for p in replies.column("payload").to_pylist():
            a = np.frombuffer(p, ANSWER)
            first.update(zip((p[i : i + 16] for i in range(0, len(p), ANSWER.itemsize)), a["doc"].tolist(), strict=True))
        cols: dict = {"n_lines": [], "n_dropped": [], "text": []}
        for doc, text in zip(texts.column("doc_id").to_pylist(), texts.column("text").to_pylist(), strict=True):
            lines = text.split("\n")
            kept = lines if doc is None else [x for x in lines if (k := key_of(x, least)) is None or first.get(xxh3_128_digest(k), doc) == doc]
            cols["n_lines"].append(len(lines))
            cols["n_dropped"].append(len(lines) - len(kept))
            cols["text"].append("\n".join(kept))
        return as_table(cols | {"doc_id": texts.column("doc_id"), "row": texts.column("row").combine_chunks().cast(schema.field("row").type)}, schema)

    out = blocks.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(apply, out_ddl)
    if not keep_columns:
        return out.drop("row")
    rest = iter(range(len(docs.columns)))
    cols = [F.col(c.lower()).cast(docs.schema[c].dataType).alias(c) if c.lower() in ("doc_id", "text") else F.col(f"row.c{next(rest)}").alias(c) for c in docs.columns]
    return out.select(*cols)


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS nth
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (
  SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE s.k IS NOT NULL AND first_doc <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nth)
                       FILTER (WHERE s.k IS NULL OR first_doc = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN shared s USING (k) GROUP BY doc_id
"""
