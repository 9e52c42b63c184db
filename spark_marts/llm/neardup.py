"""Near-duplicate documents by b-bit MinHash.

A document's set holds its distinct ``shingle``-word sequences (hashed to 64 bits). Equal sets are one
class from the start. Every class gets HASHES minima; bands of ROWS minima give candidate
buckets, and of each minimum the low two bits are kept, packed into longs, from which the similarity is
estimated, corrected for chance agreement of two bits, by counting bits. A parity sketch (512 bits, each the parity of the
shingles that fall on it) then bounds the sets' difference from below, so it drops only pairs that
cannot be links. Links are confirmed on full sets: size of the intersection against that of the union.

No bucket is paired out. In a turn every member of a bucket is compared with one pivot, and links merge
components: first with the member that meets most others over all its buckets (the original among its
variants, which need not be similar to each other), then, while the pairs that remain are many (over
ENOUGH for each member), with another. Buckets of one component, and pairs once compared, are
done. Then, in buckets that still have several components, members outside the largest one are
compared with all members in other components, so no link that could join two is left out.
With 32 bands of 5, a pair at similarity 0.8 meets in some bucket with probability 1 - 3e-6, and the
estimate keeps it with probability over 1 - 1e-5.

Defined cases: null or empty text, or text of white space, is the empty set and linked with nothing;
a text of fewer words than a shingle is one shingle; rows that share a doc_id are one document, linked
by any of its texts; rows with a null doc_id are never linked and are kept (component_id null);
other columns are ignored, or kept by ``drop_near_duplicates``; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from ..session import materialize
from .common import WordHashes, kept, map_texts, mix, table, texts_of, words_of

HASHES, ROWS, LONGS = 160, 5, 5  # 32 minima of 2 bits to a long
ODD = 8  # longs of the parity sketch
BANDS = HASHES // ROWS
MOST_DIFFER = 44  # pairs at 0.8 differ in 24 of 160 minima on average, with a deviation of 4.5
ENOUGH, TURNS = 16, 3
MUL = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def seeds() -> tuple[np.ndarray, np.ndarray]:
    n = np.arange(1, HASHES + 1, dtype=np.uint64)[:, None]
    return mix(n * MUL) | np.uint64(1), mix(n + np.uint64(1 << 40))


def shingles(text: str, size: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    h = kept(WordHashes).of(words_of(text))
    if not len(h):
        return h
    size = min(size, len(h))
    acc = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        acc = mix(acc * MUL + h[i : len(h) - size + 1 + i])
    return np.unique(acc)


def sketch(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and packed two-bit minima of a set."""
    a, b = seeds()
    least = np.full(HASHES, ~np.uint64(0))
    for at in range(0, len(own), 256):
        least = np.minimum(least, ((own[at : at + 256][None, :] ^ b) * a).min(1))
    bands = np.zeros(BANDS, np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        bands = mix(bands * MUL + row)
    bits = (mix(least) & np.uint64(3)).reshape(LONGS, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return bands.astype(np.int64), np.bitwise_or.reduce(bits, 1).astype(np.int64)


def parities(own: np.ndarray) -> np.ndarray:
    """The parity sketch of a set; that of a symmetric difference is the two sketches' XOR."""
    bits = (np.bincount((own >> np.uint64(55)).astype(np.int64), minlength=64 * ODD) & 1).astype(np.uint64)
    return np.bitwise_or.reduce(bits.reshape(ODD, 64) << np.arange(64, dtype=np.uint64), 1).astype(np.int64)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    def make(ids, texts):
        cols: dict = {"doc_id": ids, "n": [], "s1": [], "s2": [], "bands": [], "low": [], "odd": []}
        for t in texts:
            own = shingles(t, size)
            bands, low = sketch(own) if len(own) else ((), ())
            s1, s2 = np.frombuffer(xxh3_128_digest(own.tobytes()), np.int64)
            odd = parities(own) if len(own) else ()
            for name, value in zip(("n", "s1", "s2", "bands", "low", "odd"), (len(own), s1, s2, bands, low, odd), strict=True):
                cols[name].append(value)
        return cols

    return map_texts(docs, "doc_id long, n long, s1 long, s2 long, bands array<long>, low array<long>, odd array<long>", make)


def differing(a: str, b: str):
    """In how many of the minima two packed signatures differ."""
    total = F.lit(0)
    for i in range(LONGS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total


def least_difference(a: str, b: str):
    """At least so many shingles are in one set only."""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(ODD)), F.lit(0))


def likely(held: DataFrame, split: DataFrame, every: bool, percent: int) -> DataFrame:
    """Distinct pairs (u < v) of a bucket in different components, of sizes and estimates that allow a link.

    ``every``: members outside the largest component against all others; else all against the pivot.
    """
    side = lambda c: [F.col("component").alias(f"c{c}"), *(F.col(k).alias(f"{k}_{c}") for k in ("rep", "n", "low", "odd"))]
    chosen = F.col("top.component") != F.col("component") if every else F.col("pivot.rep") == F.col("rep")
    x = held.join(split.select("band", "key", "top", "pivot"), ["band", "key"]).where(chosen).select("band", "key", *side("x"))
    y = held.select("band", "key", *side("y"))
    near = (F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * percent) & (differing("low_x", "low_y") <= MOST_DIFFER)
    near = near & (least_difference("odd_x", "odd_y") * (100 + percent) <= (F.col("n_x") + F.col("n_y")) * (100 - percent))
    rows = x.join(y, (x["band"] == y["band"]) & (x["key"] == y["key"]) & (F.col("cx") != F.col("cy")) & near)
    return rows.select(F.least("rep_x", "rep_y").alias("u"), F.greatest("rep_x", "rep_y").alias("v")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    at = lambda c: sets.select(F.col("rep").alias(c), F.col("own").alias(f"own_{c}"))
    rows = pairs.join(at("v"), "v").join(at("u"), "u").select("u", "v", "own_u", "own_v")

    def check(batches):
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], schema=schema).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(check, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(rep, component)`` of every vertex but the components' smallest; large-star and small-star rounds."""
    state = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = stamp(state)
    while True:
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        state = materialize(small, "edges")
        now = stamp(state)
        if now == before:
            return state.select(F.col("u").alias("rep"), F.col("v").alias("component"))
        before = now


def stamp(edges: DataFrame):
    """Count and sum of hashes: equal for equal sets of edges."""
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """``(rep, component)`` once new links join components of ``found`` (which leaves out each one's smallest vertex)."""
    name = lambda c: found.select(F.col("rep").alias(c), F.col("component").alias(f"c{c}"))
    ends = links.join(name("u"), "u", "left").join(name("v"), "v", "left")
    joined = components(ends.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")).where("u <> v"))
    joined = joined.select(F.col("rep").alias("old"), F.col("component").alias("new"))
    moved = found.join(joined, F.col("component") == F.col("old"), "left").select("rep", F.coalesce("new", "component").alias("component"))
    return materialize(moved.union(joined), "components")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs``."""
    rows = materialize(sketches(docs, shingle), "sketches")
    classes = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("low").alias("low"), F.first("odd").alias("odd"))
    classes = materialize(classes, "classes")
    entries = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    buckets = entries.groupBy("band", "key").agg(F.min("rep").alias("first"), F.max("rep").alias("last"), F.count("*").alias("held")).where("first < last").select("band", "key", "held")
    members = materialize(entries.join(buckets, ["band", "key"]), "members")
    wanted = members.select("rep").distinct()

    def make(ids, texts):
        return {"rep": ids, "own": [shingles(t, shingle).tobytes() for t in texts]}

    flat = texts_of(docs)
    sets = materialize(map_texts(flat.join(wanted, flat.doc_id == wanted.rep, "left_semi"), "rep long, own binary", make), "sets")
    degree = members.groupBy("rep").agg(F.sum("held").alias("degree"))
    signs = classes.select("rep", "n", "low", "odd").join(degree, "rep")
    entries = materialize(members.select("band", "key", "rep").join(signs, "rep"), "entries")
    found = classes.select("rep", F.col("rep").alias("component")).where("false")
    tested = None
    for turn in range(TURNS):
        held = materialize(entries.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "held")
        parts = held.groupBy("band", "key", "component").agg(F.count("*").alias("size"), F.max(F.struct((F.lit(0).cast("long") if turn else F.col("degree")).alias("degree"), F.xxhash64("rep", F.lit(turn)).alias("by"), "rep")).alias("pivot"))
        split = parts.groupBy("band", "key").agg(F.count("*").alias("parts"), F.sum("size").alias("total"), F.max(F.struct("size", "component")).alias("top"), F.max("pivot").alias("pivot"))
        split = materialize(split.where("parts > 1"), "split")
        every, total = split.agg(F.sum((F.col("total") - F.col("top.size")) * F.col("total")), F.sum("total")).first()
        if not every:
            break
        last = every <= ENOUGH * total or turn == TURNS - 1
        pairs = likely(held, split, every=last, percent=percent)
        pairs = materialize(pairs if tested is None else pairs.join(tested, ["u", "v"], "left_anti"), "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        more = materialize(confirmed(pairs, sets, percent), "links")
        if not more.isEmpty():
            found = merged(found, more)
        if last:
            break
        entries = held.drop("component").join(split.where("total > 2").select("band", "key"), ["band", "key"], "left_semi")

    of_class = classes.select("s1", "s2", "rep").join(found, "rep", "left").select("s1", "s2", F.coalesce("component", "rep").alias("component"))
    joined = rows.select("doc_id", "n", "s1", "s2").join(of_class, ["s1", "s2"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    out = joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` without those that a document of a smaller doc_id stands for; every column stays."""
    name = f"gone_{uuid.uuid4().hex}"  # no column of docs
    gone = near_duplicates(docs, shingle, percent).where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == F.col(name), "left_anti")


def op5_near_dup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
