"""Exact top-k search by a three-phase uniform threshold.

Every vector is cut into NODES parts of its dimensions; each part has a local score (the inner product
over the part), and a score is the sum of the local ones. Queries and rows lie in blocks; every
query block meets every row block once, tile by tile:

1. where no cutoff is known yet, each node lists its k best entries of every query; the k-th best of the
   sums of listed entries is a safe cutoff, as no true k-th score can be lower;
2. the first node collects the entries whose local score, with the greatest the other can add
   (Cauchy-Schwarz, one more column of the product), comes up to the cutoff;
3. the second node scores only what was collected; the k-th best of the exact sums raises the cutoff.

One in ROUND row blocks comes first. The cutoffs found there travel with the query blocks, as 64-bit
integers, to all the other blocks, which begin with phase 2. Of the exact sums at most k per query leave a block.

A query block is copied once a row block, so copies grow as queries times row blocks: blocks hold as many
vectors as BLOCK_BYTES allow, as the narrowest numbers that hold them. No list grows beyond k entries
per query and block, so a vector that a third of all rows share adds nothing; rows that repeat a vec_id
are reduced before they are dealt out.

Defined cases: vectors that are null, or hold a null or non-finite component, or have a null vec_id
take no part; of rows that repeat a vec_id the one with the smallest vector counts; shorter vectors
are filled up with zeros; fewer than k candidates give fewer rows; an empty table gives an
empty result; other columns are ignored. Scores are exact, and saturate at 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import arrow_schema, as_table, by_cogroup, by_group, ship, split_by, table

NODES = 2
FIRST = 0.875  # of the dimensions are the first node's: what it collects is then small enough to be scored one by one
ROUND = 16
BLOCK_BYTES, LEAST_ROWS, SPREAD = 16 << 20, 4096, 64
QUERY_TILE, ROW_TILE, PAIRS, SLICE = 512, 1024, 1 << 16, 1 << 16
FOUND = "query_id long, vec_id long, score long"
MIN, MAX = -(1 << 63), (1 << 63) - 1


def usable(ids: pa.Array, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, sizes, components)`` of the vectors that take part; of those that share an id the smallest."""
    has = ids.is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    has[row[~np.isfinite(flat)]] = False  # nulls come as NaN
    return smallest(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)[has], sizes[has], flat[has[row]])


def smallest(ids: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, which, times = np.unique(ids, return_inverse=True, return_counts=True)
    if len(found) == len(ids):
        return ids, sizes, flat
    ends = np.cumsum(sizes)
    least: dict = {}
    for i in np.flatnonzero(times[which] > 1).tolist():
        v = flat[ends[i] - sizes[i] : ends[i]].tolist()
        if (at := int(ids[i])) not in least or v < least[at][0]:
            least[at] = (v, i)
    keep = times[which] == 1
    keep[[i for _, i in least.values()]] = True
    return ids[keep], sizes[keep], flat[np.repeat(keep, sizes)]


def narrow(m: np.ndarray) -> bytes:
    """Whole numbers as the narrowest type that holds them."""
    most = np.abs(m).max() if m.size else 0
    return m.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.float64).tobytes()


def wide(body, n: int, width: int) -> np.ndarray:
    size = len(body) // max(1, n * width)
    return np.frombuffer(body, {2: np.int16, 4: np.int32}.get(size, np.float64)).reshape(n, width)


def vector_blocks(embeddings: DataFrame, queries: DataFrame) -> tuple[DataFrame, int, int]:
    """Blocks of about as many vectors as BLOCK_BYTES hold, by a hash of vec_id: ``r, r_ids, r_matrix`` of
    floor(256 * x) of each component, and ``q_ids, q_matrix`` of those asked for; their number, and the width."""
    single = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = np.float32 if single else np.float64
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("v"))
    count, width = rows.select(F.count("vec_id"), F.max(F.size("v"))).first()
    width = max(1, width or 0)
    n = max(1, -(-count // max(1, min(BLOCK_BYTES // (4 * width), max(LEAST_ROWS, count // SPREAD)))))
    dealt = F.pmod(F.xxhash64("vec_id"), F.lit(n)).alias("r")
    ddl = "r long, ids binary, sizes binary, body binary"
    schema = arrow_schema(ddl)

    def pieces(batches):
        def send(held):
            t = pa.Table.from_batches(held).combine_chunks()
            r = t.column("r").to_numpy()
            for block, at in split_by(r, n):
                part = t.take(pa.array(at))
                ids, sizes, flat = usable(part.column("vec_id").combine_chunks(), part.column("v").combine_chunks())
                yield pa.RecordBatch.from_pydict({"r": pa.array([block], pa.int64()), "ids": pa.array([ids.tobytes()]), "sizes": pa.array([sizes.tobytes()]), "body": pa.array([flat.astype(kind).tobytes()])}, schema=schema)

        held: list = []
        for batch in batches:
            held += [batch] * (batch.num_rows > 0)
            if sum(b.num_rows for b in held) * width >= SLICE * 64:
                yield from send(held)
                held = []
        if held:
            yield from send(held)

    def pack(t: pa.Table, asked: pa.Table) -> dict:
        parts = [[np.frombuffer(b, k) for b in t.column(c).to_pylist()] for c, k in (("ids", np.int64), ("sizes", np.int64), ("body", kind))]
        if not parts[0]:
            return {c: [] for c in ("r", "r_ids", "r_matrix", "q_ids", "q_matrix")}
        ids, sizes, flat = smallest(*map(np.concatenate, parts))
        m = np.zeros((len(ids), width))
        m[np.arange(width) < sizes[:, None]] = np.floor(256 * flat.astype(np.float64))
        order = np.argsort(ids)
        ids, m = ids[order], m[order]
        q = np.isin(ids, asked.column("vec_id").to_numpy())
        return {"r": t.column("r")[:1].to_pylist(), "r_ids": [ids.tobytes()], "r_matrix": [narrow(m)], "q_ids": [ids[q].tobytes()], "q_matrix": [narrow(m[q])]}

    packed = "r long, r_ids binary, r_matrix binary, q_ids binary, q_matrix binary"
    sent = rows.where("vec_id IS NOT NULL").select("vec_id", "v", dealt).mapInArrow(pieces, ddl)
    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id")).where("vec_id IS NOT NULL").distinct().select("vec_id", dealt)
    return materialize(sent.groupBy("r").cogroup(asked.groupBy("r")).applyInArrow(by_cogroup(packed, pack), packed), "row-blocks"), n, width


def is_small(q: np.ndarray, x: np.ndarray) -> bool:
    """Whether every partial sum of an inner product is an exact integer in floating point."""
    return not (q.size and x.size) or np.abs(q).max() * np.abs(x).max() * q.shape[1] < 2.0**52


def local_scores(q: np.ndarray, x: np.ndarray, small: bool) -> np.ndarray:
    """Inner products, exact: as floating point if they are ``small``, else as Python integers."""
    if small:
        return q @ x.T
    whole = np.vectorize(int, otypes=[object])
    return whole(q) @ whole(x).T if q.size and x.size else np.zeros((len(q), len(x)), object)


def resolved(q: np.ndarray, x: np.ndarray, half: int, cut: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, total, reach)``: rows of ``x`` that may reach a query's cutoff, exact scores, and who does reach it.

    The second half is multiplied only for rows whose first score plus the greatest possible second one
    (Cauchy-Schwarz, with room for rounding) comes up to some cutoff.
    """
    small = is_small(q, x)
    first = local_scores(q[:, :half], x[:, :half], small)
    most = np.linalg.norm(q[:, half:], axis=1)[:, None] * np.linalg.norm(x[:, half:], axis=1)[None, :]
    near = first.astype(float)
    chance = near + most + 1 + 1e-9 * (np.abs(near) + most + np.abs(cut.astype(float))[:, None])
    rows = np.flatnonzero((other & (chance >= cut.astype(float)[:, None])).any(axis=0))
    total = first[:, rows] + local_scores(q[:, half:], x[rows, half:], small)
    if not small:
        total = np.clip(total, MIN, MAX)
        cut = cut.astype(object)
    return rows, total, (total >= cut[:, None]).astype(bool) & other[:, rows]


def listed_cutoff(local: list, allowed: np.ndarray, k: int) -> np.ndarray:
    """Phase 1: of every query the k-th best sum of the entries that some node lists among its k best."""
    lists = []
    for s in local:
        near = np.where(allowed, s.astype(float), -np.inf)
        lists.append(np.argpartition(near, -k, axis=1)[:, -k:] if near.shape[1] > k else np.broadcast_to(np.arange(near.shape[1]), near.shape))
    at = np.concatenate(lists, axis=1)
    again = (lists[1][:, :, None] == lists[0][:, None, :]).any(axis=2)
    sums = sum(np.take_along_axis(s, at, 1) for s in local)
    if sums.dtype == object:
        sums = np.clip(sums, MIN, MAX)
    sums = sums.astype(np.int64)
    sums[~np.take_along_axis(allowed, at, 1) | np.append(np.zeros(lists[0].shape, bool), again, axis=1)] = MIN
    return np.sort(sums, axis=1)[:, -k] if sums.shape[1] >= k else np.full(len(sums), MIN)


def places(m: np.ndarray) -> np.ndarray:
    """Where a matrix of few True is so, eight at a time."""
    flat = m.ravel()
    if flat.size % 8:
        return np.flatnonzero(flat)
    at = (np.flatnonzero(flat.view(np.uint64) != 0)[:, None] * 8 + np.arange(8)).ravel()
    return at[flat[at]]


class Search:
    """One query block against one row block; ``kind`` is the narrowest float in which every partial sum is exact, if any."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
        self.q_ids, self.ids, self.k = q_ids, ids, k
        self.half = max(1, min(q.shape[1] - 1, round(q.shape[1] * FIRST)))
        norm = lambda m: np.sqrt(np.einsum("ij,ij->i", m, m))
        wide_q, wide_x = q.astype(np.float64), x.astype(np.float64)
        most = norm(wide_q).max(initial=0) * norm(wide_x).max(initial=0)  # bounds every partial sum
        self.kind = np.float32 if most < 2.0**23 else np.float64 if most < 2.0**51 else None
        if self.kind is None:
            self.q, self.x = wide_q, wide_x
            return
        self.q, self.x = q.astype(self.kind), x.astype(self.kind)
        self.most, self.hit = np.empty(QUERY_TILE * ROW_TILE, self.kind), np.empty(QUERY_TILE * ROW_TILE, bool)
        unit = np.finfo(self.kind).eps
        self.slack = 1 + 4 * (q.shape[1] + 2) * unit * most
        self.above_q, self.above_x = (np.column_stack([m[:, : self.half], norm(m[:, self.half :]) * (1 + 4 * unit)]).astype(self.kind) for m in (wide_q, wide_x))

    def reached(self, a: slice, b: slice, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phases 2 and 3: ``(query, row, score)`` of a tile's entries that come up to the cutoffs."""
        if self.kind is None:
            rows, total, reach = resolved(self.q[a], self.x[b], self.half, cut, self.q_ids[a][:, None] != self.ids[b][None, :])
            i, j = np.nonzero(reach)
            return i, rows[j] + b.start, total[i, j].astype(np.int64)
        x = self.above_x[b]
        shape, size = (len(cut), len(x)), len(cut) * len(x)
        most = np.matmul(self.above_q[a], x.T, out=self.most[:size].reshape(shape))
        m = np.greater_equal(most, (cut - self.slack).astype(self.kind)[:, None], out=self.hit[:size].reshape(shape))
        at, n = places(m), len(x)
        if len(at) * 16 > m.size:
            total = self.q[a] @ self.x[b].T
            at = np.flatnonzero(total >= cut.astype(self.kind)[:, None])
            score = total.ravel()[at]
        else:
            score = np.empty(len(at), self.kind)
            for c in range(0, len(at), PAIRS):
                i, j = np.divmod(at[c : c + PAIRS], n)
                score[c : c + PAIRS] = np.einsum("ij,ij->i", self.q[a][i], self.x[b][j])
        i, j = np.divmod(at, n)
        score = score.astype(np.int64)
        keep = (score >= cut[i]) & (self.q_ids[a][i] != self.ids[b][j])
        return i[keep], j[keep] + b.start, score[keep]

    def best(self, a: slice, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """At most k entries of each query that come up to its cutoff; of equal scores those of smaller ids (ids ascend)."""
        held, n, k = [], 0, self.k
        for at in range(0, len(self.ids), ROW_TILE):
            b = slice(at, at + ROW_TILE)
            if not at and (cut == MIN).any():
                q, x, small = self.q[a], self.x[b], self.kind is not None
                local = [local_scores(q[:, : self.half], x[:, : self.half], small), local_scores(q[:, self.half :], x[:, self.half :], small)]
                cut = np.maximum(cut, listed_cutoff(local, self.q_ids[a][:, None] != self.ids[b][None, :], k))
            held.append(self.reached(a, b, cut))
            n += len(held[-1][0])
            if n > 4 * k * len(cut) or b.stop >= len(self.ids):
                query, row, score = (np.concatenate(c) for c in zip(*held, strict=True))
                order = np.lexsort((row, ~score, query))
                query, row, score = query[order], row[order], score[order]
                rank = np.arange(len(query)) - np.searchsorted(query, query)
                full = rank == k - 1
                cut = cut.copy()
                cut[query[full]] = np.minimum(score[full], MAX - 1) + 1  # later rows of an equal score have larger ids
                held, n = [(query[rank < k], row[rank < k], score[rank < k])], 0
        return held[0]


def search_pairs(pairs: DataFrame, width: int, k: int) -> DataFrame:
    schema = arrow_schema(FOUND)
    cols = ("q_ids", "q_matrix", "q_cut", "r_ids", "r_matrix")

    def run(batches):
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(len(cols))), strict=True):
                q_body, body = (c.as_buffer() for c in (row[1], row[4]))
                q_ids, cut, ids = (np.frombuffer(row[i].as_buffer(), np.int64) for i in (0, 2, 3))
                if not (len(q_ids) and len(ids)):
                    continue
                search = Search(q_ids, wide(q_body, len(q_ids), width), ids, wide(body, len(ids), width), k)
                for at in range(0, len(q_ids), QUERY_TILE):
                    a = slice(at, at + QUERY_TILE)
                    i, j, score = search.best(a, cut[a])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (q_ids[a][i], ids[j], score)], schema=schema)

    return pairs.select(*cols).mapInArrow(run, FOUND)


def query_blocks(blocks: DataFrame, nq: int) -> DataFrame:
    """Vectors asked for, of several row blocks together: ``q, q_ids, q_matrix``."""
    ddl = "q long, q_ids binary, q_matrix binary, q_width long"

    def join(t: pa.Table) -> dict:
        ids = [np.frombuffer(b, np.int64) for b in t.column("q_ids").to_pylist()]
        width = t.column("q_width")[0].as_py()
        m = np.concatenate([wide(b, len(i), width).astype(np.float64) for b, i in zip(t.column("q_matrix").to_pylist(), ids, strict=True)])
        return {"q": t.column("q")[:1].to_pylist(), "q_ids": [np.concatenate(ids).tobytes()], "q_matrix": [narrow(m)], "q_width": [width]}

    return blocks.withColumn("q", F.pmod("r", F.lit(nq))).select("q", "q_ids", "q_matrix", "q_width").groupBy("q").applyInArrow(by_group(ddl, join), ddl)


def with_cutoffs(blocks: DataFrame, cutoffs: DataFrame) -> DataFrame:
    ddl = "q long, q_ids binary, q_matrix binary, q_cut binary"

    def give(t: pa.Table, known: pa.Table) -> dict:
        cuts = []
        order = np.argsort(known.column("query_id").to_numpy())
        have, score = known.column("query_id").to_numpy()[order], known.column("cutoff").to_numpy()[order]
        for body in t.column("q_ids").to_pylist():
            ids = np.frombuffer(body, np.int64)
            cut = np.full(len(ids), MIN, np.int64)
            if len(have):
                at = np.minimum(np.searchsorted(have, ids), len(have) - 1)
                cut = np.where(have[at] == ids, score[at], cut)
            cuts.append(cut.astype(np.int64).tobytes())
        return {c: t.column(c) for c in ("q", "q_ids", "q_matrix")} | {"q_cut": cuts}

    return blocks.select("q", "q_ids", "q_matrix").groupBy("q").cogroup(cutoffs.groupBy("q")).applyInArrow(by_cogroup(ddl, give), ddl)


def top_k(embeddings: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best other rows for each query's vec_id."""
    ship(embeddings.sparkSession)
    blocks, n, width = vector_blocks(embeddings, queries)
    asked = blocks.select(F.sum(F.octet_length("q_ids"))).first()[0] or 0
    nq = min(n, max(1, -(-(asked // 8) // max(1, BLOCK_BYTES // (8 * width)))))
    row_blocks = blocks.select("r", "r_ids", "r_matrix")
    asking = materialize(query_blocks(blocks.withColumn("q_width", F.lit(width).cast("long")), nq), "query-blocks")
    nth = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    every = F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    def against(cutoffs: DataFrame, which) -> DataFrame:
        each = with_cutoffs(asking, cutoffs).withColumn("r", F.explode(F.filter(every, which)))
        return search_pairs(each.join(row_blocks, "r"), width, k)

    none = embeddings.sparkSession.createDataFrame([], "query_id long, cutoff long, q long")
    first = materialize(against(none, lambda r: r % ROUND == 0), "first-round")
    listed = first.withColumn("rank", F.row_number().over(nth)).where(F.col("rank") == k)
    cutoffs = listed.select("query_id", F.col("score").alias("cutoff"), F.pmod(F.pmod(F.xxhash64("query_id"), F.lit(n)), F.lit(nq)).alias("q"))
    exact = first.unionByName(against(cutoffs, lambda r: r % ROUND != 0))
    out = exact.withColumn("rank", F.row_number().over(nth).cast("int")).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def op4_topk(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0").select("vec_id"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""
