"""Helpers shared by the operators: Arrow row maps, document blocks, packed payload columns.

A *block* is a group of whole documents of about ``BLOCK_BYTES`` of text, chosen by a hash
of ``doc_id``. Operators that must look something up for every line, word or passage ship one
packed row per (block, shard) instead of one row per item: a key that occurs in a third of
all documents costs a shard one entry per block, never one per document.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

BLOCK_BYTES = 4 << 20
SLICE_ROWS = 512


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once a session (Spark's own file transfer)."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="llm-ship-")) / f"{root.name}_llm.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._llm_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl) if ":" not in ddl else _parse_datatype_string(ddl))


def texts_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` only: other columns, whatever their names, take no part; null text is empty."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


KEPT: dict = {}


def kept(make: Callable, *args):
    """``make(*args)``, kept by a worker process from task to task; only the last one made is."""
    if (make, args) not in KEPT:
        KEPT.clear()
        KEPT[make, args] = make(*args)
    return KEPT[make, args]


def let_go() -> None:
    """What tasks of another stage kept, an operator that keeps nothing itself drops."""
    KEPT.clear()


def map_texts(docs: DataFrame, ddl: str, make: Callable[[list, list], dict]) -> DataFrame:
    """One call of ``make(doc_ids, texts)`` per slice of rows; it returns the columns of ``ddl``."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                cols = make(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_pydict({f.name: pa.array(cols[f.name], f.type) for f in schema}, schema=schema)

    return texts_of(docs).mapInArrow(run, ddl)


def keep_rows(docs: DataFrame, mask: Callable[[list], list]) -> DataFrame:
    """Rows of ``docs`` (all columns, same schema) whose text passes; no shuffle."""
    ship(docs.sparkSession)
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(mask(texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def text_bytes(docs: DataFrame) -> int:
    return docs.select(F.sum(F.octet_length("text"))).first()[0] or 0


def block_docs(docs: DataFrame, n_blocks: int) -> DataFrame:
    """``(block, doc_id, text)``; rows of one doc_id share a block, rows without an id go by their text."""
    key = F.coalesce(F.col("doc_id"), F.xxhash64("text"))
    return texts_of(docs).select(F.pmod(F.xxhash64(key), F.lit(n_blocks)).alias("block"), "doc_id", "text")


def blocks_for(total_bytes: int) -> int:
    return max(1, -(-total_bytes // BLOCK_BYTES))


def by_group(ddl: str, make: Callable) -> Callable:
    """Wraps ``make(*tables) -> dict of columns`` for applyInArrow."""
    schema = arrow_schema(ddl)

    def one(t: pa.Table) -> pa.Table:
        let_go()
        return as_table(make(t), schema)

    return one


def by_cogroup(ddl: str, make: Callable) -> Callable:
    schema = arrow_schema(ddl)

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        let_go()
        return as_table(make(left, right), schema)

    return two


def as_table(cols: dict, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pydict({f.name: pa.array(cols[f.name], f.type) for f in schema}, schema=schema)


def unpack(payloads: list, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All payloads end to end, and the position where each begins (one more at the end)."""
    parts = [np.frombuffer(p, dtype) for p in payloads]
    ends = np.cumsum([0, *(len(p) for p in parts)])
    return (np.concatenate(parts) if parts else np.empty(0, dtype)), ends


def split_by(shard: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """``(shard, indices)`` of the shards that occur; indices ascend."""
    order = np.argsort(shard, kind="stable")
    found, at = np.unique(shard[order], return_index=True)
    return list(zip(found.tolist(), np.split(order, at[1:]), strict=True))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (multiply and xor-shift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class WordHashes(dict):
    """64-bit hash of a word, remembered; the memory is emptied when it holds ``most`` words."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxh3_64_intdigest(word)
        return h

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str) -> list[bytes]:
    """ASCII letters lower-cased, cut at ``[\\x20\\x09-\\x0D]`` (what bytes.split() cuts at)."""
    return text.encode().lower().split()


def is_held_out(remainder: int):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")), F.lit(5)) == remainder, F.lit(False))
