"""Managed tables: namespace, save with counts, read, reset, swap.

Tables are Parquet (no Delta in this environment); pass ``fmt="delta"`` where the jar is
present. Row counts come from an ``Observation`` on the write itself, so a table is
computed once, not once for the write and again for ``count()``.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

log = logging.getLogger(__name__)


def qualified(namespace: str | None, name: str) -> str:
    return f"{namespace}.{name}" if namespace else name


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``, in the warehouse or at ``location``."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}" + (f" LOCATION '{location}'" if location else ""))


def save(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    path: str | None = None,
) -> int:
    """S3: overwrite a managed table (schema replaced), or one at ``path``; returns rows written.

    ``partition_by`` gives later readers partition pruning (e.g. sales by ``order_month``);
    ``bucket_by=(n, keys)`` pre-shuffles by key so joins on it skip the exchange.
    """
    return int(save_observed(df, name, {}, fmt, partition_by, bucket_by, path)["rows"])


def save_observed(
    df: DataFrame,
    name: str,
    metrics: Mapping[str, Column],
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    path: str | None = None,
) -> dict:
    """As :func:`save`, and the value of each aggregate over the rows written, with their number as ``rows``.

    All of them are observed on the write itself, so totals cost no second pass over a fact.
    """
    # one task a bucket, and few tasks a partition value (AQE splits the large ones): else each task writes a file for each
    if bucket_by:
        df = df.repartition(bucket_by[0], *bucket_by[1])
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    obs = Observation(f"save:{name}")
    aggs = [F.count(F.lit(1)).alias("rows"), *(m.alias(n) for n, m in metrics.items())]
    writer = df.observe(obs, *aggs).write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, keys = bucket_by
        writer = writer.bucketBy(n, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return dict(obs.get)


def save_all(tables: Mapping[str, DataFrame], namespace: str | None = None, fmt: str = "parquet") -> dict[str, int]:
    """Write each table and report its row count; see :func:`at_once`."""
    counts = at_once({name: partial(save, df, qualified(namespace, name), fmt) for name, df in tables.items()})
    for name, n in counts.items():
        log.info("wrote %s: %d rows", qualified(namespace, name), n)
    return counts


def at_once(writes: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Runs writes that do not read one another side by side, so that a small table's few tasks do not hold up a large one's."""
    if not writes:
        return {}
    with ThreadPoolExecutor(len(writes)) as pool:
        running = {name: pool.submit(inheritable_thread_target(write)) for name, write in writes.items()}
    return {name: r.result() for name, r in running.items()}


def read(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Table scan by (qualified) name; ``columns`` prunes the read."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def drop(spark: SparkSession, *names: str) -> None:
    """Drop tables if present (a reset before a fresh load)."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def list_tables(spark: SparkSession, namespace: str) -> list[str]:
    """Table names of a namespace; the session's temporary views, which Spark lists in every one, are left out."""
    return sorted(t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary)


def sample(df: DataFrame, n: int = 5) -> DataFrame:
    """A small sample for inspection (``printSchema`` + this)."""
    return df.limit(n)


def location(spark: SparkSession, name: str) -> str:
    """The folder that holds a table's rows."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]


def replace_table(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> int:
    """Write ``df`` as the next version of ``name``, even when ``df`` reads ``name``; returns rows written.

    The version goes to a folder of its own beside the current one. A single ``ALTER TABLE ... SET LOCATION``
    then switches: the table exists throughout, whoever reads it finds the old version or the new one, and
    plans made before the switch go on with the old folder. Old folders stay until their owner
    removes them. A table whose columns differ is refused (drop it first); layout arguments must be
    those the table was saved with. A table that is not there yet is saved.
    """
    if not spark.catalog.tableExists(name):
        return save(df, name, fmt, partition_by, bucket_by)
    columns = lambda d: sorted((f.name, f.dataType.simpleString()) for f in d.schema)
    if columns(df) != columns(spark.table(name)):
        raise ValueError(f"{name} has other columns than its next version")
    old = location(spark, name).rstrip("/")
    version = f"{old.split('__v')[0]}__v{uuid.uuid4().hex[:12]}"
    side = f"{name}__next"
    drop(spark, side)
    rows = save(df, side, fmt, partition_by, bucket_by, path=version)
    switch(spark, name, version)
    drop(spark, side)  # the entry only: files of a table at a path stay
    return rows


def switch(spark: SparkSession, name: str, folder: str) -> None:
    """Let ``name`` read ``folder`` from now on."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
