"""Set-based upserts without MERGE (S12, S13) and key lookups.

Parquet tables have no ``MERGE``; an upsert is computed as a new version of the table
(old rows not replaced + replacing rows + new rows) and written to a fresh location,
then swapped in (see :mod:`spark_marts.sources.tables`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clean import latest_by_key
from .rank import number_rows


def upsert_dimension(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    surrogate: str,
    order: Sequence[str] = (),
) -> DataFrame:
    """Natural-key upsert with surrogate ids.

    Existing keys keep their id and take the update's other attributes; keys not yet in
    the target get ids after the current maximum, numbered in key order. The numbering
    is distributed (:func:`number_rows`), not a global window. Of updates that repeat a key
    the last one by ``order`` counts (ties: the greatest other columns).
    """
    keys = list(keys)
    updates = latest_by_key(updates, keys, order).drop(*order)
    attrs = [c for c in updates.columns if c not in keys]
    t = target.alias("t")
    u = updates.alias("u")
    cond = [F.col(f"t.{k}") == F.col(f"u.{k}") for k in keys]
    kept = t.join(u, cond, "left").select(
        F.col(f"t.{surrogate}").alias(surrogate),
        *[F.col(f"t.{k}").alias(k) for k in keys],
        *[
            (F.when(F.col(f"u.{keys[0]}").isNotNull(), F.col(f"u.{a}")).otherwise(F.col(f"t.{a}")).alias(a))
            for a in attrs
        ],
    )
    new = updates.join(target.select(*keys), keys, "left_anti")
    # One number: the current maximum id.
    max_id = target.agg(F.max(surrogate)).first()[0] or 0
    numbered = number_rows(new, keys, start=int(max_id), out=surrogate)
    cols = [surrogate, *keys, *attrs]
    return kept.select(*cols).unionByName(numbered.select(*cols))


def upsert_fact(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows of ``updates`` replace target rows with the same key; others are kept.

    Of updates that repeat a key the last one by ``order`` counts (ties: the greatest other columns).
    """
    keys = list(keys)
    updates = latest_by_key(updates, keys, order)
    untouched = target.join(updates.select(*keys), keys, "left_anti")
    return untouched.unionByName(updates.select(*target.columns))


def lookup(table: DataFrame, key: str, value) -> DataFrame:
    """Rows with ``key == value``; for the fact that is every day of the place."""
    return table.filter(F.col(key) == F.lit(value))
