"""Silver cleaning: tolerant casts, normalisation, latest version per key, filters.

Covers P1-P3, F1-F6 and W1. Only the dedupe and the row filters drop rows; the
rejection accounting for them lives in :mod:`spark_marts.operators.quality`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import EXCLUDED_STATUSES, initcap_trim, try_cast

# Lineage columns stamped onto every raw table; only the order-level pair survives the join.
LINEAGE_COLUMNS = ("source_file", "ingestion_timestamp")

CUSTOMER_TEXT = ("customer_name", "city", "state", "region", "customer_segment")
CUSTOMER_TYPES = {
    "signup_date": "date",
    "date_of_birth": "date",
    "updated_at": "timestamp_ntz",
    "loyalty_points": "int",
}
PRODUCT_TEXT = ("product_name", "category", "subcategory", "supplier_name")
PRODUCT_TYPES = {"unit_price": "decimal(12,2)", "cost_price": "decimal(12,2)", "stock_quantity": "int"}
ORDER_TYPES = {
    "order_timestamp": "timestamp_ntz",
    "promised_delivery_date": "date",
    "actual_delivery_date": "date",
    "quantity": "int",
    "discount_pct": "decimal(5,2)",
}


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    version_count: str | None = None,
) -> DataFrame:
    """Keep, per key, the row with the greatest ``order`` columns.

    Equivalent to ``row_number() OVER (PARTITION BY keys ORDER BY order DESC NULLS LAST,
    <every other column> DESC NULLS LAST) = 1``: the remaining columns break ties, so the
    result is deterministic. It is written as ``max(struct(...))`` in a ``groupBy``, which
    aggregates partially before the shuffle: a key holding a third of all rows reaches its
    reducer as one row per map task instead of a third of the table in one window sort.

    ``version_count`` optionally names a column holding how many versions each key had.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    aggs = [F.max(F.struct(*order, *rest)).alias("_latest")]
    if version_count:
        aggs.append(F.count(F.lit(1)).alias(version_count))
    picked = df.groupBy(*keys).agg(*aggs)
    out = [F.col(c) if c in keys else F.col(f"_latest.{c}").alias(c) for c in df.columns]
    if version_count:
        out.append(F.col(version_count))
    return picked.select(*out)


def cleaning(text: Sequence[str], types: Mapping[str, str]) -> dict[str, Column]:
    """A table's cleaning as one map of column to expression: names in title case, the rest cast tolerantly."""
    return {**{c: initcap_trim(c) for c in text}, **{c: try_cast(c, t) for c, t in types.items()}}


def prepare_customers(raw: DataFrame) -> DataFrame:
    """Row-local half of customer cleaning: fill, normalise, cast."""
    city = initcap_trim(F.coalesce("city", F.lit("Unknown")))
    return raw.withColumns({**cleaning(CUSTOMER_TEXT, CUSTOMER_TYPES), "city": city})


def is_active(flag: str = "is_active") -> Column:
    return F.col(flag) == "Y"


def clean_customers(raw: DataFrame) -> DataFrame:
    """Latest version per customer, then active only (G1: the newest version decides)."""
    latest = latest_by_key(prepare_customers(raw), ["customer_id"], ["updated_at"])
    return latest.filter(is_active())


def prepare_products(raw: DataFrame) -> DataFrame:
    return raw.withColumns(cleaning(PRODUCT_TEXT, PRODUCT_TYPES))


def product_rules() -> list[tuple[str, Column]]:
    """Ordered product rules, each a predicate that a valid row satisfies."""
    unit, cost = F.col("unit_price"), F.col("cost_price")
    return [
        ("missing_price", unit.isNotNull() & cost.isNotNull()),
        ("invalid_price", (unit > 0) & (cost > 0) & (cost <= unit)),
        ("inactive", F.col("active_flag") == "Y"),
    ]


def clean_products(raw: DataFrame) -> DataFrame:
    df = prepare_products(raw)
    for _, rule in product_rules():
        df = df.filter(rule)
    return df


def prepare_orders(raw: DataFrame) -> DataFrame:
    return raw.withColumns(cleaning((), ORDER_TYPES))


def order_rules(excluded: Sequence[str] = EXCLUDED_STATUSES) -> list[tuple[str, Column]]:
    """F5, F6. ``NOT IN`` is three-valued: a NULL status or quantity fails."""
    return [
        ("non_positive_quantity", F.col("quantity") > 0),
        ("excluded_status", ~F.col("order_status").isin(*excluded)),
    ]


def clean_orders(raw: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES) -> DataFrame:
    df = prepare_orders(raw)
    return df.filter(F.col("quantity") > 0).filter(~F.col("order_status").isin(*excluded))
