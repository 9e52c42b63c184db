"""Bronze -> Silver -> Gold assembly over the raw retail tables (entry point A)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from ..operators import clean, sales
from ..operators.quality import mismatches
from ..sources import bindings
from ..sources.raw import stamp_lineage


def to_bronze(raw: DataFrame, source_file: str | None = None) -> DataFrame:
    """Lineage stamp. Without an explicit name the scan's own file path is used."""
    return stamp_lineage(raw, source_file)


class Silver:
    """The Silver layer; each table is planned on first use only."""

    def __init__(self, customers: DataFrame, products: DataFrame, orders: DataFrame):
        self._raw = {"customers": customers, "products": products, "orders": orders}

    @cached_property
    def customers(self) -> DataFrame:
        return clean.clean_customers(self._raw["customers"])

    @cached_property
    def products(self) -> DataFrame:
        return clean.clean_products(self._raw["products"])

    @cached_property
    def orders(self) -> DataFrame:
        return clean.clean_orders(self._raw["orders"])

    @cached_property
    def enriched(self) -> DataFrame:
        return sales.enrich_sales(self.orders, self.customers, self.products)


def silver_from_raw(customers: DataFrame, products: DataFrame, orders: DataFrame) -> Silver:
    return Silver(customers, products, orders)


class _LazyRaw:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def customers(self) -> DataFrame:
        return bindings.raw_customers(self.spark, self.sf_dir)

    @cached_property
    def products(self) -> DataFrame:
        return bindings.raw_products(self.spark, self.sf_dir)

    @cached_property
    def orders(self) -> DataFrame:
        return bindings.raw_orders(self.spark, self.sf_dir)


class _SilverFromBindings(Silver):
    def __init__(self, spark: SparkSession, sf_dir: str):
        self._lazy = _LazyRaw(spark, sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return clean.clean_customers(self._lazy.customers)

    @cached_property
    def products(self) -> DataFrame:
        return clean.clean_products(self._lazy.products)

    @cached_property
    def orders(self) -> DataFrame:
        return clean.clean_orders(self._lazy.orders)


def silver(spark: SparkSession, sf_dir: str) -> Silver:
    return _SilverFromBindings(spark, sf_dir)


def gold(enriched: DataFrame) -> dict[str, DataFrame]:
    return {
        "gold_monthly_category_sales": sales.monthly_category_sales(enriched),
        "gold_city_sales": sales.city_sales(enriched),
        "gold_customer_value": sales.customer_value(enriched),
        "gold_top_products_by_category": sales.top_products_by_category(enriched),
    }


def views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every layer by table name, for SQL scripts: Bronze, Silver and the Gold monthly mart."""
    raw = bindings.raw_retail(spark, sf_dir)
    s = silver_from_raw(raw["customers"], raw["products"], raw["sales_orders"])
    return {
        "bronze_customers": to_bronze(raw["customers"], "customers.csv"),
        "bronze_products": to_bronze(raw["products"], "products.csv"),
        "bronze_sales_orders": to_bronze(raw["sales_orders"], "sales_orders.csv"),
        "silver_customers": s.customers,
        "silver_products": s.products,
        "silver_sales_orders": s.orders,
        "silver_enriched_sales": s.enriched,
        "gold_monthly_category_sales": sales.monthly_category_sales(s.enriched),
    }


def monthly_mismatches(enriched: DataFrame, gold_monthly: DataFrame) -> DataFrame:
    """Months and categories on which the monthly summary and the Gold mart disagree (a cent is allowed)."""
    return mismatches(
        sales.monthly_summary(enriched), gold_monthly, ["order_month", "category"],
        exact=["order_count", "total_quantity"], tolerant={"total_revenue": "0.01"}, names=("sql", "gold"),
    )
