"""The weekly run as one function, in dependency order, with its gates.

Bronze -> Silver -> Gold are handed over by table name (each layer reads what the
previous one wrote), then the zero-row checks run (D5), the event table must not be
empty (D10), events are published and the topic is drained into the consumed log.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sales
from ..operators.clean import clean_customers, clean_orders, clean_products
from ..sources import tables
from ..sources.raw import stamp_lineage
from ..streaming import events
from . import sqlrun
from .retail import gold, monthly_mismatches

TOTALS = ("orders", "units", "revenue")


def silver_totals() -> dict[str, Column]:
    """Control totals of enriched sales."""
    return dict(zip(TOTALS, (F.count(F.lit(1)), F.sum("quantity"), F.sum("net_sales")), strict=True))


def gold_totals() -> dict[str, Column]:
    """The same totals of the monthly mart, which sums the sales up."""
    return {total: F.sum(column) for total, column in zip(TOTALS, ("order_count", "total_quantity", "total_revenue"), strict=True)}


BUCKET_ROWS = 1_000_000  # order lines a bucket
RAW_NAMES = ("customers", "products", "sales_orders")


@dataclass
class RunReport:
    rows: dict[str, int] = field(default_factory=dict)
    checks: dict[str, int] = field(default_factory=dict)
    totals: dict[str, dict] = field(default_factory=dict)  # observed on the writes
    published: int = 0


def build_layers(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    namespace: str,
    report: RunReport,
    buckets: int | None = None,
) -> None:
    """Write every layer. With ``buckets``, Silver customers and orders are stored
    bucketed by ``customer_id`` and enrichment joins customers first, so the largest join
    reads co-located buckets instead of shuffling the fact table; enriched sales are
    partitioned by month so month filters prune files. ``buckets`` is the least number: a bucket is
    one task of the write and of the join, so their number grows with the orders (``BUCKET_ROWS``)."""
    t = lambda n: tables.qualified(namespace, n)
    tables.ensure_namespace(spark, namespace)
    report.rows |= tables.save_all(
        {f"bronze_{n}": stamp_lineage(raw[n], f"{n}.csv") for n in RAW_NAMES}, namespace
    )
    by_customer = (max(buckets, -(-report.rows["bronze_sales_orders"] // BUCKET_ROWS)), ["customer_id"]) if buckets else None
    silver = {
        "silver_customers": (clean_customers(tables.read(spark, t("bronze_customers"))), by_customer),
        "silver_products": (clean_products(tables.read(spark, t("bronze_products"))), None),
        "silver_sales_orders": (clean_orders(tables.read(spark, t("bronze_sales_orders"))), by_customer),
    }
    report.rows |= tables.at_once({n: partial(tables.save, df, t(n), bucket_by=by) for n, (df, by) in silver.items()})
    enriched = sales.enrich_sales(
        tables.read(spark, t("silver_sales_orders")),
        tables.read(spark, t("silver_customers")),
        tables.read(spark, t("silver_products")),
        customers_first=bool(buckets),
    )
    by_month = ["order_month"] if buckets else None
    report.totals["silver"] = tables.save_observed(enriched, t("silver_enriched_sales"), silver_totals(), partition_by=by_month)
    report.rows["silver_enriched_sales"] = int(report.totals["silver"]["rows"])
    marts = gold(tables.read(spark, t("silver_enriched_sales")))
    metrics = {"gold_monthly_category_sales": gold_totals()}
    saved = tables.at_once({n: partial(tables.save_observed, df, t(n), metrics.get(n, {})) for n, df in marts.items()})
    report.totals["gold"] = saved["gold_monthly_category_sales"]
    report.rows |= {n: int(seen["rows"]) for n, seen in saved.items()}


def check_layers(spark: SparkSession, namespace: str, report: RunReport) -> None:
    t = lambda n: tables.read(spark, tables.qualified(namespace, n))
    recon = monthly_mismatches(
        sales.enrich_sales(t("silver_sales_orders"), t("silver_customers"), t("silver_products"), customers_first=True),
        t("gold_monthly_category_sales"),
    )
    report.checks = sqlrun.run_checks({"monthly_matches_gold": recon})
    differ = [m for m in TOTALS if report.totals and report.totals["silver"][m] != report.totals["gold"][m]]
    if differ:
        raise ValueError(f"silver and gold differ in {', '.join(differ)}")


def publish_events(spark: SparkSession, namespace: str, topic: str, report: RunReport) -> None:
    gold_monthly = tables.read(spark, tables.qualified(namespace, "gold_monthly_category_sales"))
    evts = events.require_rows(events.build_events(gold_monthly), "gold event table")
    report.published = events.publish(evts, topic)


def run_pipeline(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    namespace: str,
    topic: str,
    consumed: str,
    checkpoint: str,
    buckets: int | None = None,
) -> RunReport:
    report = RunReport()
    build_layers(spark, raw, namespace, report, buckets)
    check_layers(spark, namespace, report)
    publish_events(spark, namespace, topic, report)
    events.consume(events.stream_events(spark, topic), consumed, checkpoint, fmt="json")
    return report
