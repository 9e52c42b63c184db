"""Registered queries: one per operator of the inventory, each over the whole tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL) share
column names and types so the driver can compare them value by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, quality, rank, sales, upsert, weather
from ..session import materialize, shared_dir
from ..sources import bindings, tables
from ..sources import raw as raw_sources
from ..streaming import events, log
from . import oracle as o
from . import pipeline, retail, sqlrun
from . import weather as weather_plan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ----------------------------------------------------------------------------- silver

CUSTOMER_COLS = (
    "customer_id customer_name city state region customer_segment signup_date date_of_birth "
    "updated_at loyalty_points is_active"
).split()
PRODUCT_COLS = (
    "product_id product_name category subcategory supplier_name unit_price cost_price stock_quantity active_flag"
).split()
ORDER_COLS = (
    "order_id customer_id product_id order_timestamp promised_delivery_date actual_delivery_date "
    "quantity discount_pct order_status"
).split()


@register("clean_customers", f"{o.RETAIL} SELECT {', '.join(CUSTOMER_COLS)} FROM silver_customers")
def q_clean_customers(spark, sf):
    return retail.silver(spark, sf).customers.select(*CUSTOMER_COLS)


@register("clean_products", f"{o.RETAIL} SELECT {', '.join(PRODUCT_COLS)} FROM silver_products")
def q_clean_products(spark, sf):
    return retail.silver(spark, sf).products.select(*PRODUCT_COLS)


@register("clean_orders", f"{o.RETAIL} SELECT {', '.join(ORDER_COLS)} FROM silver_orders")
def q_clean_orders(spark, sf):
    return retail.silver(spark, sf).orders.select(*ORDER_COLS)


ENRICHED_COLS = (
    "order_id customer_id product_id order_month category city state quantity unit_price "
    "gross_amount discount_amount net_sales profit_per_unit delivery_days late_delivery_flag"
).split()


def _via_csv(spark, raw, name):
    path = shared_dir(spark, f"csv-{name}")
    raw_sources.write_raw_csv(raw, path)
    return raw_sources.read_raw_csv(spark, path)


@register("csv_roundtrip_customers", f"{o.RETAIL} SELECT {', '.join(CUSTOMER_COLS)} FROM silver_customers")
def q_csv_roundtrip_customers(spark, sf):
    """S1 on the whole data: raw customers landed as CSV, scanned back untyped, cleaned."""
    return clean.clean_customers(_via_csv(spark, bindings.raw_customers(spark, sf), "customers")).select(*CUSTOMER_COLS)


@register("csv_roundtrip_orders", f"{o.RETAIL} SELECT {', '.join(ORDER_COLS)} FROM silver_orders")
def q_csv_roundtrip_orders(spark, sf):
    """S1 on the whole data: raw order lines landed as CSV, scanned back untyped, cleaned."""
    return clean.clean_orders(_via_csv(spark, bindings.raw_orders(spark, sf), "orders")).select(*ORDER_COLS)


@register("enriched_sales", f"{o.RETAIL} SELECT {', '.join(ENRICHED_COLS)} FROM enriched")
def q_enriched_sales(spark, sf):
    return retail.silver(spark, sf).enriched.select(*ENRICHED_COLS)


# ------------------------------------------------------------------------------- gold


@register(
    "monthly_category_sales",
    f"""{o.RETAIL}
SELECT category, order_month,
  COUNT(*) AS order_count,
  CAST(SUM(quantity) AS BIGINT) AS total_quantity,
  CAST(SUM(net_sales) AS DECIMAL(38,8)) AS total_revenue,
  {o.avg_dec('SUM(net_sales)', 'COUNT(net_sales)', 8, 12)} AS avg_order_value,
  MIN(net_sales) AS min_order_value,
  MAX(net_sales) AS max_order_value,
  CAST(SUM(SUM(net_sales)) OVER (PARTITION BY category ORDER BY order_month ASC NULLS FIRST
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,8)) AS running_total_revenue
FROM enriched GROUP BY category, order_month""",
)
def q_monthly_category_sales(spark, sf):
    return sales.monthly_category_sales(retail.silver(spark, sf).enriched)


AVG_NET = o.avg_dec("SUM(net_sales)", "COUNT(net_sales)", 8, 12)


@register(
    "city_sales",
    f"""{o.RETAIL}
SELECT city, state, COUNT(*) AS order_count,
  CAST(SUM(net_sales) AS DECIMAL(38,8)) AS total_revenue,
  {AVG_NET} AS avg_order_value
FROM enriched GROUP BY city, state""",
)
def q_city_sales(spark, sf):
    return sales.city_sales(retail.silver(spark, sf).enriched)


LATEST_ORDER_SQL = """latest_order AS (
  SELECT customer_id, order_timestamp, order_id FROM (
    SELECT customer_id, order_timestamp, order_id,
      ROW_NUMBER() OVER (PARTITION BY customer_id
                         ORDER BY order_timestamp DESC NULLS LAST, order_id DESC NULLS LAST) AS rn
    FROM enriched) WHERE rn = 1
)"""


@register(
    "customer_value",
    f"""{o.RETAIL}, {LATEST_ORDER_SQL},
per_customer AS (
  SELECT customer_id, state, CAST(SUM(net_sales) AS DECIMAL(38,8)) AS lifetime_revenue
  FROM enriched GROUP BY customer_id, state
)
SELECT pc.customer_id, pc.state, pc.lifetime_revenue, l.order_id AS latest_order,
  CAST(DENSE_RANK() OVER (PARTITION BY pc.state ORDER BY pc.lifetime_revenue DESC NULLS LAST) AS INTEGER)
    AS state_rank
FROM per_customer pc LEFT JOIN latest_order l ON l.customer_id = pc.customer_id""",
)
def q_customer_value(spark, sf):
    return sales.customer_value(retail.silver(spark, sf).enriched)


PER_PRODUCT_SQL = """per_product AS (
  SELECT category, product_id, product_name, COUNT(*) AS order_count,
    CAST(SUM(quantity) AS BIGINT) AS total_quantity,
    CAST(SUM(net_sales) AS DECIMAL(38,8)) AS total_revenue
  FROM enriched GROUP BY category, product_id, product_name
)"""
TOP_PRODUCTS_SQL = f"""{o.RETAIL}, {PER_PRODUCT_SQL}
SELECT *, CAST(RANK() OVER (PARTITION BY category ORDER BY total_revenue DESC NULLS LAST) AS INTEGER)
  AS revenue_rank
FROM per_product"""


@register("top_products", TOP_PRODUCTS_SQL)
def q_top_products(spark, sf):
    return sales.top_products_by_category(retail.silver(spark, sf).enriched)


@register("rank_products", TOP_PRODUCTS_SQL)
def q_rank_products(spark, sf):
    """A7 + W4 through the generic ranked totals; no window holds a whole category."""
    return sales.ranked_totals(retail.silver(spark, sf).enriched, ["category"], ["product_id", "product_name"], "rank", "revenue_rank")


@register(
    "latest_version",
    f"""{o.RETAIL}
SELECT {', '.join(CUSTOMER_COLS)}, _versions AS versions FROM latest_customers""",
)
def q_latest_version(spark, sf):
    raw = bindings.raw_customers(spark, sf)
    return clean.latest_by_key(clean.prepare_customers(raw), ["customer_id"], ["updated_at"], "versions")


@register("latest_order", f"{o.RETAIL}, {LATEST_ORDER_SQL} SELECT * FROM latest_order")
def q_latest_order(spark, sf):
    enriched = retail.silver(spark, sf).enriched.select("customer_id", "order_timestamp", "order_id")
    return clean.latest_by_key(enriched, ["customer_id"], ["order_timestamp"])


PER_CUSTOMER_SQL = """per_customer AS (
  SELECT state, customer_id, customer_name, COUNT(*) AS order_count,
    CAST(SUM(net_sales) AS DECIMAL(38,8)) AS lifetime_revenue
  FROM enriched GROUP BY state, customer_id, customer_name
), ranked_customers AS (
  SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY state ORDER BY lifetime_revenue DESC NULLS LAST) AS INTEGER)
    AS state_rank
  FROM per_customer
)"""


@register("dense_rank_customers", f"{o.RETAIL}, {PER_CUSTOMER_SQL} SELECT * FROM ranked_customers")
def q_dense_rank_customers(spark, sf):
    per_customer = (
        retail.silver(spark, sf)
        .enriched.groupBy("state", "customer_id", "customer_name")
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("net_sales").alias("lifetime_revenue"))
    )
    return rank.rank_within(per_customer, ["state"], "lifetime_revenue", "dense_rank", out="state_rank")


@register(
    "top3_customers_state",
    f"{o.RETAIL}, {PER_CUSTOMER_SQL} SELECT * FROM ranked_customers WHERE state_rank <= 3",
)
def q_top3_customers_state(spark, sf):
    """A6 + W8 through the generic ranked totals."""
    ranked = sales.ranked_totals(
        retail.silver(spark, sf).enriched, ["state"], ["customer_id", "customer_name"], "dense_rank", "state_rank",
        measures={"order_count": F.count(F.lit(1)), "lifetime_revenue": F.sum("net_sales")}, by="lifetime_revenue", k=3,
    )
    return ranked


@register(
    "top5_products_category",
    f"""{o.RETAIL}
SELECT * FROM (
  SELECT category, product_id, product_name, CAST(SUM(net_sales) AS DECIMAL(38,8)) AS total_revenue,
    CAST(RANK() OVER (PARTITION BY category ORDER BY SUM(net_sales) DESC NULLS LAST) AS INTEGER) AS revenue_rank
  FROM enriched GROUP BY category, product_id, product_name
) WHERE revenue_rank <= 5""",
)
def q_top5_products_category(spark, sf):
    return sqlrun.run_script(spark, "top_products_per_category", retail.views(spark, sf))


@register(
    "running_revenue",
    f"""{o.RETAIL}
SELECT category, order_month, CAST(SUM(net_sales) AS DECIMAL(38,8)) AS total_revenue,
  CAST(SUM(SUM(net_sales)) OVER (PARTITION BY category ORDER BY order_month ASC NULLS FIRST
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,8)) AS running_total_revenue
FROM enriched GROUP BY category, order_month""",
)
def q_running_revenue(spark, sf):
    monthly = sales.monthly_category_sales(retail.silver(spark, sf).enriched)
    return monthly.select("category", "order_month", "total_revenue", "running_total_revenue")


MONTHLY_SUMMARY_SQL = f"""{o.RETAIL}
SELECT order_month, category, COUNT(*) AS order_count,
  COUNT(DISTINCT customer_id) AS customer_count,
  CAST(SUM(quantity) AS BIGINT) AS total_quantity,
  CAST(SUM(net_sales) AS DECIMAL(38,8)) AS total_revenue,
  CAST({AVG_NET} AS DECIMAL(18,2)) AS avg_order_value,
  CAST(SUM(CASE WHEN late_delivery_flag THEN 1 ELSE 0 END) AS BIGINT) AS late_delivery_count
FROM enriched GROUP BY order_month, category"""


@register("sql_monthly_summary", MONTHLY_SUMMARY_SQL)
def q_sql_monthly_summary(spark, sf):
    return sales.monthly_summary(retail.silver(spark, sf).enriched)


def recon_sql(gold: str) -> str:
    """Disagreements between the monthly summary ``s`` and ``gold``, a query over ``s``."""
    both = ", ".join(f"s.{m} AS sql_{m}, g.{m} AS gold_{m}" for m in ("order_count", "total_quantity", "total_revenue"))
    return f"""{o.RETAIL}, s AS (
  SELECT order_month, category, COUNT(*) AS order_count, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
    CAST(SUM(net_sales) AS DECIMAL(38,8)) AS total_revenue
  FROM enriched GROUP BY order_month, category), g AS ({gold})
SELECT * FROM (
  SELECT coalesce(s.order_month, g.order_month) AS order_month, coalesce(s.category, g.category) AS category, {both},
    CASE WHEN s.order_count IS NULL THEN 'only_in_gold' WHEN g.order_count IS NULL THEN 'only_in_sql'
         WHEN s.order_count <> g.order_count OR s.total_quantity IS DISTINCT FROM g.total_quantity
           OR coalesce(abs(s.total_revenue - g.total_revenue) > 0.01, s.total_revenue IS DISTINCT FROM g.total_revenue)
         THEN 'values_differ' END AS reason
  FROM s FULL OUTER JOIN g ON s.order_month IS NOT DISTINCT FROM g.order_month
    AND s.category IS NOT DISTINCT FROM g.category)
WHERE reason IS NOT NULL"""


@register("recon_monthly", recon_sql("SELECT * FROM s"))
def q_recon_monthly(spark, sf):
    """The zero-row reconciliation of summary and mart; a pass returns no row."""
    enriched = retail.silver(spark, sf).enriched
    return retail.monthly_mismatches(enriched, sales.monthly_category_sales(enriched))


@register(
    "recon_monthly_damaged",
    recon_sql("""SELECT order_month, category, order_count + CASE WHEN order_month LIKE '%-03' THEN 1 ELSE 0 END AS order_count,
    total_quantity, CAST(total_revenue + CASE WHEN order_month LIKE '%-05' THEN 0.02 WHEN order_month LIKE '%-06' THEN 0.01 ELSE 0 END
      AS DECIMAL(38,8)) AS total_revenue
  FROM s WHERE order_month IS NULL OR order_month NOT LIKE '%-07'"""),
)
def q_recon_monthly_damaged(spark, sf):
    """D6 over a mart that lacks every July, miscounts March and is two cents off in May (June's one cent is allowed)."""
    enriched = retail.silver(spark, sf).enriched
    gold, month = sales.monthly_category_sales(enriched), F.col("order_month")
    off = F.when(month.like("%-05"), F.lit("0.02")).when(month.like("%-06"), F.lit("0.01")).otherwise(F.lit("0")).cast("decimal(4,2)")
    gold = gold.withColumns({
        "order_count": F.col("order_count") + F.when(month.like("%-03"), 1).otherwise(0),
        "total_revenue": (F.col("total_revenue") + off).cast("decimal(38,8)"),
    })
    return retail.monthly_mismatches(enriched, gold.where(month.isNull() | ~month.like("%-07")))


@register(
    "layer_counts",
    f"""{o.RETAIL}
SELECT 'customers' AS table_name, (SELECT COUNT(*) FROM raw_customers) AS bronze_rows,
  (SELECT COUNT(*) FROM silver_customers) AS silver_rows
UNION ALL SELECT 'products', (SELECT COUNT(*) FROM raw_products), (SELECT COUNT(*) FROM silver_products)
UNION ALL SELECT 'sales_orders', (SELECT COUNT(*) FROM raw_orders), (SELECT COUNT(*) FROM silver_orders)
UNION ALL SELECT 'enriched_sales', CAST(NULL AS BIGINT), (SELECT COUNT(*) FROM enriched)""",
)
def q_layer_counts(spark, sf):
    v = retail.views(spark, sf)
    names = ("customers", "products", "sales_orders")
    bronze = {n: v[f"bronze_{n}"] for n in names}
    return quality.layer_counts({"bronze": bronze, "silver": {n: v[f"silver_{n}"] for n in (*names, "enriched_sales")}})


# ---------------------------------------------------------------------------- quality


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _funnel_sql(table: str, src: str, rules: list[tuple[str, str]]) -> str:
    cases = " ".join(f"WHEN NOT coalesce({cond}, false) THEN {i}" for i, (_, cond) in enumerate(rules, 1))
    counts = ", ".join(f"COUNT(*) FILTER (WHERE step = {i}) AS r{i}" for i in range(1, len(rules) + 1))
    parts, removed = [], "0"
    for i, (name, _) in enumerate(rules, 1):
        rows_in = f"CAST(total - ({removed}) AS BIGINT)"
        removed = f"{removed} + r{i}"
        parts.append(
            f"SELECT '{table}' AS table_name, {i} AS step, '{name}' AS rule, {rows_in} AS rows_in, "
            f"r{i} AS rejected, CAST(total - ({removed}) AS BIGINT) AS rows_out "
            f"FROM (SELECT COUNT(*) AS total, {counts} FROM (SELECT CASE {cases} ELSE 0 END AS step FROM {src}))"
        )
    return " UNION ALL ".join(parts)


FUNNEL_SQL = f"""{o.RETAIL}
SELECT 'customers' AS table_name, 1 AS step, 'older_version' AS rule, total AS rows_in, r1 AS rejected,
  total - r1 AS rows_out FROM (
  SELECT CAST(SUM(_versions) AS BIGINT) AS total, CAST(SUM(_versions) - COUNT(*) AS BIGINT) AS r1,
    COUNT(*) FILTER (WHERE NOT coalesce(is_active = 'Y', false)) AS r2 FROM latest_customers)
UNION ALL
SELECT 'customers', 2, 'inactive', total - r1, r2, total - r1 - r2 FROM (
  SELECT CAST(SUM(_versions) AS BIGINT) AS total, CAST(SUM(_versions) - COUNT(*) AS BIGINT) AS r1,
    COUNT(*) FILTER (WHERE NOT coalesce(is_active = 'Y', false)) AS r2 FROM latest_customers)
UNION ALL
{_funnel_sql('products', 'prep_products', [
    ('missing_price', 'unit_price IS NOT NULL AND cost_price IS NOT NULL'),
    ('invalid_price', 'unit_price > 0 AND cost_price > 0 AND cost_price <= unit_price'),
    ('inactive', "active_flag = 'Y'")])}
UNION ALL
{_funnel_sql('sales_orders', 'prep_orders', [
    ('non_positive_quantity', 'quantity > 0'),
    ('excluded_status', "NOT order_status IN ('PENDING', 'CANCELLED')")])}"""


@register("rejection_funnel", FUNNEL_SQL)
def q_rejection_funnel(spark, sf):
    raw = bindings.raw_retail(spark, sf)
    latest = clean.latest_by_key(clean.prepare_customers(raw["customers"]), ["customer_id"], ["updated_at"], "_versions")
    return _union(
        [
            quality.dedupe_funnel(latest, "_versions", clean.is_active(), "customers", "inactive"),
            quality.rejection_funnel(clean.prepare_products(raw["products"]), clean.product_rules(), "products"),
            quality.rejection_funnel(clean.prepare_orders(raw["sales_orders"]), clean.order_rules(), "sales_orders"),
        ]
    )


@register(
    "join_loss",
    f"""{o.RETAIL},
pk AS (SELECT product_id, COUNT(*) AS np FROM silver_products GROUP BY product_id),
ck AS (SELECT customer_id, COUNT(*) AS nc FROM silver_customers GROUP BY customer_id)
SELECT COUNT(*) AS orders_in,
  COUNT(*) FILTER (WHERE pk.np IS NULL) AS lost_at_product,
  COUNT(*) FILTER (WHERE pk.np IS NOT NULL AND ck.nc IS NULL) AS lost_at_customer,
  CAST(coalesce(SUM(pk.np * ck.nc), 0) AS BIGINT) AS orders_out
FROM silver_orders o LEFT JOIN pk ON pk.product_id = o.product_id
LEFT JOIN ck ON ck.customer_id = o.customer_id""",
)
def q_join_loss(spark, sf):
    s = retail.silver(spark, sf)
    return quality.join_loss(s.orders, s.products, s.customers)


EVENT_ROWS_SQL = f"""{o.RETAIL},
gold AS (
  SELECT category, order_month, COUNT(*) AS order_count, SUM(quantity) AS total_quantity,
    SUM(net_sales) AS total_revenue
  FROM enriched GROUP BY category, order_month
),
event_rows AS (
  SELECT 'SALES-' || order_month || '-' || category AS event_id,
    'MONTHLY_CATEGORY_SALES_READY' AS event_type,
    order_month AS sales_month, category,
    CAST(order_count AS BIGINT) AS order_count,
    CAST(total_quantity AS BIGINT) AS total_quantity,
    CAST(round_even(total_revenue, 2) AS DECIMAL(18,2)) AS total_revenue
  FROM gold WHERE order_month IS NOT NULL AND category IS NOT NULL
)"""


@register(
    "control_totals",
    f"""{EVENT_ROWS_SQL}
SELECT 'silver' AS layer, COUNT(*) AS orders, CAST(SUM(quantity) AS BIGINT) AS units,
  CAST(SUM(net_sales) AS DECIMAL(38,2)) AS revenue FROM enriched
UNION ALL SELECT 'gold', CAST(SUM(order_count) AS BIGINT), CAST(SUM(total_quantity) AS BIGINT),
  CAST(SUM(total_revenue) AS DECIMAL(38,2)) FROM gold
UNION ALL SELECT 'events', CAST(SUM(order_count) AS BIGINT), CAST(SUM(total_quantity) AS BIGINT),
  CAST(SUM(total_revenue) AS DECIMAL(38,2)) FROM event_rows
UNION ALL SELECT 'event_rejects', CAST(SUM(order_count) AS BIGINT), CAST(SUM(total_quantity) AS BIGINT),
  CAST(SUM(total_revenue) AS DECIMAL(38,2)) FROM gold WHERE order_month IS NULL OR category IS NULL""",
)
def q_control_totals(spark, sf):
    return _control_totals(spark, sf)[0]


def _control_totals(spark, sf):
    """The control totals, and the number of event rows that the revenue tolerance goes by."""
    # every layer derives from the enriched rows: compute the columns they need once
    enriched = materialize(retail.silver(spark, sf).enriched.select("quantity", "net_sales", "category", "order_month"))
    gold = materialize(sales.monthly_category_sales(enriched))
    totals = quality.control_totals(
        {
            "silver": (enriched, None, "quantity", "net_sales"),
            "gold": (gold, "order_count", "total_quantity", "total_revenue"),
            "events": (events.build_events(gold), "order_count", "total_quantity", "total_revenue"),
            "event_rejects": (events.event_rejects(gold), "order_count", "total_quantity", "total_revenue"),
        }
    )
    return totals, events.build_events(gold).count()


RAW_CUSTOMER_COLS = CUSTOMER_COLS


def _profile_sql(src: str, cols, types: dict[str, str]) -> str:
    duck = {"date": "DATE", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER"}
    parts = []
    for c in cols:
        typed = f"TRY_CAST({c} AS {duck[types[c]]})" if c in types else c
        bad = (
            f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {duck[types[c]]}) IS NULL)"
            if c in types
            else "CAST(0 AS BIGINT)"
        )
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, {bad} AS bad_type_count, "
            f"COUNT(DISTINCT {c}) AS distinct_count, CAST(MIN({typed}) AS VARCHAR) AS min_value, "
            f"CAST(MAX({typed}) AS VARCHAR) AS max_value FROM {src}"
        )
    return " UNION ALL ".join(parts)


@register("profile", f"{o.RETAIL} {_profile_sql('raw_customers', CUSTOMER_COLS, clean.CUSTOMER_TYPES)}")
def q_profile(spark, sf):
    return quality.profile(bindings.raw_customers(spark, sf), clean.CUSTOMER_TYPES)


def _counts_sql(columns) -> str:
    per = [(c, c) for c in columns] + [("*", f"row({', '.join(columns)})::VARCHAR")]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, CAST(SUM(n) AS BIGINT) AS row_count, CAST(coalesce(SUM(n) FILTER (WHERE v IS NULL), 0) AS BIGINT) AS null_count,
  COUNT(v) AS distinct_count, COUNT(*) FILTER (WHERE v IS NOT NULL AND n > 1) AS repeated_values,
  CAST(coalesce(SUM(n - 1) FILTER (WHERE v IS NOT NULL), 0) AS BIGINT) AS surplus_rows
FROM (SELECT {v} AS v, COUNT(*) AS n FROM twice GROUP BY ALL)"""
        for name, v in per
    )


@register("profile_counts", f"{o.RETAIL}, twice AS (SELECT * FROM raw_customers UNION ALL SELECT * FROM raw_customers WHERE region = 'ASIA') {_counts_sql(CUSTOMER_COLS)}")
def q_profile_counts(spark, sf):
    """M7 over customers of which one region's rows come twice: distinct values and whole-row duplicates."""
    raw = bindings.raw_customers(spark, sf).select(*CUSTOMER_COLS)
    return quality.profile_counts(raw.union(raw.where("region = 'ASIA'")))


def _keys_sql(table: str, src: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{key}' AS key_columns, CAST(SUM(n) AS BIGINT) AS row_count, "
        f"COUNT(*) AS distinct_keys, COUNT(*) FILTER (WHERE n > 1) AS duplicated_keys "
        f"FROM (SELECT {key}, COUNT(*) AS n FROM {src} GROUP BY {key})"
    )


@register(
    "business_keys",
    f"""{o.RETAIL} {_keys_sql('customers', 'raw_customers', 'customer_id')}
UNION ALL {_keys_sql('products', 'raw_products', 'product_id')}
UNION ALL {_keys_sql('sales_orders', 'raw_orders', 'order_id')}""",
)
def q_business_keys(spark, sf):
    raw = bindings.raw_retail(spark, sf)
    return _union(
        [
            quality.business_keys(raw["customers"], ["customer_id"], "customers"),
            quality.business_keys(raw["products"], ["product_id"], "products"),
            quality.business_keys(raw["sales_orders"], ["order_id"], "sales_orders"),
        ]
    )


@register(
    "sample_limit",
    f"""{o.RETAIL} SELECT {', '.join(ORDER_COLS)} FROM silver_orders
ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in ORDER_COLS)} LIMIT 20""",
)
def q_sample_limit(spark, sf):
    """O3: the first 20 Silver orders by id (every column breaks ties); the limit is the feature."""
    return retail.silver(spark, sf).orders.select(*ORDER_COLS).orderBy(*ORDER_COLS).limit(20)


# ----------------------------------------------------------------------------- events


def _gold_events(spark, sf):
    return events.build_events(sales.monthly_category_sales(retail.silver(spark, sf).enriched))


@register("event_rows", f"{EVENT_ROWS_SQL} SELECT * FROM event_rows")
def q_event_rows(spark, sf):
    return _gold_events(spark, sf)


@register("event_json_roundtrip", f"{EVENT_ROWS_SQL} SELECT *, event_id AS key FROM event_rows")
def q_event_json_roundtrip(spark, sf):
    msgs = events.to_messages(_gold_events(spark, sf))
    doc = F.from_json(F.col("value"), events.EVENT_SCHEMA)
    return msgs.select("key", doc.alias("_e")).select("_e.*", "key")


@register(
    "event_log_rollup",
    f"""{EVENT_ROWS_SQL}
SELECT COUNT(*) AS events, CAST(SUM(order_count) AS BIGINT) AS orders,
  CAST(SUM(total_quantity) AS BIGINT) AS units, CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS revenue
FROM event_rows""",
)
def q_event_log_rollup(spark, sf):
    """T5 over a replayed log: everything is published twice, each id counts once."""
    topic = shared_dir(spark, "topic")
    evts = materialize(_gold_events(spark, sf))  # published twice: compute once
    events.publish(evts, topic)
    events.publish(evts, topic)
    return events.event_log_rollup(events.read_log(spark, topic))


@register("stream_dedupe", f"{EVENT_ROWS_SQL} SELECT * FROM event_rows")
def q_stream_dedupe(spark, sf):
    """Publish, replay, then drain the topic with a checkpointed, deduplicating stream."""
    topic, sink, ckpt = (shared_dir(spark, n) for n in ("topic", "sink", "checkpoint"))
    evts = materialize(_gold_events(spark, sf))  # published twice: compute once
    events.publish(evts, topic)
    events.publish(evts, topic)
    events.consume(events.dedupe_events(events.stream_events(spark, topic)), sink, ckpt)
    return spark.read.parquet(sink)


@register(
    "numbered_log",
    f"""{EVENT_ROWS_SQL}
SELECT ROW_NUMBER() OVER (ORDER BY again, sales_month, category) AS seq, event_id
FROM (SELECT 0 AS again, * FROM event_rows UNION ALL SELECT 1, * FROM event_rows WHERE order_count % 2 = 0)""",
)
def q_numbered_log(spark, sf):
    """All events are published, then some of them again; numbers show the order."""
    topic = shared_dir(spark, "log")
    evts = materialize(_gold_events(spark, sf))
    log.publish(evts, topic)
    log.publish(evts.where("order_count % 2 = 0"), topic)
    return log.read_log(spark, topic).select("seq", F.col("key").alias("event_id"))


@register(
    "bounded_read",
    f"""{EVENT_ROWS_SQL}
SELECT CASE WHEN seq <= 20 THEN 0 ELSE 1 END::INTEGER AS batch, seq, event_id
FROM (SELECT ROW_NUMBER() OVER (ORDER BY sales_month, category) AS seq, event_id FROM event_rows) WHERE seq <= 30""",
)
def q_bounded_read(spark, sf):
    """The first 20 messages, then after a restart the 10 behind them."""
    topic, sink, progress = (shared_dir(spark, n) for n in ("log", "sink", "progress"))
    log.publish(events.require_rows(materialize(_gold_events(spark, sf)), "gold event table"), topic)
    for n in (20, 10):
        log.read_next(spark, topic, sink, progress, n)
    return log.read_sink(spark, sink).select("batch", "seq", F.col("key").alias("event_id"))


@register("replayed_batch", f"{EVENT_ROWS_SQL} SELECT * FROM event_rows UNION ALL SELECT * FROM event_rows WHERE order_count % 2 = 0")
def q_replayed_batch(spark, sf):
    """A stream with empty payloads, drained twice; its first batch is then repeated and replaces itself."""
    topic, sink, ckpt = (shared_dir(spark, n) for n in ("topic", "sink", "checkpoint"))
    evts = materialize(_gold_events(spark, sf))
    stream = spark.readStream.format("text").load
    for part in (evts, evts.where("order_count % 2 = 0")):
        events.publish(part, topic)
        part.select(F.lit("").alias("value")).write.mode("append").text(topic)
        log.consume_batches(stream(topic).filter(F.length("value") > 0), sink, ckpt)
    first = materialize(log.read_sink(spark, sink).where("batch = 0").select("value"))
    log.append_batch(first, sink, 0)
    return events.from_messages(log.read_sink(spark, sink))


# ---------------------------------------------------------------------------- weather

# The reference bounds its rolling query after the sixth day of its data; ours starts
# 2024-01-01, so the same bound is the sixth day here.
ROLLING_SINCE = "2024-01-06"
EXTREME_HOT, EXTREME_COLD = 400.0, 1.0
MEASURES = o.DAILY_MEASURES


@register("flatten_daily", f"{o.WEATHER} SELECT latitude, longitude, day, {', '.join(MEASURES)} FROM daily_rows")
def q_flatten_daily(spark, sf):
    """P16 over strictly validated documents (one per place and month)."""
    return weather_plan.rows_from_documents(spark, sf, strict=True)


@register(
    "weather_json_roundtrip",
    f"{o.WEATHER} SELECT latitude, longitude, day, {', '.join(MEASURES)} FROM daily_rows",
)
def q_weather_json_roundtrip(spark, sf):
    """S7 on the whole data: documents landed as JSON files, scanned back against the
    explicit schema (FAILFAST), validated and flattened."""
    path = shared_dir(spark, "weather-json")
    raw_sources.write_weather_documents(bindings.weather_documents(spark, sf), path)
    return weather.flatten_daily(raw_sources.read_weather_documents(spark, path, multiline=False), strict=True)


@register(
    "document_checks",
    f"""{o.WEATHER}
SELECT COUNT(*) AS documents, CAST(0 AS BIGINT) AS bad_documents
FROM (SELECT DISTINCT user_id, date_trunc('month', day) FROM daily_rows)""",
)
def q_document_checks(spark, sf):
    """Documents and documents failing validation (missing, NULL or unequal arrays)."""
    docs = bindings.weather_documents(spark, sf)
    report = weather.document_problems(docs, keep_clean=True)
    return report.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("missing_array") | F.col("null_entry") | F.col("unequal_length")).alias("bad_documents"),
    )


@register(
    "document_checks_damaged",
    f"""{o.WEATHER}
SELECT COUNT(*) AS documents, COUNT(*) FILTER (WHERE month(m) % 2 = 0) AS bad_documents
FROM (SELECT DISTINCT user_id, date_trunc('month', day) AS m FROM daily_rows)""",
)
def q_document_checks_damaged(spark, sf):
    """D8 over a damaged copy: documents of even months lack their rain array."""
    docs = bindings.weather_documents(spark, sf)
    none = F.lit(None).cast(docs.schema["daily"].dataType["rain_sum"].dataType)
    even = F.month(F.get(F.col("daily.time"), F.lit(0))) % 2 == 0
    docs = docs.withColumn("daily", F.col("daily").withField("rain_sum", F.when(~even, F.col("daily.rain_sum")).otherwise(none)))
    bad = weather.document_problems(docs)
    return docs.agg(F.count(F.lit(1)).alias("documents")).crossJoin(bad.agg(F.count(F.lit(1)).alias("bad_documents")))


@register("locate_weather",f"{o.WEATHER} SELECT * FROM located")
def q_locate_weather(spark, sf):
    return weather_plan.load(spark, sf).located


@register(
    "unmatched_locations",
    f"""{o.WEATHER}
SELECT * FROM places p
WHERE NOT EXISTS (SELECT 1 FROM daily_rows d WHERE d.latitude = p.latitude AND d.longitude = p.longitude)""",
)
def q_unmatched_locations(spark, sf):
    return weather.unmatched_places(bindings.locations(spark, sf), weather_plan.daily_rows(spark, sf))


@register("distinct_locations", f"{o.WEATHER} SELECT DISTINCT name, latitude, longitude FROM located")
def q_distinct_locations(spark, sf):
    return weather.distinct_places(weather_plan.load(spark, sf).located)


@register(
    "hottest_per_day",
    f"""{o.WEATHER}
SELECT day, name, apparent_temperature_max FROM (
  SELECT *, RANK() OVER (PARTITION BY day ORDER BY apparent_temperature_max DESC NULLS LAST) AS rnk FROM joined)
WHERE rnk = 1""",
)
def q_hottest_per_day(spark, sf):
    return weather.hottest_per_day(weather_plan.joined(spark, sf))


def _rolling_sql(frame: str) -> str:
    return f"""{o.WEATHER}
SELECT name, day, rain_sum,
  CAST(SUM(CAST(rain_sum AS DECIMAL(18,2))) OVER (PARTITION BY location_id ORDER BY day {frame}) AS DECIMAL(28,2))
    AS past_seven_day_total
FROM joined WHERE day > DATE '{ROLLING_SINCE}'"""


@register("rolling_7_rows", _rolling_sql("ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"))
def q_rolling_7_rows(spark, sf):
    return weather.rolling_rain(weather_plan.joined(spark, sf), ROLLING_SINCE, ordered=True)


@register("rolling_7_days", _rolling_sql("RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW"))
def q_rolling_7_days(spark, sf):
    return weather.rolling_rain(weather_plan.joined(spark, sf), ROLLING_SINCE, calendar=True)


@register(
    "daylight",
    f"""{o.WEATHER}
SELECT name, day, CAST(epoch(sunset) - epoch(sunrise) AS BIGINT) AS total_daylight_seconds,
  CAST(sunshine_duration AS BIGINT) AS sunshine_seconds, CAST(daylight_duration AS BIGINT) AS daylight_seconds
FROM joined""",
)
def q_daylight(spark, sf):
    return weather.daylight(weather_plan.joined(spark, sf)).select(
        "name", "day", "total_daylight_seconds", "sunshine_seconds", "daylight_seconds"
    )


@register(
    "precip_totals",
    f"""{o.WEATHER}
SELECT location_id, name, SUM(precipitation_hours) AS total_precipitation_hours,
  CAST(SUM(CAST(rain_sum AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_rain_sum
FROM joined GROUP BY location_id, name""",
)
def q_precip_totals(spark, sf):
    return weather.precipitation_totals(weather_plan.joined(spark, sf), ordered=True)


@register(
    "mean_direction",
    f"""{o.WEATHER}
SELECT location_id, name, SUM(wind_direction_10m_dominant) / COUNT(wind_direction_10m_dominant) AS avg_wind_direction
FROM joined GROUP BY location_id, name""",
)
def q_mean_direction(spark, sf):
    return weather.mean_wind_direction(weather_plan.joined(spark, sf), ordered=True)


@register(
    "code_frequency",
    f"""{o.WEATHER}
SELECT location_id, name, weather_code, COUNT(*) AS weather_code_frequency
FROM joined GROUP BY location_id, name, weather_code""",
)
def q_code_frequency(spark, sf):
    return weather.code_frequency(weather_plan.joined(spark, sf), ordered=True)


@register(
    "max_temp_city",
    f"""{o.WEATHER}
SELECT location_id, name, temperature_2m_max AS max_temperature, day AS hottest_day FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY location_id ORDER BY temperature_2m_max DESC, day DESC) AS rn
  FROM joined) WHERE rn = 1""",
)
def q_max_temp_city(spark, sf):
    return weather.max_temperature(weather_plan.joined(spark, sf))


@register(
    "monthly_precip",
    f"""{o.WEATHER}
SELECT location_id, name, strftime(day, '%Y-%m') AS month,
  CAST(SUM(CAST(precipitation_sum AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_precipitation
FROM joined GROUP BY location_id, name, strftime(day, '%Y-%m')""",
)
def q_monthly_precip(spark, sf):
    return weather.monthly_precipitation(weather_plan.joined(spark, sf))


WIND_AVG = o.avg_dec("SUM(CAST(wind_speed_10m_max AS DECIMAL(18,2)))", "COUNT(wind_speed_10m_max)", 2, 6)


@register(
    "windiest_week",
    f"""{o.WEATHER}
SELECT week_start, avg_wind_speed, max_wind_speed FROM (
  SELECT *, RANK() OVER (ORDER BY avg_wind_speed DESC NULLS LAST) AS rnk FROM (
    SELECT CAST(date_trunc('week', day) AS DATE) AS week_start,
      CAST({WIND_AVG} AS DECIMAL(22,6)) AS avg_wind_speed, MAX(wind_speed_10m_max) AS max_wind_speed
    FROM joined GROUP BY CAST(date_trunc('week', day) AS DATE)))
WHERE rnk = 1""",
)
def q_windiest_week(spark, sf):
    return weather.windiest_week(weather_plan.joined(spark, sf))


@register(
    "mean_rain",
    f"""{o.WEATHER}
SELECT location_id, name,
  CAST({o.avg_dec("SUM(CAST(rain_sum AS DECIMAL(18,2)))", "COUNT(rain_sum)", 2, 6)} AS DECIMAL(22,6)) AS avg_rain_sum
FROM joined GROUP BY location_id, name""",
)
def q_mean_rain(spark, sf):
    return weather.mean_rain(weather_plan.joined(spark, sf))


@register(
    "extreme_days",
    f"""{o.WEATHER}
SELECT location_id, name,
  COUNT(*) FILTER (WHERE temperature_2m_max >= {EXTREME_HOT} OR temperature_2m_min <= {EXTREME_COLD}) AS extreme_days
FROM joined GROUP BY location_id, name""",
)
def q_extreme_days(spark, sf):
    return weather.extreme_days(weather_plan.joined(spark, sf), EXTREME_HOT, EXTREME_COLD)


@register(
    "hottest_month",
    f"""{o.WEATHER}
SELECT month, avg_temperature FROM (
  SELECT *, RANK() OVER (ORDER BY avg_temperature DESC NULLS LAST) AS rnk FROM (
    SELECT strftime(day, '%Y-%m') AS month,
      CAST({o.avg_dec("SUM(CAST(temperature_2m_mean AS DECIMAL(18,3)))", "COUNT(temperature_2m_mean)", 3, 7)}
        AS DECIMAL(22,7)) AS avg_temperature
    FROM joined GROUP BY strftime(day, '%Y-%m')))
WHERE rnk = 1""",
)
def q_hottest_month(spark, sf):
    return weather.hottest_month(weather_plan.joined(spark, sf))


# ---------------------------------------------------------------------------- upserts

_SLAT, _SLON = o.grid("s_suppkey")


@register(
    "upsert_dimension",
    f"""{o.WEATHER},
target AS (SELECT s_suppkey + 1 AS location_id, {_SLAT} AS latitude, {_SLON} AS longitude, s_name AS name FROM supplier),
updates AS (SELECT latitude, longitude, name FROM places),
kept AS (
  SELECT t.location_id, t.latitude, t.longitude, CASE WHEN u.latitude IS NOT NULL THEN u.name ELSE t.name END AS name
  FROM target t LEFT JOIN updates u ON u.latitude = t.latitude AND u.longitude = t.longitude
),
fresh AS (
  SELECT (SELECT MAX(location_id) FROM target) + ROW_NUMBER() OVER (ORDER BY latitude, longitude) AS location_id,
    latitude, longitude, name
  FROM updates u
  WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.latitude = u.latitude AND t.longitude = u.longitude)
)
SELECT * FROM kept UNION ALL SELECT * FROM fresh""",
)
def q_upsert_dimension(spark, sf):
    """Places from customers upserted into a Location table first loaded from suppliers."""
    supplier = bindings.read_table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    target = supplier.select(
        (key + 1).alias("location_id"), bindings.grid_latitude(key), bindings.grid_longitude(key),
        F.col("s_name").alias("name"),
    )
    updates = bindings.locations(spark, sf).select("latitude", "longitude", "name")
    return upsert.upsert_dimension(target, updates, ["latitude", "longitude"], "location_id")


# Two deliveries that together cover every event and overlap between 06:00 and 12:00.
FACT_OLD, FACT_NEW = "extract(hour FROM ts) < 12", "extract(hour FROM ts) >= 6"


@register(
    "upsert_fact",
    f"""WITH target AS {o.daily_sql("WHERE " + FACT_OLD)}, updates AS {o.daily_sql("WHERE " + FACT_NEW)}
SELECT user_id, day, {', '.join(MEASURES)} FROM target t
WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.user_id = t.user_id AND u.day = t.day)
UNION ALL SELECT user_id, day, {', '.join(MEASURES)} FROM updates""",
)
def q_upsert_fact(spark, sf):
    """A later delivery of daily rows (afternoons, part of the mornings) replaces matching (place, day) rows."""
    target = bindings.daily_measures(spark, sf, FACT_OLD)
    updates = bindings.daily_measures(spark, sf, FACT_NEW)
    return upsert.upsert_fact(target, updates, ["user_id", "day"])


_REPEATS_SQL = f"""base AS {o.daily_sql()},
target AS (SELECT user_id, day, temperature_2m_max AS value FROM base),
deliveries AS (SELECT user_id, day, 1 AS delivery, temperature_2m_min AS value FROM base
  UNION ALL SELECT user_id, day, 2, temperature_2m_mean FROM base WHERE temperature_2m_mean > 10)"""


@register(
    "upsert_fact_repeats",
    f"""WITH {_REPEATS_SQL}
SELECT user_id, day, value FROM deliveries QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY delivery DESC) = 1""",
)
def q_upsert_fact_repeats(spark, sf):
    """S13 with repeated keys: of two deliveries for one (place, day) the last wins."""
    base = bindings.daily_measures(spark, sf)
    target = base.select("user_id", "day", F.col("temperature_2m_max").alias("value"))
    first = base.select("user_id", "day", F.lit(1).alias("delivery"), F.col("temperature_2m_min").alias("value"))
    second = base.where("temperature_2m_mean > 10").select("user_id", "day", F.lit(2), F.col("temperature_2m_mean"))
    return upsert.upsert_fact(target, first.union(second), ["user_id", "day"], order=["delivery"])


@register("key_lookup", f"{o.WEATHER} SELECT * FROM weather WHERE location_id = 1")
def q_key_lookup(spark, sf):
    """Every day of one place (the Weather lookup returns all its rows)."""
    return upsert.lookup(weather_plan.load(spark, sf).weather, "location_id", 1)


def _two_batches(spark, sf):
    """Stored tables after two batches: mornings at two places in three, then afternoons at all of them.

    The second batch holds each document twice, the first copy without rain, and some places under two names.
    """
    namespace = _namespace(spark, "reload")
    places = bindings.locations(spark, sf)
    known = places.where(F.substring("name", -1, 1).isin(*"0123456"))
    station = places.where(F.substring("name", -1, 1).isin(*"05")).withColumn("name", F.concat("name", F.lit(" Station")))
    documents = lambda where: bindings.documents_from_daily(bindings.daily_measures(spark, sf, where))
    keys = ("latitude", "longitude", weather.month_of_document())
    weather_plan.reload(spark, namespace, documents(FACT_OLD).withColumn("delivery", F.lit(1)), known, ["delivery"], keys)
    good = documents(FACT_NEW)
    dry = good.withColumn("daily", F.col("daily").withField("rain_sum", F.transform("daily.rain_sum", lambda x: x * 0)))
    twice = good.withColumn("delivery", F.lit(2)).unionByName(dry.withColumn("delivery", F.lit(1)))
    weather_plan.reload(spark, namespace, twice, places.union(station), ["delivery"], keys)
    return spark.table(f"{namespace}.location"), spark.table(f"{namespace}.weather")


_BATCHES = f"""WITH a AS {o.daily_sql("WHERE " + FACT_OLD)}, b AS {o.daily_sql("WHERE " + FACT_NEW)},
places AS (SELECT c_name AS name, {o._CLAT} AS latitude, {o._CLON} AS longitude FROM customer),
first_rows AS (SELECT a.*, name FROM a JOIN places USING (latitude, longitude) WHERE right(name, 1) IN ('0', '1', '2', '3', '4', '5', '6')),
second_rows AS (SELECT b.*, CASE WHEN right(name, 1) IN ('0', '5') THEN name || ' Station' ELSE name END AS name FROM b JOIN places USING (latitude, longitude)),
first_ids AS (
  SELECT ROW_NUMBER() OVER (ORDER BY latitude, longitude) AS location_id, name, latitude, longitude
  FROM (SELECT DISTINCT name, latitude, longitude FROM first_rows)),
second_places AS (SELECT DISTINCT name, latitude, longitude FROM second_rows),
location AS (
  SELECT location_id, coalesce(s.name, f.name) AS name, latitude, longitude
  FROM first_ids f LEFT JOIN second_places s USING (latitude, longitude)
  UNION ALL
  SELECT (SELECT MAX(location_id) FROM first_ids) + ROW_NUMBER() OVER (ORDER BY latitude, longitude), name, latitude, longitude
  FROM second_places s WHERE NOT EXISTS (SELECT 1 FROM first_ids f WHERE f.latitude = s.latitude AND f.longitude = s.longitude)),
final_rows AS (
  SELECT * EXCLUDE (name) FROM second_rows
  UNION ALL
  SELECT * EXCLUDE (name) FROM first_rows f WHERE NOT EXISTS (
    SELECT 1 FROM second_rows s WHERE s.latitude = f.latitude AND s.longitude = f.longitude AND s.day = f.day)),
weather AS (SELECT location_id, day, {', '.join(MEASURES)} FROM final_rows JOIN location USING (latitude, longitude))"""


@register("weather_reload", f"{_BATCHES} SELECT location_id, name, latitude, longitude, day, {', '.join(MEASURES)} FROM weather JOIN location USING (location_id)")
def q_weather_reload(spark, sf):
    """Two batches loaded into the declared tables, read back and joined."""
    location, rows = _two_batches(spark, sf)
    return weather.with_names(rows, location).select("location_id", "name", "latitude", "longitude", "day", *MEASURES)


@register("stored_lookup", f"{_BATCHES} SELECT * FROM weather WHERE location_id = 1")
def q_stored_lookup(spark, sf):
    """S15 on the stored table: one bucket is read."""
    return upsert.lookup(_two_batches(spark, sf)[1], "location_id", 1)


@register(
    "repeated_documents",
    f"""{o.WEATHER}
SELECT latitude, longitude, day, CASE WHEN month(day) % 2 = 0 THEN temperature_2m_max + 100 ELSE temperature_2m_max END AS temperature_2m_max
FROM daily_rows""",
)
def q_repeated_documents(spark, sf):
    """Documents delivered again for even months, with other temperatures; the last delivery counts."""
    docs = bindings.weather_documents(spark, sf)
    warmer = F.col("daily").withField("temperature_2m_max", F.transform("daily.temperature_2m_max", lambda x: x + 100))
    again = docs.where(F.month(weather.month_of_document()) % 2 == 0).withColumn("daily", warmer).withColumn("delivery", F.lit(2))
    both = docs.withColumn("delivery", F.lit(1)).unionByName(again)
    latest = weather.latest_documents(both, ["delivery"], ("latitude", "longitude", weather.month_of_document()))
    return weather.flatten_daily(latest, strict=True).select("latitude", "longitude", "day", "temperature_2m_max")


_LOC_COLS = ["location_id", "name", "latitude", "longitude"]


CONSTRAINTS = [
    quality.Rule("location_not_null", "not_null", "location", tuple(_LOC_COLS)),
    quality.Rule("location_primary_key", "key", "location", ("location_id",)),
    quality.Rule("location_unique_coordinates", "key", "location", ("latitude", "longitude")),
    quality.Rule("location_name_length", "max_length", "location", ("name",), limit=32),
    quality.Rule("weather_not_null", "not_null", "weather", ("location_id", "day", *MEASURES)),
    quality.Rule("weather_primary_key", "key", "weather", ("location_id", "day")),
    quality.Rule("weather_foreign_key", "foreign", "weather", ("location_id",), parent="location"),
]


@register(
    "constraint_checks",
    f"""{o.WEATHER}
SELECT 'location_not_null' AS check_name, COUNT(*) AS violations FROM location
  WHERE {' OR '.join(c + ' IS NULL' for c in _LOC_COLS)}
UNION ALL SELECT 'location_primary_key', COUNT(*) FROM (SELECT location_id FROM location GROUP BY location_id HAVING COUNT(*) > 1)
UNION ALL SELECT 'location_unique_coordinates', COUNT(*) FROM (
  SELECT latitude, longitude FROM location GROUP BY latitude, longitude HAVING COUNT(*) > 1)
UNION ALL SELECT 'location_name_length', COUNT(*) FROM location WHERE length(name) > 32
UNION ALL SELECT 'weather_not_null', COUNT(*) FROM weather
  WHERE {' OR '.join(c + ' IS NULL' for c in ['location_id', 'day', *MEASURES])}
UNION ALL SELECT 'weather_primary_key', COUNT(*) FROM (
  SELECT location_id, day FROM weather GROUP BY location_id, day HAVING COUNT(*) > 1)
UNION ALL SELECT 'weather_foreign_key', COUNT(*) FROM weather w
  WHERE NOT EXISTS (SELECT 1 FROM location l WHERE l.location_id = w.location_id)""",
)
def q_constraint_checks(spark, sf):
    """The DDL constraints of both tables as counted violations (all zero when clean)."""
    t = weather_plan.load(spark, sf)
    return quality.constraint_counts({"location": t.location, "weather": t.weather}, CONSTRAINTS)


@register(
    "count_check",
    f"""{o.RETAIL}
SELECT 'sales_orders' AS table_name, (SELECT COUNT(*) FROM raw_orders) AS source_rows,
  (SELECT COUNT(*) FROM raw_orders) AS loaded_rows, (SELECT COUNT(*) = COUNT(order_id) FROM raw_orders) AS counts_match""",
)
def q_count_check(spark, sf):
    """D3: raw orders against the Bronze table (lineage-stamped) that they were landed in."""
    to_bronze = lambda rows: retail.to_bronze(rows, "sales_orders.csv")
    return quality.landed_count_check(bindings.raw_orders(spark, sf), to_bronze, shared_dir(spark, "bronze"), "sales_orders")


@register(
    "constraint_checks_damaged",
    f"""{o.WEATHER}
SELECT 'location_name_length' AS check_name, COUNT(*) AS violations FROM location
UNION ALL SELECT 'weather_not_null', COUNT(*) FROM weather WHERE day(day) = 3
UNION ALL SELECT 'weather_primary_key', COUNT(*) FROM weather WHERE day(day) = 1
UNION ALL SELECT 'weather_foreign_key', COUNT(*) FROM weather WHERE day(day) = 2""",
)
def q_constraint_checks_damaged(spark, sf):
    """D9 over damaged copies: names too long, rows of first days twice, unknown places on second, no rain on third days."""
    t = weather_plan.load(spark, sf)
    date, rain = F.dayofmonth("day"), F.col("rain_sum")
    rows = t.weather.withColumn("rain_sum", F.when(date != 3, rain)).withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(date == 1, 2).otherwise(1))))
    rows = rows.withColumn("location_id", F.when(date == 2, -F.col("location_id")).otherwise(F.col("location_id"))).drop("copy")
    tables_ = {"location": t.location.withColumn("name", F.rpad("name", 40, "x")), "weather": rows}
    damaged = {"location_name_length", "weather_not_null", "weather_primary_key", "weather_foreign_key"}
    return quality.constraint_counts(tables_, [r for r in CONSTRAINTS if r.name in damaged])


@register(
    "count_check_damaged",
    f"""{o.RETAIL}
SELECT 'sales_orders' AS table_name, a AS source_rows, b AS loaded_rows, a = b AS counts_match
FROM (SELECT COUNT(*) AS a, COUNT(*) FILTER (WHERE quantity <> '1') AS b FROM raw_orders)""",
)
def q_count_check_damaged(spark, sf):
    """D3 over a damaged load: the orders of one piece are lost on the way into the table."""
    lossy = lambda rows: retail.to_bronze(rows.where("quantity <> '1'"), "sales_orders.csv")
    return quality.landed_count_check(bindings.raw_orders(spark, sf), lossy, shared_dir(spark, "bronze"), "sales_orders")


@register(
    "control_totals_check",
    f"""{o.RETAIL} SELECT CAST(NULL AS VARCHAR) AS check_name, CAST(NULL AS BOOLEAN) AS passed WHERE false""",
)
def q_control_totals_check(spark, sf):
    """Silver = Gold, and events + rejected rows = Gold (half a cent per event); no row = pass."""
    totals, event_rows = _control_totals(spark, sf)
    return quality.control_total_mismatches(totals, event_rows)


@register(
    "control_totals_damaged",
    "SELECT * FROM (VALUES ('events_vs_gold_revenue', false)) AS t(check_name, passed)",
)
def q_control_totals_damaged(spark, sf):
    """D4 over a damaged copy: two cents lost per event must be reported at every size."""
    totals, event_rows = _control_totals(spark, sf)
    lost = F.when(F.col("layer") == "events", F.col("revenue") - F.lit(event_rows).cast("decimal(20,0)") * F.lit("0.02").cast("decimal(3,2)"))
    damaged = totals.withColumn("revenue", F.coalesce(lost, F.col("revenue")).cast(totals.schema["revenue"].dataType))
    return quality.control_total_mismatches(damaged, event_rows)


# ---------------------------------------------------------------------- stored layers


def _namespace(spark: SparkSession, name: str) -> str:
    """A fresh namespace in the shared folder."""
    namespace = f"{name}_{uuid.uuid4().hex[:8]}"
    tables.ensure_namespace(spark, namespace, shared_dir(spark, namespace))
    return namespace


def _stored_layers(spark, sf, buckets: int | None = None) -> tuple[str, pipeline.RunReport]:
    namespace, report = _namespace(spark, "layers"), pipeline.RunReport()
    pipeline.build_layers(spark, bindings.raw_retail(spark, sf), namespace, report, buckets)
    return namespace, report


_STORED = {
    **{f"bronze_{t}": f"raw_{v}" for t, v in (("customers", "customers"), ("products", "products"), ("sales_orders", "orders"))},
    **{f"silver_{t}": f"silver_{v}" for t, v in (("customers", "customers"), ("products", "products"), ("sales_orders", "orders"))},
    "silver_enriched_sales": "enriched",
    "gold_monthly_category_sales": f"({ORACLE['monthly_category_sales']})",
    "gold_city_sales": f"({ORACLE['city_sales']})",
    "gold_customer_value": f"({ORACLE['customer_value']})",
    "gold_top_products_by_category": f"({ORACLE['top_products']})",
}


@register(
    "stored_layers",
    o.RETAIL + " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS written_rows, COUNT(*) AS stored_rows FROM {v}" for t, v in _STORED.items()),
)
def q_stored_layers(spark, sf):
    """Every layer written in order, each from the tables before it; rows observed on the writes and rows read back."""
    namespace, report = _stored_layers(spark, sf)
    counted = [
        tables.read(spark, f"{namespace}.{t}").agg(F.lit(t).alias("table_name"), F.lit(report.rows[t]).cast("bigint").alias("written_rows"), F.count(F.lit(1)).alias("stored_rows"))
        for t in tables.list_tables(spark, namespace)
    ]
    return _union(counted)


@register("stored_gold", ORACLE["monthly_category_sales"])
def q_stored_gold(spark, sf):
    """The monthly mart as stored, after the zero-row check of the stored layers (bucketed by customer, by month)."""
    namespace, report = _stored_layers(spark, sf, buckets=8)
    pipeline.check_layers(spark, namespace, report)
    return tables.read(spark, f"{namespace}.gold_monthly_category_sales")


@register(
    "stored_switch",
    f"""{o.RETAIL}, sums AS (SELECT city, SUM(quantity) AS units FROM enriched GROUP BY city),
first_load AS (SELECT * FROM sums WHERE units % 2 = 0),
second_load AS (SELECT city, units + 1 AS units FROM first_load UNION ALL SELECT * FROM sums WHERE units % 2 = 1)
SELECT 'before' AS version, city, CAST(units AS BIGINT) AS units FROM first_load
UNION ALL SELECT 'after', city, CAST(units AS BIGINT) FROM second_load""",
)
def q_stored_switch(spark, sf):
    """A table whose next version reads it; a plan made before the switch goes on with the old rows."""
    name = f"{_namespace(spark, 'switch')}.city_units"
    sums = materialize(retail.silver(spark, sf).enriched.groupBy("city").agg(F.sum("quantity").cast("bigint").alias("units")), "sums")
    tables.save(sums.where(F.col("units") % 2 == 0), name)
    before = tables.read(spark, name)
    raised = before.withColumn("units", F.col("units") + 1)
    tables.replace_table(spark, raised.unionByName(sums.where(F.col("units") % 2 == 1)), name)
    versions = {"before": before, "after": tables.read(spark, name)}
    return _union([df.select(F.lit(v).alias("version"), "city", "units") for v, df in versions.items()])


@register(
    "stored_reset",
    f"""{o.RETAIL} SELECT 'silver_customers' AS table_name, region AS part, COUNT(*) AS loaded_rows FROM silver_customers GROUP BY region
UNION ALL SELECT 'silver_products', category, COUNT(*) FROM silver_products GROUP BY category""",
)
def q_stored_reset(spark, sf):
    """Tables of an earlier load with other columns are dropped, then loaded afresh and listed."""
    namespace, layer = _namespace(spark, "reset"), retail.silver(spark, sf)
    fresh = {"silver_customers": layer.customers, "silver_products": layer.products}
    tables.save_all({t: df.select(df.columns[0]) for t, df in fresh.items()}, namespace)
    tables.drop(spark, *(f"{namespace}.{t}" for t in tables.list_tables(spark, namespace)))
    tables.save_all(fresh, namespace)
    part = {"silver_customers": "region", "silver_products": "category"}
    return _union([
        tables.read(spark, f"{namespace}.{t}", [part[t]]).groupBy(F.lit(t).alias("table_name"), F.col(part[t]).alias("part")).agg(F.count(F.lit(1)).alias("loaded_rows"))
        for t in tables.list_tables(spark, namespace)
    ])


@register(
    "check_report",
    f"""SELECT 'monthly' AS check_name, COUNT(*) AS failing_rows FROM ({ORACLE['recon_monthly']})
UNION ALL SELECT 'monthly_damaged', COUNT(*) FROM ({ORACLE['recon_monthly_damaged']})""",
)
def q_check_report(spark, sf):
    """Rows that each zero-row check returns, over the mart as it is and a damaged copy."""
    return sqlrun.check_report({"monthly": q_recon_monthly(spark, sf), "monthly_damaged": q_recon_monthly_damaged(spark, sf)})
