"""DuckDB twins of the registered queries, used as the correctness oracle.

Each string is one ``WITH ... SELECT`` over the shared tables (pre-registered as views).
The binding and cleaning steps are spelled out once as CTE text and prefixed to every
query that needs them. DuckDB differs from Spark in a few places, handled here:
no ``initcap`` (a list expression instead), ``/`` on decimals gives DOUBLE (so ``/ 100``
becomes ``* 0.01`` as a decimal), ``ORDER BY`` defaults to NULLS LAST (Spark's ascending
default is NULLS FIRST, so it is written out), and integer sums are HUGEINT (cast back).
"""

from __future__ import annotations


def initcap(expr: str) -> str:
    """``initcap(trim(lower(x)))`` as Spark computes it: words split on single spaces."""
    return (
        f"list_aggregate(list_transform(string_split(trim(lower({expr})), ' '), "
        f"lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ')"
    )


def ts_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


CUSTOMER_COMMON = """
    CAST(c_custkey AS VARCHAR) AS customer_id,
    c_name AS customer_name,
    {city} AS city,
    n_name AS state,
    r_name AS region,
    c_mktsegment AS customer_segment,
    CASE WHEN c_custkey % 29 = 0 THEN 'NA'
         ELSE CAST(DATE '2015-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS VARCHAR) END AS signup_date,
    CAST(DATE '1950-01-01' + CAST((c_custkey * 7) % 18000 AS INTEGER) AS VARCHAR) AS date_of_birth,
    {updated_at} AS updated_at,
    {loyalty} AS loyalty_points,
    {active} AS is_active
"""

CURRENT_TS = "(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey % 86400))"

RAW_CUSTOMERS = f"""
raw_customers AS (
  SELECT {CUSTOMER_COMMON.format(
      city="CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE '  ' || lower(c_mktsegment) || ' ' END",
      updated_at=ts_text(CURRENT_TS),
      loyalty="CASE WHEN c_custkey % 31 = 0 THEN 'x' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END",
      active="CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END")}
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT {CUSTOMER_COMMON.format(
      city="'old town'",
      updated_at=f"CASE WHEN c_custkey % 30 = 0 THEN {ts_text(CURRENT_TS)} "
                 f"WHEN c_custkey % 20 = 0 THEN 'not a timestamp' "
                 f"ELSE {ts_text(CURRENT_TS + ' - INTERVAL 400 DAY')} END",
      loyalty="'0'",
      active="'Y'")}
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_custkey % 10 = 0
)"""

PRICE = "CAST(p_retailprice AS DECIMAL(12,2))"

RAW_PRODUCTS = f"""
raw_products AS (
  SELECT
    CAST(p_partkey AS VARCHAR) AS product_id,
    p_name AS product_name,
    p_type AS category,
    p_brand AS subcategory,
    lower(p_brand) || ' supply' AS supplier_name,
    CASE WHEN p_partkey % 50 = 0 THEN 'NA' WHEN p_partkey % 53 = 0 THEN '-1'
         ELSE CAST({PRICE} AS VARCHAR) END AS unit_price,
    CASE WHEN p_partkey % 47 = 0 THEN CAST(CAST({PRICE} + 1 AS DECIMAL(12,2)) AS VARCHAR)
         ELSE CAST(CAST({PRICE} - 300 AS DECIMAL(12,2)) AS VARCHAR) END AS cost_price,
    CASE WHEN p_partkey % 61 = 0 THEN 'lots' ELSE CAST(p_size AS VARCHAR) END AS stock_quantity,
    CASE WHEN p_size % 20 = 0 THEN 'N' ELSE 'Y' END AS active_flag
  FROM part
)"""

RAW_ORDERS = f"""
raw_orders AS (
  SELECT
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(l_partkey AS VARCHAR) AS product_id,
    CASE WHEN l_orderkey % 211 = 0 THEN 'unknown' ELSE {ts_text('o_orderdate')} END AS order_timestamp,
    CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) AS promised_delivery_date,
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS actual_delivery_date,
    CASE WHEN l_partkey % 41 = 0 THEN '0' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    CASE WHEN l_orderkey % 89 = 0 THEN 'n/a'
         ELSE CAST(CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2)) AS VARCHAR) END AS discount_pct,
    CASE WHEN o_orderstatus = 'P' THEN 'PENDING' WHEN o_orderstatus = 'F' THEN 'COMPLETED'
         WHEN l_orderkey % 3 = 0 THEN 'CANCELLED' WHEN l_orderkey % 3 = 1 THEN 'RETURNED'
         ELSE 'SHIPPED' END AS order_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

CUSTOMER_TIEBREAK = (
    "customer_name city state region customer_segment signup_date date_of_birth loyalty_points is_active"
).split()

SILVER = f"""
prep_customers AS (
  SELECT customer_id,
    {initcap('customer_name')} AS customer_name,
    {initcap("coalesce(city, 'Unknown')")} AS city,
    {initcap('state')} AS state,
    {initcap('region')} AS region,
    {initcap('customer_segment')} AS customer_segment,
    TRY_CAST(signup_date AS DATE) AS signup_date,
    TRY_CAST(date_of_birth AS DATE) AS date_of_birth,
    TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
    TRY_CAST(loyalty_points AS INTEGER) AS loyalty_points,
    is_active
  FROM raw_customers
),
latest_customers AS (
  SELECT * EXCLUDE (_rn, _versions) , _versions FROM (
    SELECT *,
      ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY updated_at DESC NULLS LAST,
        {', '.join(f'{c} DESC NULLS LAST' for c in CUSTOMER_TIEBREAK)}) AS _rn,
      COUNT(*) OVER (PARTITION BY customer_id) AS _versions
    FROM prep_customers)
  WHERE _rn = 1
),
silver_customers AS (
  SELECT * EXCLUDE (_versions) FROM latest_customers WHERE is_active = 'Y'
),
prep_products AS (
  SELECT product_id,
    {initcap('product_name')} AS product_name,
    {initcap('category')} AS category,
    {initcap('subcategory')} AS subcategory,
    {initcap('supplier_name')} AS supplier_name,
    TRY_CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
    TRY_CAST(cost_price AS DECIMAL(12,2)) AS cost_price,
    TRY_CAST(stock_quantity AS INTEGER) AS stock_quantity,
    active_flag
  FROM raw_products
),
silver_products AS (
  SELECT * FROM prep_products
  WHERE unit_price IS NOT NULL AND cost_price IS NOT NULL
    AND unit_price > 0 AND cost_price > 0 AND cost_price <= unit_price
    AND active_flag = 'Y'
),
prep_orders AS (
  SELECT order_id, customer_id, product_id,
    TRY_CAST(order_timestamp AS TIMESTAMP) AS order_timestamp,
    TRY_CAST(promised_delivery_date AS DATE) AS promised_delivery_date,
    TRY_CAST(actual_delivery_date AS DATE) AS actual_delivery_date,
    TRY_CAST(quantity AS INTEGER) AS quantity,
    TRY_CAST(discount_pct AS DECIMAL(5,2)) AS discount_pct,
    order_status
  FROM raw_orders
),
silver_orders AS (
  SELECT * FROM prep_orders WHERE quantity > 0 AND order_status NOT IN ('PENDING', 'CANCELLED')
),
enriched AS (
  SELECT o.*,
    p.product_name, p.category, p.subcategory, p.supplier_name, p.unit_price, p.cost_price,
    p.stock_quantity, p.active_flag,
    c.customer_name, c.city, c.state, c.region, c.customer_segment, c.signup_date,
    c.date_of_birth, c.updated_at, c.loyalty_points, c.is_active,
    CAST(o.quantity * p.unit_price AS DECIMAL(23,2)) AS gross_amount,
    CAST(o.quantity * p.unit_price * o.discount_pct * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(33,8)) AS discount_amount,
    CAST(o.quantity * p.unit_price - o.quantity * p.unit_price * o.discount_pct * CAST(0.01 AS DECIMAL(3,2))
         AS DECIMAL(34,8)) AS net_sales,
    CAST(p.unit_price - p.cost_price AS DECIMAL(13,2)) AS profit_per_unit,
    CAST(o.actual_delivery_date - CAST(o.order_timestamp AS DATE) AS INTEGER) AS delivery_days,
    o.actual_delivery_date > o.promised_delivery_date AS late_delivery_flag,
    strftime(o.order_timestamp, '%Y-%m') AS order_month
  FROM silver_orders o
  JOIN silver_products p ON p.product_id = o.product_id
  JOIN silver_customers c ON c.customer_id = o.customer_id
)"""

RETAIL = "WITH " + ",".join([RAW_CUSTOMERS, RAW_PRODUCTS, RAW_ORDERS, SILVER])


def avg_dec(sum_expr: str, count_expr: str, scale_in: int, scale_out: int) -> str:
    """Exact decimal average rounded half away from zero at ``scale_out`` digits.

    ``sum_expr`` has scale ``scale_in``. The quotient is formed on HUGEINT units and
    turned back into a decimal through its digits, so no double rounding enters.
    """
    if scale_out < scale_in:
        raise ValueError("scale_out must be >= scale_in")
    units = f"(CAST(({sum_expr}) * {10 ** scale_in} AS HUGEINT) * {10 ** (scale_out - scale_in)})"
    cnt = f"CAST({count_expr} AS HUGEINT)"
    mag = f"((abs({units}) * 2 + {cnt}) // (2 * {cnt}))"
    sign = f"(CASE WHEN {units} < 0 THEN '-' ELSE '' END)"
    digits = (
        f"{sign} || CAST({mag} // {10 ** scale_out} AS VARCHAR) || '.' || "
        f"lpad(CAST({mag} % {10 ** scale_out} AS VARCHAR), {scale_out}, '0')"
    )
    return f"CAST({digits} AS DECIMAL(38,{scale_out}))"


def grid(key: str) -> tuple[str, str]:
    return (
        f"(-60.0 + CAST({key} % 480 AS DOUBLE) * 0.25)",
        f"(-180.0 + CAST(floor({key} / 480) AS DOUBLE) * 0.25)",
    )


def daily_sql(where: str = "") -> str:
    def dsum(cond: str | None = None) -> str:
        term = "CAST(value AS DECIMAL(12,2))"
        if cond:
            term = f"CASE WHEN {cond} THEN {term} ELSE CAST(0 AS DECIMAL(12,2)) END"
        return f"CAST(SUM({term}) AS DOUBLE)"

    lat, lon = grid("user_id")
    return f"""(
  SELECT user_id, day,
    CASE first_type WHEN 'click' THEN 1 WHEN 'error' THEN 3 WHEN 'purchase' THEN 61
      WHEN 'signup' THEN 71 WHEN 'view' THEN 0 END AS weather_code,
    (tmax + tmin) / 2 AS temperature_2m_mean, tmax AS temperature_2m_max, tmin AS temperature_2m_min,
    (tmax + tmin) / 2 - 1.5 AS apparent_temperature_mean, tmax - 1.5 AS apparent_temperature_max,
    tmin - 1.5 AS apparent_temperature_min,
    precipitation_sum, rain_sum, snowfall_sum, precipitation_hours, wind_speed_10m_max,
    wind_direction_10m_dominant, shortwave_radiation_sum, et0_fao_evapotranspiration,
    wind_speed_10m_max + 2.0 AS wind_gusts_10m_max, sunshine_duration,
    CAST(epoch(sunset) - epoch(sunrise) AS DOUBLE) AS daylight_duration, sunset, sunrise,
    {lat} AS latitude, {lon} AS longitude
  FROM (
    SELECT user_id, CAST(ts AS DATE) AS day, min(event_type) AS first_type,
      max(value) AS tmax, min(value) AS tmin,
      {dsum("event_type IN ('purchase', 'click')")} AS precipitation_sum,
      {dsum("event_type = 'click'")} AS rain_sum,
      {dsum("event_type = 'signup'")} AS snowfall_sum,
      CAST(max(hour(ts)) - min(hour(ts)) + 1 AS DOUBLE) AS precipitation_hours,
      coalesce(max(CASE WHEN event_type = 'view' THEN value END), 0.0) AS wind_speed_10m_max,
      CAST(hour(min(ts)) * 15 AS DOUBLE) AS wind_direction_10m_dominant,
      {dsum()} AS shortwave_radiation_sum,
      CAST(COUNT(*) AS DOUBLE) / 10 AS et0_fao_evapotranspiration,
      CAST(COUNT(*) * 600 AS DOUBLE) AS sunshine_duration,
      date_trunc('minute', max(ts)) AS sunset, date_trunc('minute', min(ts)) AS sunrise
    FROM events {where}
    GROUP BY user_id, CAST(ts AS DATE)))"""


DAILY_MEASURES = (
    "weather_code temperature_2m_mean temperature_2m_max temperature_2m_min "
    "apparent_temperature_mean apparent_temperature_max apparent_temperature_min "
    "precipitation_sum rain_sum snowfall_sum precipitation_hours wind_speed_10m_max "
    "wind_direction_10m_dominant shortwave_radiation_sum et0_fao_evapotranspiration "
    "wind_gusts_10m_max sunshine_duration daylight_duration sunset sunrise"
).split()

_CLAT, _CLON = grid("c_custkey")

WEATHER = f"""WITH
daily_rows AS {daily_sql()},
places AS (SELECT c_name AS name, {_CLAT} AS latitude, {_CLON} AS longitude FROM customer),
located AS (
  SELECT p.name, d.latitude, d.longitude, d.day, {', '.join('d.' + c for c in DAILY_MEASURES)}
  FROM daily_rows d JOIN places p ON p.latitude = d.latitude AND p.longitude = d.longitude
),
location AS (
  SELECT ROW_NUMBER() OVER (ORDER BY latitude, longitude) AS location_id, name, latitude, longitude
  FROM (SELECT DISTINCT name, latitude, longitude FROM located)
),
weather AS (
  SELECT l.location_id, d.day, {', '.join('d.' + c for c in DAILY_MEASURES)}
  FROM located d JOIN location l ON l.latitude = d.latitude AND l.longitude = d.longitude
),
joined AS (
  SELECT w.*, l.name, l.latitude, l.longitude FROM weather w JOIN location l ON l.location_id = w.location_id
)"""
