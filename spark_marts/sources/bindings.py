"""Raw retail and weather inputs derived from the shared star-schema tables.

The retail pipeline expects three raw string tables (customers, products, sales orders)
and the weather pipeline expects nested daily documents plus a list of named places.
These functions derive them, in Spark, from the given tables so that every query's work
grows with the data. Dirt the raw files carry by design (missing cities, junk numbers,
invalid prices, older record versions, inactive rows, zero quantities, pending and
cancelled orders, NULL discounts, unparseable timestamps) is injected by deterministic
rules on the keys. No rule removes input rows; each only alters values or adds versions.

Every raw retail column is a string, as a CSV read without schema inference gives.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The weather codes standing in for the day's first event type.
EVENT_TYPE_CODES = {"click": 1, "error": 3, "purchase": 61, "signup": 71, "view": 0}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a shared (read-only) table; files are listed anew each time."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(col: Column) -> Column:
    return col.cast("string")


def _ts_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


# --------------------------------------------------------------------------- retail


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer versions: one current row per customer plus an older one for every
    tenth customer. Some older versions carry an unparseable ``updated_at``, some tie
    with the current version, all are active, so dedupe-before-filter matters."""
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    base = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    key = F.col("c_custkey")
    current_ts = F.timestamp_add("SECOND", key % 86400, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    common = {
        "customer_id": _s(key),
        "customer_name": F.col("c_name"),
        "state": F.col("n_name"),
        "region": F.col("r_name"),
        "customer_segment": F.col("c_mktsegment"),
        "signup_date": F.when(key % 29 == 0, F.lit("NA")).otherwise(
            _s(F.date_add(F.lit("2015-01-01").cast("date"), (key % 2000).cast("int")))
        ),
        "date_of_birth": _s(F.date_add(F.lit("1950-01-01").cast("date"), ((key * 7) % 18000).cast("int"))),
    }
    current = base.select(
        common["customer_id"].alias("customer_id"),
        common["customer_name"].alias("customer_name"),
        F.when(key % 37 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")))
        .alias("city"),
        common["state"].alias("state"),
        common["region"].alias("region"),
        common["customer_segment"].alias("customer_segment"),
        common["signup_date"].alias("signup_date"),
        common["date_of_birth"].alias("date_of_birth"),
        _ts_text(current_ts).alias("updated_at"),
        F.when(key % 31 == 0, F.lit("x"))
        .otherwise(_s(F.floor("c_acctbal").cast("bigint")))
        .alias("loyalty_points"),
        F.when(F.col("c_acctbal") < 0, F.lit("N")).otherwise(F.lit("Y")).alias("is_active"),
    )
    older = base.filter(key % 10 == 0).select(
        common["customer_id"].alias("customer_id"),
        common["customer_name"].alias("customer_name"),
        F.lit("old town").alias("city"),
        common["state"].alias("state"),
        common["region"].alias("region"),
        common["customer_segment"].alias("customer_segment"),
        common["signup_date"].alias("signup_date"),
        common["date_of_birth"].alias("date_of_birth"),
        F.when(key % 30 == 0, _ts_text(current_ts))
        .when(key % 20 == 0, F.lit("not a timestamp"))
        .otherwise(_ts_text(F.timestamp_add("DAY", F.lit(-400), current_ts)))
        .alias("updated_at"),
        F.lit("0").alias("loyalty_points"),
        F.lit("Y").alias("is_active"),
    )
    return current.unionByName(older)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    return part.select(
        _s(key).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.concat(F.lower("p_brand"), F.lit(" supply")).alias("supplier_name"),
        F.when(key % 50 == 0, F.lit("NA"))
        .when(key % 53 == 0, F.lit("-1"))
        .otherwise(_s(price))
        .alias("unit_price"),
        F.when(key % 47 == 0, _s((price + 1).cast("decimal(12,2)")))
        .otherwise(_s((price - 300).cast("decimal(12,2)")))
        .alias("cost_price"),
        F.when(key % 61 == 0, F.lit("lots")).otherwise(_s(F.col("p_size"))).alias("stock_quantity"),
        F.when(F.col("p_size") % 20 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("active_flag"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw order line per lineitem, joined to its order header on the order key.

    What a header says is spelled out before the join, once an order and not once a line.
    """
    key = F.col("o_orderkey")
    headers = read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _s(F.col("o_custkey")).alias("customer_id"),
        F.when(key % 211 == 0, F.lit("unknown")).otherwise(_ts_text(F.col("o_orderdate"))).alias("order_timestamp"),
        _s(F.date_add(F.col("o_orderdate").cast("date"), 30)).alias("promised_delivery_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit("PENDING"))
        .when(F.col("o_orderstatus") == "F", F.lit("COMPLETED"))
        .when(key % 3 == 0, F.lit("CANCELLED"))
        .when(key % 3 == 1, F.lit("RETURNED"))
        .otherwise(F.lit("SHIPPED"))
        .alias("order_status"),
    )
    okey = F.col("l_orderkey")
    return read_table(spark, sf_dir, "lineitem").join(headers, okey == key).select(
        F.concat(_s(okey), F.lit("-"), _s(F.col("l_linenumber"))).alias("order_id"),
        "customer_id",
        _s(F.col("l_partkey")).alias("product_id"),
        "order_timestamp",
        "promised_delivery_date",
        _s(F.col("l_shipdate").cast("date")).alias("actual_delivery_date"),
        F.when(F.col("l_partkey") % 41 == 0, F.lit("0"))
        .otherwise(_s(F.col("l_quantity").cast("int")))
        .alias("quantity"),
        F.when(okey % 89 == 0, F.lit("n/a"))
        .otherwise(_s((F.col("l_discount").cast("decimal(4,2)") * 100).cast("decimal(5,2)")))
        .alias("discount_pct"),
        "order_status",
    )


def raw_retail(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": raw_customers(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "sales_orders": raw_orders(spark, sf_dir),
    }


# --------------------------------------------------------------------------- weather


def grid_latitude(key: Column) -> Column:
    """Grid-node coordinates for a numeric place key: exact binary fractions, so the
    exact-equality join on (latitude, longitude) is well defined."""
    return (F.lit(-60.0) + (key % 480).cast("double") * 0.25).alias("latitude")


def grid_longitude(key: Column) -> Column:
    return (F.lit(-180.0) + F.floor(key / 480).cast("double") * 0.25).alias("longitude")


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named places: one per customer, placed on a 0.25 degree grid."""
    customer = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return customer.select(F.col("c_name").alias("name"), grid_latitude(key), grid_longitude(key))


def daily_measures(spark: SparkSession, sf_dir: str, where: str | None = None) -> DataFrame:
    """One row per (place, day) from the event stream: the daily weather series.

    Sums are taken over exact decimals and only then turned into doubles, so results
    do not depend on summation order. ``where`` restricts the feed to one delivery.
    """
    events = read_table(spark, sf_dir, "events")
    if where:
        events = events.filter(where)
    value = F.col("value")
    dec = value.cast("decimal(12,2)")

    def dsum(cond: Column | None = None) -> Column:
        term = dec if cond is None else F.when(cond, dec).otherwise(F.lit(0).cast("decimal(12,2)"))
        return F.sum(term).cast("double")

    etype = F.col("event_type")
    code = F.create_map(*[x for k, v in EVENT_TYPE_CODES.items() for x in (F.lit(k), F.lit(v))])
    daily = events.groupBy(F.col("user_id"), F.to_date("ts").alias("day")).agg(
        F.min(etype).alias("_first_type"),
        F.max(value).alias("temperature_2m_max"),
        F.min(value).alias("temperature_2m_min"),
        dsum(etype.isin("purchase", "click")).alias("precipitation_sum"),
        dsum(etype == "click").alias("rain_sum"),
        dsum(etype == "signup").alias("snowfall_sum"),
        (F.max(F.hour("ts")) - F.min(F.hour("ts")) + 1).cast("double").alias("precipitation_hours"),
        F.coalesce(F.max(F.when(etype == "view", value)), F.lit(0.0)).alias("wind_speed_10m_max"),
        (F.hour(F.min("ts")) * 15).cast("double").alias("wind_direction_10m_dominant"),
        dsum().alias("shortwave_radiation_sum"),
        (F.count(F.lit(1)).cast("double") / 10).alias("et0_fao_evapotranspiration"),
        (F.count(F.lit(1)) * 600).cast("double").alias("sunshine_duration"),
        _to_minute(F.max("ts")).alias("sunset"),
        _to_minute(F.min("ts")).alias("sunrise"),
    )
    tmax, tmin = F.col("temperature_2m_max"), F.col("temperature_2m_min")
    return daily.select(
        "user_id",
        "day",
        code[F.col("_first_type")].cast("int").alias("weather_code"),
        ((tmax + tmin) / 2).alias("temperature_2m_mean"),
        tmax.alias("temperature_2m_max"),
        tmin.alias("temperature_2m_min"),
        ((tmax + tmin) / 2 - 1.5).alias("apparent_temperature_mean"),
        (tmax - 1.5).alias("apparent_temperature_max"),
        (tmin - 1.5).alias("apparent_temperature_min"),
        "precipitation_sum",
        "rain_sum",
        "snowfall_sum",
        "precipitation_hours",
        "wind_speed_10m_max",
        "wind_direction_10m_dominant",
        "shortwave_radiation_sum",
        "et0_fao_evapotranspiration",
        (F.col("wind_speed_10m_max") + 2.0).alias("wind_gusts_10m_max"),
        "sunshine_duration",
        F.timestamp_diff("SECOND", F.col("sunrise"), F.col("sunset")).cast("double").alias("daylight_duration"),
        "sunset",
        "sunrise",
    )


def _to_minute(ts: Column) -> Column:
    """Wall-clock instant truncated to the minute, without passing through a time zone."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.lit(0))


# Measures of a daily document, in document order.
DAILY_FIELDS = (
    "weather_code temperature_2m_mean temperature_2m_max temperature_2m_min "
    "apparent_temperature_mean apparent_temperature_max apparent_temperature_min "
    "precipitation_sum rain_sum snowfall_sum precipitation_hours wind_speed_10m_max "
    "wind_direction_10m_dominant shortwave_radiation_sum et0_fao_evapotranspiration "
    "wind_gusts_10m_max sunshine_duration daylight_duration sunset sunrise"
).split()


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents like a weather API response: one per (place, month), with
    ``daily`` a struct of equally long arrays (``time`` plus 20 measures).

    A document covers one calendar month, so an array never holds more than 31
    entries however many days a place accumulates.
    """
    return documents_from_daily(daily_measures(spark, sf_dir))


def _field(name: str):
    return lambda x: x[name]


def documents_from_daily(daily: DataFrame) -> DataFrame:
    key = F.col("user_id")
    entries = F.array_sort(F.collect_list(F.struct("day", *DAILY_FIELDS)))
    docs = daily.groupBy(key, F.date_trunc("month", F.col("day")).alias("_month")).agg(entries.alias("_e"))
    arrays = [F.transform("_e", _field("day")).alias("time")] + [
        F.transform("_e", _field(f)).alias(f) for f in DAILY_FIELDS
    ]
    return docs.select(
        grid_latitude(key),
        grid_longitude(key),
        F.lit("GMT").alias("timezone"),
        F.lit(0).alias("utc_offset_seconds"),
        F.struct(*arrays).alias("daily"),
    )
