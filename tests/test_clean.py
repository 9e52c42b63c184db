import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from spark_marts.functions import initcap_trim, try_cast
from spark_marts.operators import clean, sales

CUST = "customer_id string, customer_name string, city string, state string, region string, " \
       "customer_segment string, signup_date string, date_of_birth string, updated_at string, " \
       "loyalty_points string, is_active string"


def cust(cid, updated, active="Y", city="x", name="a"):
    return (cid, name, city, "s", "r", "seg", "2020-01-01", "1990-01-01", updated, "1", active)


def test_initcap_keeps_inner_spaces_and_breaks_on_spaces_only(spark):
    df = spark.createDataFrame([("  o'BRIEN-smith  new york ",), (None,), ("   ",)], "s string")
    out = [r[0] for r in df.select(initcap_trim("s")).collect()]
    assert out == ["O'brien-smith  New York", None, ""]


def test_try_cast_turns_junk_into_null_under_ansi(spark):
    df = spark.createDataFrame([("NA",), ("",), ("12.5",), ("7",)], "s string")
    got = df.select(try_cast("s", "int").alias("i"), try_cast("s", "date").alias("d"),
                    try_cast("s", "decimal(12,2)").alias("m")).collect()
    assert [r.i for r in got] == [None, None, None, 7]
    assert [r.d for r in got] == [None, None, None, None]
    assert [r.m for r in got] == [None, None, Decimal("12.50"), Decimal("7.00")]


def test_city_fill_applies_to_null_not_blank(spark):
    raw = spark.createDataFrame([cust("1", "2024-01-01 00:00:00", city=None),
                                 cust("2", "2024-01-01 00:00:00", city="  ")], CUST)
    got = {r.customer_id: r.city for r in clean.prepare_customers(raw).collect()}
    assert got == {"1": "Unknown", "2": ""}


def test_latest_version_decides_before_active_filter(spark):
    # G1: newest version inactive -> the customer disappears even though an older one is active
    raw = spark.createDataFrame([
        cust("1", "2024-02-01 00:00:00", active="N"),
        cust("1", "2024-01-01 00:00:00", active="Y"),
        cust("2", "2024-01-01 00:00:00", active="Y"),
    ], CUST)
    assert [r.customer_id for r in clean.clean_customers(raw).collect()] == ["2"]


def test_unparseable_timestamp_sorts_last_and_ties_are_deterministic(spark):
    raw = spark.createDataFrame([
        cust("1", "garbage", name="zzz"),
        cust("1", "2023-01-01 00:00:00", name="old"),
        cust("2", "2024-01-01 00:00:00", name="b"),
        cust("2", "2024-01-01 00:00:00", name="a"),
    ], CUST)
    latest = clean.latest_by_key(clean.prepare_customers(raw), ["customer_id"], ["updated_at"], "versions")
    got = {r.customer_id: (r.customer_name, r.versions) for r in latest.collect()}
    # NULL updated_at loses to any real one; on a tie the greater remaining columns win
    assert got == {"1": ("Old", 2), "2": ("B", 2)}


def test_latest_by_key_matches_row_number_window(spark):
    from pyspark.sql import Window
    rows = [(k % 7, (k * 13) % 5 if k % 3 else None, f"v{k % 4}") for k in range(200)]
    df = spark.createDataFrame(rows, "k int, ts int, v string")
    w = Window.partitionBy("k").orderBy(F.col("ts").desc_nulls_last(), F.col("v").desc_nulls_last())
    expect = sorted(df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn").collect())
    assert sorted(clean.latest_by_key(df, ["k"], ["ts"]).collect()) == expect


PROD = "product_id string, product_name string, category string, subcategory string, supplier_name string, " \
       "unit_price string, cost_price string, stock_quantity string, active_flag string"


def test_product_rules(spark):
    raw = spark.createDataFrame([
        ("ok", "n", "c", "s", "x", "10.00", "5.00", "3", "Y"),
        ("na", "n", "c", "s", "x", "NA", "5.00", "3", "Y"),
        ("neg", "n", "c", "s", "x", "-1", "5.00", "3", "Y"),
        ("cost_gt", "n", "c", "s", "x", "4.00", "5.00", "3", "Y"),
        ("equal", "n", "c", "s", "x", "5.00", "5.00", "junk", "Y"),
        ("inactive", "n", "c", "s", "x", "10.00", "5.00", "3", "N"),
        ("null_flag", "n", "c", "s", "x", "10.00", "5.00", "3", None),
    ], PROD)
    got = sorted(r.product_id for r in clean.clean_products(raw).collect())
    assert got == ["equal", "ok"]


ORD = "order_id string, customer_id string, product_id string, order_timestamp string, " \
      "promised_delivery_date string, actual_delivery_date string, quantity string, discount_pct string, " \
      "order_status string"


def test_order_rules_are_three_valued(spark):
    raw = spark.createDataFrame([
        ("1", "c", "p", "2024-01-01 10:00:00", "2024-01-05", "2024-01-04", "2", "5.00", "COMPLETED"),
        ("2", "c", "p", "2024-01-01 10:00:00", "2024-01-05", "2024-01-04", "0", "5.00", "COMPLETED"),
        ("3", "c", "p", "2024-01-01 10:00:00", "2024-01-05", "2024-01-04", "x", "5.00", "COMPLETED"),
        ("4", "c", "p", "2024-01-01 10:00:00", "2024-01-05", "2024-01-04", "2", "5.00", "PENDING"),
        ("5", "c", "p", "2024-01-01 10:00:00", "2024-01-05", "2024-01-04", "2", "5.00", None),
        ("6", "c", "p", "2024-01-01 10:00:00", "2024-01-05", "2024-01-04", "2", "5.00", "RETURNED"),
        ("7", "c", "p", "2024-01-01 10:00:00", "2024-01-05", "2024-01-04", "2", "5.00", "pending"),
    ], ORD)
    got = sorted(r.order_id for r in clean.clean_orders(raw).collect())
    assert got == ["1", "6", "7"]  # RETURNED stays; statuses are case-sensitive


def test_enrichment_measures(spark):
    orders = clean.prepare_orders(spark.createDataFrame([
        ("1", "c", "p", "2024-01-31 23:00:00", "2024-02-01", "2024-02-03", "3", "10.00", "COMPLETED"),
        ("2", "c", "p", "2024-01-31 23:00:00", "2024-02-01", "2024-01-30", "3", "n/a", "COMPLETED"),
        ("3", "c", "p", "2024-01-31 23:00:00", None, "2024-01-30", "3", "0.00", "COMPLETED"),
    ], ORD))
    products = clean.prepare_products(spark.createDataFrame(
        [("p", "n", "cat", "s", "x", "19.99", "10.00", "3", "Y")], PROD))
    customers = clean.prepare_customers(spark.createDataFrame([cust("c", "2024-01-01 00:00:00")], CUST))
    out = {r.order_id: r for r in sales.enrich_sales(orders, customers, products).collect()}
    assert out["1"].gross_amount == Decimal("59.97")
    assert out["1"].net_sales == Decimal("53.97300000")
    assert out["1"].profit_per_unit == Decimal("9.99")
    assert out["1"].delivery_days == 3 and out["1"].late_delivery_flag is True
    assert out["1"].order_month == "2024-01"
    assert out["2"].net_sales is None  # G6: NULL discount -> NULL net
    assert out["2"].delivery_days == -1  # signed
    assert out["3"].late_delivery_flag is None  # three-valued


def test_monthly_mart_running_total_and_null_discount(spark):
    df = spark.createDataFrame([
        ("A", "2024-01", 1, Decimal("10")), ("A", "2024-01", 2, None),
        ("A", "2024-02", 1, Decimal("5")), ("B", "2024-01", 1, Decimal("1")),
    ], "category string, order_month string, quantity int, net_sales decimal(34,8)")
    got = {(r.category, r.order_month): r for r in sales.monthly_category_sales(df).collect()}
    a1 = got[("A", "2024-01")]
    assert a1.order_count == 2 and a1.total_quantity == 3 and a1.total_revenue == Decimal("10")
    assert a1.avg_order_value == Decimal("10")  # NULL ignored by AVG, counted by COUNT(*)
    assert got[("A", "2024-02")].running_total_revenue == Decimal("15")
    assert got[("B", "2024-01")].running_total_revenue == Decimal("1")


def test_customer_value_latest_order_prefers_real_timestamps(spark):
    df = spark.createDataFrame([
        ("c1", "S", Decimal("5"), dt.datetime(2024, 1, 2), "o1"),
        ("c1", "S", Decimal("5"), None, "o9"),
        ("c1", "S", Decimal("5"), dt.datetime(2024, 1, 2), "o2"),
        ("c2", "S", Decimal("20"), dt.datetime(2024, 1, 1), "o3"),
        ("c3", "S", Decimal("15"), dt.datetime(2024, 1, 1), "o4"),
    ], "customer_id string, state string, net_sales decimal(34,8), order_timestamp timestamp_ntz, order_id string")
    got = {r.customer_id: (r.latest_order, r.state_rank) for r in sales.customer_value(df, buckets=2).collect()}
    assert got == {"c1": ("o2", 2), "c2": ("o3", 1), "c3": ("o4", 2)}  # 15 ties 15
