"""One key holding a third of all rows: results stay exact and the plans stay partial."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from spark_marts.operators import clean, quality, sales
from spark_marts.operators.rank import rank_window


def _skewed_sales(spark, n=3000):
    rows = []
    for i in range(n):
        cust = "hot" if i % 3 == 0 else f"c{i % 97}"
        state = "S1" if cust == "hot" or i % 2 else "S2"
        ts = None if i % 211 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=i % 500)
        rows.append((cust, state, Decimal(i % 40), ts, f"o{i:05d}"))
    return spark.createDataFrame(
        rows, "customer_id string, state string, net_sales decimal(34,8), order_timestamp timestamp_ntz, order_id string"
    )


def test_latest_by_key_on_a_hot_key_matches_the_window_and_aggregates_partially(spark):
    df = _skewed_sales(spark)
    w = Window.partitionBy("customer_id").orderBy(
        *[F.col(c).desc_nulls_last() for c in ["order_timestamp", "state", "net_sales", "order_id"]]
    )
    expect = sorted(df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn").collect())
    got = clean.latest_by_key(df, ["customer_id"], ["order_timestamp"])
    assert sorted(got.collect()) == expect
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan  # map-side combine before the shuffle


def test_customer_value_with_hot_customer(spark):
    df = _skewed_sales(spark)
    got = {r.customer_id: (r.lifetime_revenue, r.latest_order, r.state_rank) for r in sales.customer_value(df, buckets=4).collect()}
    per = df.groupBy("customer_id", "state").agg(F.sum("net_sales").alias("lifetime_revenue"))
    ranks = {r.customer_id: r.state_rank for r in rank_window(per, ["state"], "lifetime_revenue", "dense_rank", out="state_rank").collect()}
    assert {k: v[2] for k, v in got.items()} == ranks
    hot = df.filter("customer_id = 'hot'")
    assert got["hot"][0] == hot.agg(F.sum("net_sales")).first()[0]
    best = hot.filter(F.col("order_timestamp").isNotNull()).orderBy(F.desc("order_timestamp"), F.desc("order_id")).first()
    assert got["hot"][1] == best.order_id


def test_join_loss_and_enrichment_with_a_hot_product(spark):
    orders = spark.createDataFrame(
        [("hot" if i % 3 == 0 else f"p{i % 50}", f"c{i % 20}") for i in range(3000)], "product_id string, customer_id string")
    products = spark.createDataFrame([("hot",)] + [(f"p{i}",) for i in range(40)], "product_id string")
    customers = spark.createDataFrame([(f"c{i}",) for i in range(15)], "customer_id string")
    r = quality.join_loss(orders, products, customers).first()
    expect_out = orders.join(products, "product_id").join(customers, "customer_id").count()
    lost_p = orders.join(products, "product_id", "left_anti").count()
    assert (r.orders_in, r.lost_at_product, r.orders_out) == (3000, lost_p, expect_out)
    assert r.orders_in - r.lost_at_product - r.lost_at_customer == expect_out
