import duckdb
import pytest

import __spark_entry__ as entry
from spark_marts.plans import pipeline
from spark_marts.session import shared_dir
from spark_marts.sources import bindings, tables

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"category", "order_month", "total_revenue", "running_total_revenue"} <= set(df.columns)


def test_every_query_has_an_oracle_or_is_listed():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert {n for n in set(q) - set(o) if not n.startswith("op") and n != "pipeline"} == set()


def test_pipeline_end_to_end(spark):
    raw = bindings.raw_retail(spark, SF)
    topic, consumed, ckpt = (shared_dir(spark, n) for n in ("topic", "consumed", "ckpt"))
    report = pipeline.run_pipeline(spark, raw, "retail_test", topic, consumed, ckpt)
    assert report.rows["bronze_customers"] > report.rows["silver_customers"] > 0
    assert report.checks == {"monthly_matches_gold": 0}
    totals = report.totals
    assert totals["silver"]["rows"] == totals["gold"]["orders"] and totals["silver"]["revenue"] == totals["gold"]["revenue"] > 0
    broken = pipeline.RunReport(totals={"silver": totals["silver"], "gold": {**totals["gold"], "units": 1}})
    with pytest.raises(ValueError, match="differ in units"):
        pipeline.check_layers(spark, "retail_test", broken)
    assert report.published == report.rows["gold_monthly_category_sales"] - spark.table(
        "retail_test.gold_monthly_category_sales").filter("order_month IS NULL").count()
    assert spark.read.json(consumed).count() == report.published
    assert "silver_enriched_sales" in tables.list_tables(spark, "retail_test")


def test_bucketed_layers_match_and_skip_the_customer_shuffle(spark):
    from spark_marts.operators import sales
    raw = bindings.raw_retail(spark, SF)
    pipeline.build_layers(spark, raw, "bucketed_test", pipeline.RunReport(), buckets=4)
    t = lambda n: spark.table(f"bucketed_test.{n}")
    enriched = sales.enrich_sales(t("silver_sales_orders"), t("silver_customers"), t("silver_products"), customers_first=True)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for dimensions too big to broadcast
    try:
        plan = enriched._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin [customer_id" in plan and "Bucketed: true" in plan
    assert "Exchange hashpartitioning(customer_id" not in plan  # the co-located join shuffles nothing
    expect = retail_silver_enriched(spark).drop("source_file", "ingestion_timestamp")
    got = t("silver_enriched_sales").drop("source_file", "ingestion_timestamp").select(*expect.columns)
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0


def retail_silver_enriched(spark):
    from spark_marts.plans import retail
    return retail.silver(spark, SF).enriched


def test_replace_table_while_reading_it(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS swap_test")
    spark.range(5).write.mode("overwrite").saveAsTable("swap_test.t")
    cur = spark.table("swap_test.t")
    tables.replace_table(spark, cur.union(spark.range(5, 7)), "swap_test.t")
    assert spark.table("swap_test.t").count() == 7


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in bindings.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _canon(table):
    cols = sorted(table.column_names)
    return cols, sorted(tuple(repr(v) for v in r.values()) for r in table.select(cols).to_pylist())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF).toArrow()
    want = duck.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    assert _canon(got) == _canon(want)
