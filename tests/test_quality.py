import pytest
from pyspark.sql import functions as F

from spark_marts.operators import quality
from spark_marts.operators.quality import layer_counts, mismatches
from spark_marts.plans import retail, sqlrun


def test_funnel_charges_first_failed_rule(spark):
    df = spark.createDataFrame([(1, "Y"), (-1, "Y"), (-1, "N"), (None, "Y"), (2, "N"), (3, None)], "q int, f string")
    rules = [("bad_q", F.col("q") > 0), ("bad_f", F.col("f") == "Y")]
    got = [tuple(r) for r in quality.rejection_funnel(df, rules, "t").orderBy("step").collect()]
    assert got == [("t", 1, "bad_q", 6, 3, 3), ("t", 2, "bad_f", 3, 2, 1)]


def test_join_loss_counts_fan_out(spark):
    orders = spark.createDataFrame([("p1", "c1"), ("p1", "c2"), ("p2", "c1"), ("p3", "c1")], "product_id string, customer_id string")
    products = spark.createDataFrame([("p1",), ("p1",), ("p3",)], "product_id string")
    customers = spark.createDataFrame([("c1",)], "customer_id string")
    r = quality.join_loss(orders, products, customers).first()
    assert (r.orders_in, r.lost_at_product, r.lost_at_customer, r.orders_out) == (4, 1, 1, 3)


def test_constraint_report_catches_violations(spark):
    loc = spark.createDataFrame([(1, "a" * 40, 1.0, 1.0), (1, "b", 1.0, 1.0), (2, None, 2.0, 2.0)],
                                "location_id long, name string, latitude double, longitude double")
    wx = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-01"), (9, "2024-01-02")], "location_id long, day string")
    got = {r.check_name: r.violations for r in quality.constraint_report({
        "nn": quality.null_violations(loc, ["name"]),
        "pk": quality.key_violations(loc, ["location_id"]),
        "uq": quality.key_violations(loc, ["latitude", "longitude"]),
        "len": quality.length_violations(loc, "name", 32),
        "wpk": quality.key_violations(wx, ["location_id", "day"]),
        "fk": quality.foreign_key_violations(wx, loc, ["location_id"]),
    }).collect()}
    assert got == {"nn": 1, "pk": 1, "uq": 1, "len": 1, "wpk": 1, "fk": 1}


def test_profile_counts_nulls_bad_casts_and_ranges(spark):
    df = spark.createDataFrame([("1", "2020-01-01"), ("2", "NA"), (None, None), ("2", "2021-05-05")], "a string, d string")
    got = {r.column_name: r for r in quality.profile(df, {"d": "date"}).collect()}
    assert (got["a"].null_count, got["a"].distinct_count, got["a"].min_value, got["a"].max_value) == (1, 2, "1", "2")
    assert (got["d"].null_count, got["d"].bad_type_count) == (1, 1)


def test_business_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    r = quality.business_keys(df, ["k"], "t").first()
    assert (r.row_count, r.distinct_keys, r.duplicated_keys) == (3, 2, 1)


def test_zero_row_contract(spark):
    empty = spark.range(0)
    assert sqlrun.run_checks({"ok": empty}) == {"ok": 0}
    checks = {"ok": empty, "bad": spark.range(2)}
    with pytest.raises(sqlrun.CheckFailed, match="bad") as failed:
        sqlrun.run_checks(checks)
    assert {name: df.count() for name, df in failed.value.failing.items()} == {"bad": 2}
    assert sorted(map(tuple, sqlrun.check_report(checks).collect())) == [("bad", 2), ("ok", 0)]


def test_reconciliation_passes_then_catches_a_broken_gold(spark):
    views = retail.views(spark, "/root/testdata/sf0.001")
    enriched, gold = views["silver_enriched_sales"], views["gold_monthly_category_sales"]
    assert retail.monthly_mismatches(enriched, gold).count() == 0
    broken = gold.withColumn(
        "total_revenue", F.when(F.col("order_month") == "1996-01", F.col("total_revenue") + 1).otherwise(F.col("total_revenue"))
    ).withColumn("order_count", F.when(F.col("order_month") == "1997-01", F.lit(0)).otherwise(F.col("order_count")))
    broken = broken.filter(F.col("order_month") != "1998-01")
    reasons = {r.reason for r in retail.monthly_mismatches(enriched, broken).collect()}
    assert reasons == {"values_differ", "only_in_sql"}


def test_mismatches_pairs_null_keys_and_reports_repeats(spark):
    schema = "k string, n long, x decimal(10,2)"
    a = spark.createDataFrame([(None, 1, None), ("a", 1, None), ("b", 2, None), ("c", 3, None)], schema)
    b = spark.createDataFrame([(None, 1, None), ("a", 2, None), ("b", 2, None), ("b", 2, None), ("d", 3, None)], schema)
    got = {r.k: r.reason for r in mismatches(a, b, ["k"], ["n"], {"x": "0.01"}).collect()}
    assert got == {"a": "values_differ", "b": "repeated_key", "c": "only_in_left", "d": "only_in_right"}


def test_layer_counts_of_empty_and_absent_tables(spark):
    rows = layer_counts({"raw": {"t": spark.range(3)}, "clean": {"t": spark.range(0), "u": spark.range(2)}}).collect()
    assert {r.table_name: (r.raw_rows, r.clean_rows) for r in rows} == {"t": (3, 0), "u": (None, 2)}


def test_statement_splitter():
    text = "select ';' as a; -- c;\n select 1 /* ; */ ; \n select \"x;y\";"
    assert sqlrun.split_statements(text) == ["select ';' as a", "select 1", 'select "x;y"']


def test_script_namespace_prefix(spark, scratch):
    import os
    spark.sql("CREATE SCHEMA IF NOT EXISTS nsx")
    spark.range(3).write.mode("overwrite").saveAsTable("nsx.t1")
    p = os.path.join(scratch, "q.sql")
    with open(p, "w") as fh:
        fh.write("select count(*) as n from {ns}t1; select sum(id) as s from {ns}t1")
    assert sqlrun.run_script(spark, p, ns="nsx.").first().s == 3


def test_count_check(spark):
    r = quality.count_check(spark.range(5), spark.range(4), "t").first()
    assert (r.source_rows, r.loaded_rows, r.counts_match) == (5, 4, False)


def test_control_total_check_catches_a_lost_layer(spark):
    from decimal import Decimal
    rows = [("silver", 10, 20, Decimal("100.00")), ("gold", 10, 20, Decimal("100.00")),
            ("events", 8, 16, Decimal("80.00")), ("event_rejects", 2, 4, Decimal("20.00"))]
    schema = "layer string, orders bigint, units bigint, revenue decimal(38,2)"
    assert quality.control_total_mismatches(spark.createDataFrame(rows, schema), 1).count() == 0
    broken = rows[:3] + [("event_rejects", 1, 4, Decimal("20.00"))]
    bad = {r.check_name for r in quality.control_total_mismatches(spark.createDataFrame(broken, schema), 1).collect()}
    assert bad == {"events_vs_gold_orders"}


def test_constraint_counts_equal_the_separate_checks(spark):
    loc = spark.createDataFrame([(1, "a"), (1, "bb"), (2, None), (None, "toolong")], "id long, name string")
    fact = spark.createDataFrame([(1, 1, 5.0), (1, 1, 6.0), (3, 1, 7.0), (None, 2, None)], "id long, day int, v double")
    rules = [
        quality.Rule("loc_null", "not_null", "loc", ("id", "name")), quality.Rule("loc_key", "key", "loc", ("id",)),
        quality.Rule("loc_len", "max_length", "loc", ("name",), limit=3), quality.Rule("fact_null", "not_null", "fact", ("v",)),
        quality.Rule("fact_key", "key", "fact", ("id", "day")), quality.Rule("fact_parent", "foreign", "fact", ("id",), parent="loc"),
        quality.Rule("fact_clean", "not_null", "fact", ("day",)),
    ]
    counts = quality.constraint_counts({"loc": loc, "fact": fact}, rules)
    got = {r.check_name: r.violations for r in counts.collect()}
    assert got == {"loc_null": 2, "loc_key": 1, "loc_len": 1, "fact_null": 1, "fact_key": 1, "fact_parent": 2, "fact_clean": 0}
    assert quality.foreign_key_violations(fact, loc, ["id"]).count() == 2
    assert quality.constraint_counts({"loc": loc, "fact": fact}, rules)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 3


def test_landed_counts_see_rows_lost_in_the_write(spark, scratch):
    whole = quality.landed_count_check(spark.range(50), lambda df: df, f"{scratch}/a", "t").first()
    assert tuple(whole) == ("t", 50, 50, True)
    lossy = quality.landed_count_check(spark.range(50), lambda df: df.where("id > 9"), f"{scratch}/b", "t").first()
    assert tuple(lossy) == ("t", 50, 40, False)


def test_profile_counts_of_columns_and_whole_rows(spark):
    df = spark.createDataFrame([(1, "a", [1]), (1, "a", [1]), (2, None, None), (None, None, [2])], "id int, name string, tags array<int>")
    profile = quality.profile_counts(df)
    got = {r[0]: tuple(r)[1:] for r in profile.collect()}
    assert got == {"id": (4, 1, 2, 1, 1), "name": (4, 2, 1, 1, 1), "tags": (4, 1, 2, 1, 1), "*": (4, 0, 3, 1, 1)}
    assert "Expand" not in profile._jdf.queryExecution().executedPlan().toString()


def test_profile_takes_narrow_entries_and_keeps_types(spark):
    rows = [(1, "9", -0.0, bytearray(b"\xff"), [1]), (2, "10", 0.0, bytearray(b"\xfe"), None), (2, None, None, None, [1]), (None, "x", 3.5, bytearray(b"\xff"), [2, 3])]
    df = spark.createDataFrame(rows, "a int, b string, c double, d binary, e array<int>")
    exact = quality.profile(df, {"b": "int"})
    got = {r.column_name: tuple(r)[1:4] for r in exact.collect()}
    assert got == {"a": (1, 0, 2), "b": (1, 1, 3), "c": (1, 0, 2), "d": (1, 0, 2), "e": (1, 0, 2)}
    ranges = {r.column_name: (r.min_value, r.max_value) for r in exact.collect()}
    assert ranges["a"] == ("1", "2") and ranges["b"] == ("9", "10") and ranges["e"] == ("[1]", "[2, 3]")
    assert {r.column_name: tuple(r)[1:4] for r in quality.profile(df, {"b": "int"}, exact=False).collect()} == got
    plan = exact._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan  # wide rows repeated once a column, sorted in the task that reads them
    assert [tuple(r)[1:] for r in quality.profile(df.limit(0)).collect()] == [(0, 0, 0, None, None)] * 5
