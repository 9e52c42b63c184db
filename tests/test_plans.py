"""Plan properties the design relies on: pruned scans and filters below the joins."""

import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_scans_are_pruned_and_filtered(spark):
    plan = _plan(entry.queries()["monthly_category_sales"](spark, SF))
    lineitem = re.search(r"FileScan parquet \[(l_[^\]]*)\]", plan)
    assert lineitem, plan
    cols = lineitem.group(1).split(",")
    assert len(cols) <= 6 < 11  # of lineitem's 11 columns only the used ones are read
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan
    # the cleaning rules run inside the scan stage, below the joins
    assert re.search(r"FileScan parquet \[l_[^\n]*DataFilters: \[[^\]]*l_quantity", plan)


def test_rank_input_is_computed_once(spark):
    plan = _plan(entry.queries()["customer_value"](spark, SF))
    assert "lineitem" not in plan  # the ranks read the materialised per-customer table
