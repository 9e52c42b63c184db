import random

import pytest
from pyspark.sql import functions as F

from spark_marts.operators.rank import number_rows, rank_window, rank_within, top_k


def _frame(spark, seed, n=600):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "c", None])
        val = None if rnd.random() < 0.05 else rnd.choice([1, 2, 2, 3, 5, 8, 13, 21, 34, 34, 55, rnd.randint(0, 500)])
        rows.append((i, key, val))
    return spark.createDataFrame(rows, "id int, k string, v int")


@pytest.mark.parametrize("method", ["rank", "dense_rank"])
@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_rank_within_equals_window(spark, method, descending, buckets):
    df = _frame(spark, seed=buckets * 4 + 2 * descending + (method == "rank"))
    expect = sorted(rank_window(df, ["k"], "v", method, descending, "r").collect())
    got = sorted(rank_within(df, ["k"], "v", method, descending, "r", buckets=buckets).select("id", "k", "v", "r").collect())
    assert got == expect


def test_top_k_keeps_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 2), ("a", 1), ("b", 1)], "k string, v int")
    got = sorted(top_k(df, ["k"], "v", 1).select("k", "v").collect())
    assert [tuple(r) for r in got] == [("a", 3), ("a", 3), ("b", 1)]


def test_top_k_plans_a_window_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = top_k(df, ["k"], "v", 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_number_rows_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("x"))
    out = number_rows(df, ["x"], start=100, out="n").collect()
    pairs = sorted((r.x, r.n) for r in out)
    assert [n for _, n in pairs] == list(range(101, 5101))


def test_cluster_shuffle_width_is_bounded():
    from spark_marts.session import cluster_conf
    width = lambda size, cores: int(cluster_conf(size, cores, max_partitions=65_536)["spark.sql.shuffle.partitions"])
    assert width(1 << 30, 8) == 16 and width(1 << 40, 8) == 4096
    assert width(100 << 40, 4000) == 65_536 and width(100 << 40, 40_000) == 80_000
