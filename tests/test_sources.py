import os

from spark_marts.sources import raw, tables


def test_csv_scan_keeps_strings_and_stamps_lineage(spark, scratch):
    path = os.path.join(scratch, "customers.csv")
    with open(path, "w") as fh:
        fh.write("customer_id,city,loyalty_points\n1,,10\n2,\"  \",x\n3,Davis,007\n")
    df = raw.read_raw_csv(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["string"] * 3
    got = {r.customer_id: (r.city, r.loyalty_points) for r in df.collect()}
    assert got == {"1": (None, "10"), "2": ("  ", "x"), "3": ("Davis", "007")}  # no inference: 007 stays text
    stamped = raw.stamp_lineage(df).collect()
    assert all(r.source_file.endswith("customers.csv") and r.ingestion_timestamp is not None for r in stamped)
    assert raw.stamp_lineage(df, "named.csv").first().source_file == "named.csv"


def test_save_replaces_schema_and_counts_rows(spark):
    tables.ensure_namespace(spark, "save_test")
    assert tables.save(spark.range(3), "save_test.t") == 3
    assert tables.save(spark.range(2).selectExpr("id", "'x' AS tag"), "save_test.t") == 2
    assert tables.read(spark, "save_test.t").columns == ["id", "tag"]
    assert tables.read(spark, "save_test.t", ["tag"]).columns == ["tag"]
    assert tables.sample(tables.read(spark, "save_test.t"), 1).count() == 1
    tables.drop(spark, "save_test.t")
    assert "t" not in tables.list_tables(spark, "save_test")


def test_cluster_conf_sizes_partitions_from_input():
    from spark_marts.session import cluster_conf
    conf = cluster_conf(100 * 1024**4, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600  # 100 TiB / 256 MiB
    assert cluster_conf(1024**3, total_cores=8000)["spark.sql.shuffle.partitions"] == "16000"
    assert conf["spark.sql.adaptive.enabled"] == "true"


def test_partitioned_and_bucketed_saves_write_few_files(spark):
    tables.ensure_namespace(spark, "files_test")
    rows = spark.range(0, 4000, 1, 16).selectExpr("id", "id % 10 AS month")
    tables.save(rows, "files_test.months", partition_by=["month"])
    tables.save(rows, "files_test.buckets", bucket_by=(4, ["id"]))
    files = {t: len(tables.read(spark, f"files_test.{t}").inputFiles()) for t in ("months", "buckets")}
    counts = [tables.read(spark, f"files_test.{t}").distinct().count() for t in ("months", "buckets")]
    tables.drop(spark, "files_test.months", "files_test.buckets")
    assert files == {"months": 10, "buckets": 4} and counts == [4000, 4000]
