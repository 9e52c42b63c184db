"""The stored weather load: batches, delivery order, in-plan validation, switching versions, one bucket a look-up."""

import datetime as dt
import json
import os
import time

import pytest

from spark_marts.operators import upsert, weather
from spark_marts.plans import weather as plan
from spark_marts.sources import raw, tables
from test_weather import _doc


def _places(spark, *rows):
    return spark.createDataFrame(list(rows), "name string, latitude double, longitude double")


def _land(spark, path, *files):
    """One JSON-lines file for each list of documents, in order of time."""
    os.makedirs(path, exist_ok=True)
    for i, docs in enumerate(files):
        at = os.path.join(path, f"{9 - i}.json")  # names against the order of time
        with open(at, "w") as fh:
            fh.write("\n".join(json.dumps(d) for d in docs))
        os.utime(at, (time.time() - 1000 + 10 * i,) * 2)
    return raw.read_weather_documents(spark, path, multiline=False, delivery=True)


def _namespace(spark, scratch, name):
    tables.ensure_namespace(spark, name, os.path.join(scratch, name))
    return name


def test_two_batches_keep_ids_and_replace_rows(spark, scratch):
    ns = _namespace(spark, scratch, "reload_two")
    first = _land(spark, f"{scratch}/one", [_doc(1.0, 2.0, 3), _doc(5.0, 5.0, 2)])
    assert plan.reload(spark, ns, first, _places(spark, ("A", 1.0, 2.0), ("E", 5.0, 5.0))) == {"location": 2, "weather": 5}
    second = _land(spark, f"{scratch}/two", [_doc(1.0, 2.0, 3, start=3), _doc(0.0, 9.0, 1)])
    places = _places(spark, ("A", 1.0, 2.0), ("A2", 1.0, 2.0), ("New", 0.0, 9.0))
    assert plan.reload(spark, ns, second, places) == {"location": 3, "weather": 8}
    got = sorted(tuple(r) for r in spark.table(f"{ns}.location").collect())
    assert got == [(1, "A2", 1.0, 2.0), (2, "E", 5.0, 5.0), (3, "New", 0.0, 9.0)]  # ids stay, the name follows, new ids after the greatest
    days = sorted((r.location_id, r.day.day, r.temperature_2m_max) for r in spark.table(f"{ns}.weather").collect())
    assert days == [(1, 1, 0.0), (1, 2, 1.0), (1, 3, 0.0), (1, 4, 1.0), (1, 5, 2.0), (2, 1, 0.0), (2, 2, 1.0), (3, 1, 0.0)]


def test_last_delivered_document_counts(spark, scratch):
    wet, dry = _doc(1.0, 1.0, 2), _doc(1.0, 1.0, 1)
    dry["daily"]["rain_sum"] = [0.0]
    docs = _land(spark, f"{scratch}/docs", [wet, wet], [_doc(2.0, 2.0, 1), dry])
    rows = weather.flatten_daily(weather.latest_documents(docs), strict=True)
    assert sorted((r.latitude, r.day, r.rain_sum) for r in rows.collect()) == [(1.0, dt.date(2026, 5, 1), 0.0), (2.0, dt.date(2026, 5, 1), 1.5)]
    in_one_file = _land(spark, f"{scratch}/lines", [dry, wet])  # the line decides
    assert weather.flatten_daily(weather.latest_documents(in_one_file)).count() == 2


def test_two_names_on_one_coordinate_give_one_row_a_day(spark, scratch):
    rows = weather.flatten_daily(_land(spark, f"{scratch}/docs", [_doc(1.0, 1.0, 2)]))
    two = spark.createDataFrame([("B", 1.0, 1.0, 1), ("A", 1.0, 1.0, 2)], "name string, latitude double, longitude double, nth int")
    assert weather.locate(rows, two).count() == 4
    assert [r.name for r in weather.locate(rows, weather.one_name(two, ["nth"])).collect()] == ["A", "A"]
    assert weather.one_name(two.drop("nth")).first().name == "B"


def test_locate_fails_when_nothing_matches(spark, scratch):
    rows = weather.flatten_daily(_land(spark, f"{scratch}/docs", [_doc(1.0, 1.0, 2)]))
    assert weather.locate(rows, _places(spark, ("A", 1.0, 1.0)), required=True).count() == 2
    far = _places(spark, ("Far", 9.0, 9.0))
    assert weather.locate(rows, far).count() == 0
    with pytest.raises(Exception, match="no weather row lies at a known place"):
        weather.locate(rows, far, required=True).collect()


def test_a_bad_document_fails_the_batch_in_one_execution(spark, scratch):
    ns = _namespace(spark, scratch, "reload_bad")
    place = _places(spark, ("A", 1.0, 1.0), ("B", 2.0, 2.0))
    plan.reload(spark, ns, _land(spark, f"{scratch}/good", [_doc(1.0, 1.0, 3)]), place)
    bad = _land(spark, f"{scratch}/bad", [_doc(1.0, 1.0, 4), _doc(2.0, 2.0, 4, break_array="rain_sum")])
    with pytest.raises(Exception, match="weather document failed validation: 2.0, 2.0"):
        plan.reload(spark, ns, bad, place)
    assert spark.table(f"{ns}.weather").count() == 3 and spark.table(f"{ns}.location").count() == 1
    strict = weather.flatten_daily(bad, strict=True)
    text = strict._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan json") == 1  # validated where it is flattened
    for broken in ("missing", "null entry"):
        doc = _doc(1.0, 1.0, 2)
        doc["daily"]["rain_sum"] = None if broken == "missing" else [1.0, None]
        with pytest.raises(Exception, match="failed validation"):
            weather.flatten_daily(_land(spark, f"{scratch}/{broken}", [doc]), strict=True).collect()


def test_look_up_reads_one_bucket(spark, scratch):
    ns = _namespace(spark, scratch, "reload_bucket")
    docs = [_doc(float(i), 1.0, 2) for i in range(20)]
    places = _places(spark, *[(f"P{i}", float(i), 1.0) for i in range(20)])
    plan.reload(spark, ns, _land(spark, f"{scratch}/docs", docs), places)
    assert upsert.lookup(spark.table(f"{ns}.weather"), "location_id", 7).count() == 2
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else files are pruned, but the plan does not say so
    try:
        found = upsert.lookup(spark.table(f"{ns}.weather"), "location_id", 7)
        assert "SelectedBucketsCount: 1 out of 8" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_readers_never_miss_the_table(spark, scratch, monkeypatch):
    ns = _namespace(spark, scratch, "swap_gapless")
    tables.save(spark.range(5), f"{ns}.t")
    before, seen = spark.table(f"{ns}.t"), []
    plain = tables.switch

    def watched(session, name, folder):
        seen.append(session.table(f"{ns}.t").count())  # the next version is written, not yet current
        plain(session, name, folder)
        seen.append(session.table(f"{ns}.t").count())

    monkeypatch.setattr(tables, "switch", watched)
    assert tables.replace_table(spark, before.union(spark.range(5, 7)), f"{ns}.t") == 7
    assert seen == [5, 7] and before.count() == 5 and tables.list_tables(spark, ns) == ["t"]
    assert tables.replace_table(spark, spark.table(f"{ns}.t").where("id > 2"), f"{ns}.t") == 4
    assert spark.table(f"{ns}.t").count() == 4
    with pytest.raises(ValueError, match="other columns"):
        tables.replace_table(spark, spark.range(2).selectExpr("id as x"), f"{ns}.t")


def test_only_the_namespace_is_listed(spark, scratch):
    ns = _namespace(spark, scratch, "listed")
    tables.save(spark.range(2), f"{ns}.t")
    spark.range(1).createOrReplaceTempView("a_view_of_the_session")
    try:
        assert tables.list_tables(spark, ns) == ["t"]
    finally:
        spark.catalog.dropTempView("a_view_of_the_session")


def test_tables_of_a_layer_are_written_side_by_side():
    import threading

    both = threading.Barrier(2, timeout=20)  # passes only when two writes are under way
    assert sorted(tables.at_once({"a": both.wait, "b": both.wait}).values()) == [0, 1]
    assert tables.at_once({}) == {}
    with pytest.raises(ZeroDivisionError):
        tables.at_once({"a": lambda: 1, "b": lambda: 1 // 0})


def test_order_headers_are_spelled_out_before_the_join(spark):
    from spark_marts.sources import bindings

    plan = bindings.raw_orders(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("date_format") > plan.index("Join Inner")


def test_buckets_grow_with_the_orders(spark, scratch, monkeypatch):
    from spark_marts.plans import pipeline
    from spark_marts.sources import bindings

    raw = bindings.raw_retail(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(pipeline, "BUCKET_ROWS", 500)
    ns, report = _namespace(spark, scratch, "more_buckets"), pipeline.RunReport()
    pipeline.build_layers(spark, raw, ns, report, buckets=2)
    want = -(-report.rows["bronze_sales_orders"] // 500)
    for name in ("silver_sales_orders", "silver_customers"):
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {ns}.{name}").where("col_name = 'Num Buckets'").first()["data_type"]
        assert int(told) == want > 2
    pipeline.check_layers(spark, ns, report)
    assert report.checks == {"monthly_matches_gold": 0}
