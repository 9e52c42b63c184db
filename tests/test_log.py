"""The numbered log: order, bounded reads that resume, batches that replace themselves."""

from decimal import Decimal

import pytest

from spark_marts.session import shared_dir
from spark_marts.streaming import events, log

GOLD = "category string, order_month string, order_count bigint, total_quantity bigint, total_revenue decimal(38,8)"


def _events(spark, n, year=2024):
    rows = [(f"c{i % 5}", f"{year}-{i // 5 % 12 + 1:02d}", i, i, Decimal(i)) for i in range(n)]
    return events.build_events(spark.createDataFrame(rows, GOLD).repartition(4))


def _paths(spark):
    return [shared_dir(spark, n) for n in ("log", "sink", "progress")]


def test_numbers_go_on_in_publish_order(spark):
    topic, _, _ = _paths(spark)
    assert log.publish(_events(spark, 30), topic) == 30 and log.publish(_events(spark, 5, 2020), topic) == 5
    rows = [(r.seq, r.key) for r in log.read_log(spark, topic).orderBy("seq").collect()]
    assert [n for n, _ in rows] == list(range(1, 36))
    want = sorted(f"SALES-2024-{i // 5 + 1:02d}-c{i % 5}" for i in range(30)) + [f"SALES-2020-01-c{i}" for i in range(5)]
    assert [k for _, k in rows] == want


def test_twenty_of_thirty_then_the_rest(spark):
    topic, sink, progress = _paths(spark)
    log.publish(_events(spark, 30), topic)
    assert log.read_next(spark, topic, sink, progress, 20) == 20
    assert log.committed(spark, progress) == (1, 20)
    assert log.read_next(spark, topic, sink, progress, 20) == 10  # a new reader with the same progress
    assert log.read_next(spark, topic, sink, progress, 20) == 0
    got = [(r.batch, r.seq) for r in log.read_sink(spark, sink).orderBy("seq").collect()]
    assert got == [(0 if n <= 20 else 1, n) for n in range(1, 31)]
    log.publish(_events(spark, 3, 2025), topic)
    assert log.read_next(spark, topic, sink, progress, 20) == 3 and log.read_sink(spark, sink).count() == 33


def test_a_read_that_dies_before_its_commit_is_repeated(spark, monkeypatch):
    topic, sink, progress = _paths(spark)
    log.publish(_events(spark, 30), topic)
    plain = log.append_batch

    def dies(rows, at, batch):
        plain(rows, at, batch)
        raise RuntimeError("lost")

    monkeypatch.setattr(log, "append_batch", dies)
    with pytest.raises(RuntimeError):
        log.read_next(spark, topic, sink, progress, 20)
    monkeypatch.setattr(log, "append_batch", plain)
    assert log.committed(spark, progress) == (0, 0)
    assert log.read_next(spark, topic, sink, progress, 12) == 12
    assert sorted(r.seq for r in log.read_sink(spark, sink).collect()) == list(range(1, 13))


def test_empty_payloads_are_passed_over(spark):
    topic, sink, progress = _paths(spark)
    log.publish(_events(spark, 3), topic)
    spark.createDataFrame([(4, "x", ""), (5, "y", None)], log.LOG_SCHEMA).write.mode("append").parquet(topic)
    assert log.read_next(spark, topic, sink, progress, 10) == 5
    assert log.read_sink(spark, sink).count() == 3 and log.committed(spark, progress) == (1, 5)


def test_a_repeated_batch_replaces_itself(spark):
    topic, sink, ckpt = _paths(spark)
    events.publish(_events(spark, 6), topic)
    stream = spark.readStream.format("text").load(topic)
    log.consume_batches(stream, sink, ckpt)
    rows = spark.createDataFrame(log.read_sink(spark, sink).where("batch = 0").select("value").collect(), "value string")
    log.append_batch(rows, sink, 0)
    assert log.read_sink(spark, sink).count() == 6
    log.consume_batches(stream, sink, ckpt)  # nothing new
    assert log.read_sink(spark, sink).count() == 6
