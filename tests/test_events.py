from decimal import Decimal

from pyspark.sql import functions as F

from spark_marts.session import shared_dir
from spark_marts.streaming import events

GOLD = "category string, order_month string, order_count bigint, total_quantity bigint, total_revenue decimal(38,8)"


def _gold(spark):
    return spark.createDataFrame([
        ("Toys", "2024-01", 2, 5, Decimal("10.00500000")),
        ("Toys", "2024-02", 1, 1, Decimal("10.01500000")),
        ("Toys", None, 1, 1, Decimal("1")),
    ], GOLD)


def test_build_events_rejects_null_month_and_rounds_half_even(spark):
    ev = {r.event_id: r for r in events.build_events(_gold(spark)).collect()}
    assert set(ev) == {"SALES-2024-01-Toys", "SALES-2024-02-Toys"}
    assert ev["SALES-2024-01-Toys"].total_revenue == Decimal("10.00")
    assert ev["SALES-2024-02-Toys"].total_revenue == Decimal("10.02")
    assert events.event_rejects(_gold(spark)).count() == 1


def test_json_messages_roundtrip(spark):
    msgs = events.to_messages(events.build_events(_gold(spark)))
    first = msgs.orderBy("key").first()
    assert first.key == "SALES-2024-01-Toys"
    assert '"total_revenue":10.00' in first.value and '"event_type":"MONTHLY_CATEGORY_SALES_READY"' in first.value
    back = events.from_messages(msgs.select(F.col("value").cast("binary").alias("value")))
    assert sorted(back.collect()) == sorted(events.build_events(_gold(spark)).collect())


def test_publish_replay_dedupe_and_restart(spark):
    topic, sink, ckpt = (shared_dir(spark, n) for n in ("topic", "sink", "ckpt"))
    ev = events.build_events(_gold(spark))
    assert events.publish(ev, topic) == 2
    assert events.publish(ev, topic) == 2  # replay
    assert events.read_log(spark, topic).count() == 4  # at-least-once log
    events.consume(events.dedupe_events(events.stream_events(spark, topic)), sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
    # restart: only the new file is read, and its replayed ids are dropped by the state
    more = spark.createDataFrame([("Toys", "2024-03", 1, 1, Decimal("3"))], GOLD)
    events.publish(events.build_events(more).unionByName(ev), topic)
    events.consume(events.dedupe_events(events.stream_events(spark, topic)), sink, ckpt)
    assert sorted(r.event_id for r in spark.read.parquet(sink).collect()) == [
        "SALES-2024-01-Toys", "SALES-2024-02-Toys", "SALES-2024-03-Toys"]
    totals = events.event_log_rollup(events.read_log(spark, topic)).first()
    assert (totals.events, totals.orders, totals.units) == (3, 4, 7)


def test_raw_payload_log_and_first_n(spark):
    topic, sink, ckpt = (shared_dir(spark, n) for n in ("topic", "raw", "ckpt"))
    events.publish(events.build_events(_gold(spark)), topic)
    q = events.consume(spark.readStream.format("text").load(topic), sink, ckpt, fmt="text")
    assert not q.isActive and q.exception() is None
    assert spark.read.text(sink).count() == 2
    first = events.read_first(spark, topic, 1).collect()
    assert len(first) == 1 and first[0].event_id == "SALES-2024-01-Toys"


def test_require_rows(spark):
    import pytest
    with pytest.raises(ValueError, match="empty"):
        events.require_rows(spark.range(0), "events")


def test_watermark_dedupe_expires_state(spark, scratch):
    import json
    import os
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    rows = [{"event_id": "a", "ts": "2024-01-01 00:00:00"}, {"event_id": "a", "ts": "2024-01-01 00:00:05"},
            {"event_id": "b", "ts": "2024-01-01 00:01:00"}]
    with open(os.path.join(src, "1.json"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))
    stream = spark.readStream.schema("event_id string, ts timestamp").json(src)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    events.consume(events.dedupe_events(stream, event_time="ts", delay="1 hour"), out, ckpt)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["a", "b"]
