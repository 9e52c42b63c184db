"""Monthly summary rows as keyed JSON events.

Events are built set-based from the Gold table and written by the executors; nothing
passes through the driver. The transport is a folder of JSON-lines files by default
(``format="kafka"`` plus broker options where the connector is installed). Reading is
a checkpointed Structured Streaming query with ``trigger(availableNow=True)``: it picks
up from the last committed offset, drains what is there and stops.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# The event type and the Gold columns an event is built from.
EVENT_TYPE = "MONTHLY_CATEGORY_SALES_READY"
EVENT_COLUMNS = ("order_month", "category", "order_count", "total_quantity", "total_revenue")

EVENT_SCHEMA = (
    "event_id string, event_type string, sales_month string, category string, "
    "order_count bigint, total_quantity bigint, total_revenue decimal(18,2)"
)
EVENT_FIELDS = [f.split()[0] for f in EVENT_SCHEMA.split(", ")]


def _eventable() -> Column:
    return F.coalesce(F.col("order_month").isNotNull() & F.col("category").isNotNull(), F.lit(False))


def build_events(gold_monthly: DataFrame) -> DataFrame:
    """P13 + P18: one event per (month, category); revenue rounded half-even to cents.

    Rows without a month or category cannot make a valid id and are left to
    :func:`event_rejects` (G7) instead of producing ``SALES-None-...`` ids.
    """
    src = gold_monthly.select(*EVENT_COLUMNS).filter(_eventable())
    return src.select(
        F.concat(F.lit("SALES-"), F.col("order_month"), F.lit("-"), F.col("category")).alias("event_id"),
        F.lit(EVENT_TYPE).alias("event_type"),
        F.col("order_month").alias("sales_month"),
        F.col("category"),
        F.col("order_count").cast("bigint").alias("order_count"),
        F.col("total_quantity").cast("bigint").alias("total_quantity"),
        F.bround("total_revenue", 2).cast("decimal(18,2)").alias("total_revenue"),
    )


def event_rejects(gold_monthly: DataFrame) -> DataFrame:
    return gold_monthly.select(*EVENT_COLUMNS).filter(~_eventable())


def to_messages(events: DataFrame, *keep: str) -> DataFrame:
    """``key`` = event id, ``value`` = the JSON document (decimals print exactly); columns to ``keep`` go in front."""
    return events.select(
        *keep,
        F.col("event_id").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in EVENT_FIELDS])).alias("value"),
    )


def from_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Decode message values (string or UTF-8 binary) back into event columns."""
    doc = F.from_json(F.col(value).cast("string"), EVENT_SCHEMA)
    return messages.select(doc.alias("_e")).select("_e.*")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Refuse to go on with an empty input (fetches at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def publish(
    events: DataFrame,
    target: str,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
) -> int:
    """Write events keyed by id; returns the number delivered.

    Messages are written in ``(sales_month, category)`` order (O5). The count is an
    ``Observation`` on the same job, so the plan runs once. Any failed task fails the
    write, which is the all-or-error delivery contract.
    """
    obs = Observation("published")
    ordered = events.orderBy("sales_month", "category")
    messages = to_messages(ordered).observe(obs, F.count(F.lit(1)).alias("delivered"))
    if fmt == "kafka":
        messages.write.format("kafka").options(**(options or {})).option("topic", target).save()
    else:
        messages.select("value").write.mode("append").text(target)
    return int(obs.get["delivered"])


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a file topic: every line ever published, replays included."""
    return from_messages(spark.read.text(path).filter(F.length("value") > 0))


def read_first(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` messages of a file topic in publish order (time of the file, file, line)."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_modification_time").alias("_at"),
        F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_pos"),
    )
    return from_messages(lines.orderBy("_at", "_file", "_pos").limit(n))


def stream_events(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    fmt: str = "text",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The topic as a stream of decoded events, from the earliest offset.

    ``path`` is a folder of JSON lines, or with ``fmt="kafka"`` the topic name (broker
    options in ``options``; needs the Kafka connector on the classpath).
    """
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .options(**(options or {}))
            .option("subscribe", path)
            .option("startingOffsets", "earliest")
        )
        return from_messages(reader.load().filter(F.col("value").isNotNull() & (F.length("value") > 0)))
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(path)
    # empty payloads carry no event
    return from_messages(lines.filter(F.length("value") > 0))


def dedupe_events(stream: DataFrame, event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """T4: keep the first copy of every event id.

    Without an event-time column the state holds every id seen (one per month and
    category, so bounded by the Gold table). With one, ``dropDuplicatesWithinWatermark``
    lets Spark expire ids once the watermark passes them.
    """
    if event_time:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["event_id"])
    return stream.dropDuplicates(["event_id"])


def consume(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Drain everything available since the last checkpoint into ``sink``.

    Progress lives in the checkpoint, so a rerun only reads new files; the file sink
    commits each micro-batch once, so a restarted batch does not duplicate output.
    """
    query = (
        stream.writeStream.format(fmt)
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def event_log_rollup(log: DataFrame) -> DataFrame:
    """T5: control totals of an event log, each event id counted once."""
    distinct = log.dropDuplicates(["event_id"])
    return distinct.agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("order_count").cast("bigint").alias("orders"),
        F.sum("total_quantity").cast("bigint").alias("units"),
        F.sum("total_revenue").cast("decimal(38,2)").alias("revenue"),
    )
