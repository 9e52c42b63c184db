"""A numbered message log in Parquet: publish in order, read the next N, append batches that may be repeated.

Every message has a sequence number: 1, 2, 3, ... in publish order, without gaps. "The next N" is thus a
range filter that Parquet statistics prune, not a sort. One publisher writes a log at a time. Sinks hold a
folder a batch, and a batch written again overwrites itself, so a reader that dies anywhere between
writing its rows and committing its progress repeats that batch and nothing else.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.rank import number_rows
from .events import to_messages

LOG_SCHEMA = "seq bigint, key string, value string"


def create_log(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], LOG_SCHEMA).write.mode("ignore").parquet(path)


def last_number(spark: SparkSession, log: str) -> int:
    return spark.read.schema(LOG_SCHEMA).parquet(log).agg(F.max("seq")).first()[0] or 0


def publish(events: DataFrame, log: str) -> int:
    """Append events in (sales_month, category, event_id) order, numbered on from the log's last message.

    Numbers are dealt by range-partitioned counting, not by one task. Returns the messages written.
    """
    spark = events.sparkSession
    create_log(spark, log)
    numbered = number_rows(events, ["sales_month", "category", "event_id"], start=last_number(spark, log), out="seq")
    messages = to_messages(numbered, "seq")
    obs = Observation("published")
    messages.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(log)
    return int(obs.get["rows"])


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(log)


def committed(spark: SparkSession, progress: str) -> tuple[int, int]:
    """``(batches, last number read)`` of a reader; (0, 0) before its first."""
    try:
        done = spark.read.option("basePath", progress).parquet(progress)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, 0
    row = done.agg(F.max("batch"), F.max("last")).first()
    return (0, 0) if row[0] is None else (int(row[0]) + 1, int(row[1]))


def append_batch(rows: DataFrame, sink: str, batch: int) -> None:
    """The rows of one batch; a batch that comes again replaces itself."""
    rows.write.mode("overwrite").parquet(f"{sink}/batch={batch}")


def read_next(spark: SparkSession, log: str, sink: str, progress: str, n: int) -> int:
    """Take the next ``n`` messages behind the committed number into ``sink``; returns how many there were.

    Empty payloads are passed over (F10) but count as read. The progress is committed after the rows,
    under the same batch number; a call that failed in between is made good by the next one.
    """
    batch, last = committed(spark, progress)
    obs = Observation("read")
    rows = read_log(spark, log).where(F.col("seq").between(last + 1, last + n))
    rows = rows.observe(obs, F.count(F.lit(1)).alias("rows"), F.max("seq").alias("last"))
    append_batch(rows.where(F.length("value") > 0), sink, batch)
    if not obs.get["rows"]:
        return 0
    spark.createDataFrame([(int(obs.get["last"]),)], "last bigint").write.mode("overwrite").parquet(f"{progress}/batch={batch}")
    return int(obs.get["rows"])


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """All batches of a sink, with their number in ``batch``."""
    return spark.read.option("basePath", sink).parquet(sink)


def consume_batches(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Drain what is there into ``sink``, a folder a micro-batch.

    Structured Streaming repeats a micro-batch under its number after a failure; it then replaces itself.
    """
    query = (
        stream.writeStream.foreachBatch(lambda rows, batch: append_batch(rows, sink, batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
