"""Raw file scans.

CSV is read with a header and no inference, so every column is a string; JSON documents
are read against an explicit schema, never an inferred one (whole-number measures would
otherwise come back as ``bigint``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bindings import DAILY_FIELDS


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header row names the columns; all values stay strings; empty fields are NULL."""
    return spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").csv(path)


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Land a raw table as CSV with a header, values written exactly (no whitespace trim)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def stamp_lineage(raw: DataFrame, source_file: str | None = None) -> DataFrame:
    """``source_file`` (the scanned file, or a given name) and ``ingestion_timestamp``."""
    src = F.lit(source_file) if source_file else F.col("_metadata.file_path")
    return raw.withColumns({"source_file": src, "ingestion_timestamp": F.current_timestamp()})


# Measures stored as doubles in a daily document (all but the code and the two instants).
_DOUBLE_FIELDS = [f for f in DAILY_FIELDS if f not in ("weather_code", "sunset", "sunrise")]

DAILY_SCHEMA = T.StructType(
    [T.StructField("time", T.ArrayType(T.DateType()))]
    + [T.StructField("weather_code", T.ArrayType(T.IntegerType()))]
    + [T.StructField(f, T.ArrayType(T.DoubleType())) for f in _DOUBLE_FIELDS]
    + [T.StructField("sunset", T.ArrayType(T.TimestampNTZType())), T.StructField("sunrise", T.ArrayType(T.TimestampNTZType()))]
)

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("generationtime_ms", T.DoubleType()),
        T.StructField("utc_offset_seconds", T.IntegerType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("timezone_abbreviation", T.StringType()),
        T.StructField("elevation", T.DoubleType()),
        T.StructField("daily_units", T.StructType([T.StructField(f, T.StringType()) for f in ["time", *DAILY_FIELDS]])),
        T.StructField("daily", DAILY_SCHEMA),
    ]
)

LOCATION_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)


def read_weather_documents(spark: SparkSession, path: str, multiline: bool = True, delivery: bool = False) -> DataFrame:
    """Weather documents against the explicit schema; a malformed file fails the scan.

    Instants are ISO text without seconds and without a zone (UTC by contract). ``delivery`` adds what orders
    the documents: time and path of the file, then the place in it.
    """
    docs = (
        spark.read.schema(DOCUMENT_SCHEMA)
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm[:ss]")
        .option("dateFormat", "yyyy-MM-dd")
        .json(path)
    )
    if not delivery:
        return docs
    return docs.select(
        "*", F.col("_metadata.file_modification_time").alias("delivered_at"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"),
    )


def read_locations(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Reference list of named places."""
    return spark.read.schema(LOCATION_SCHEMA).option("multiLine", multiline).option("mode", "FAILFAST").json(path)


def write_weather_documents(docs: DataFrame, path: str) -> None:
    """Land documents as JSON lines in the API's text format (instants without seconds)."""
    (
        docs.write.mode("overwrite")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm")
        .option("dateFormat", "yyyy-MM-dd")
        .json(path)
    )
