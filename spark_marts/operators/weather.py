"""Weather documents to relational rows, and the weather analytics.

Covers P14-P17, P20, J5-J7, D8, W6, W7, A8-A12 and M1-M6. Per-place windows are safe
here: the fact table holds one row per (place, day) (checked by the primary-key
constraint), so a place's partition is bounded by the number of calendar days however
many places or rows there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.bindings import DAILY_FIELDS
from .clean import latest_by_key
from .rank import rolling_sum_days, rolling_sum_rows, top_k

ARRAY_FIELDS = ["time", *DAILY_FIELDS]
WEATHER_COLUMNS = ["location_id", "day", *DAILY_FIELDS]
# What read_weather_documents(..., delivery=True) orders documents by.
DELIVERY = ("delivered_at", "file", "block", "line")


# --------------------------------------------------------------------- documents


def document_problems(docs: DataFrame, keep_clean: bool = False) -> DataFrame:
    """Per document: missing/NULL arrays, NULL entries, unequal lengths. Only the bad
    documents are returned (none when clean) unless ``keep_clean``."""
    sizes = [F.size(F.col(f"daily.{f}")) for f in ARRAY_FIELDS]
    missing = [F.col(f"daily.{f}").isNull() for f in ARRAY_FIELDS]
    has_null = [F.exists(F.col(f"daily.{f}"), lambda x: x.isNull()) for f in ARRAY_FIELDS]
    any_of = lambda cs: F.greatest(*[F.coalesce(c, F.lit(False)).cast("int") for c in cs]) == 1
    report = docs.select(
        "latitude",
        "longitude",
        F.size(F.col("daily.time")).alias("days"),
        any_of(missing).alias("missing_array"),
        any_of(has_null).alias("null_entry"),
        F.coalesce(F.least(*sizes) != F.greatest(*sizes), F.lit(True)).alias("unequal_length"),
    )
    if keep_clean:
        return report
    return report.filter(F.col("missing_array") | F.col("null_entry") | F.coalesce(F.col("unequal_length"), F.lit(True)))


def validate_documents(docs: DataFrame) -> DataFrame:
    """Strict batch validation: any bad document rejects the whole batch (all-or-nothing)."""
    bad = document_problems(docs)
    if not bad.isEmpty():
        n = bad.count()
        raise ValueError(f"{n} weather document(s) failed validation")
    return docs


def _is_bad() -> Column:
    """Whether a document fails: a missing array, a NULL entry or arrays of unequal length."""
    arrays = [F.col(f"daily.{f}") for f in ARRAY_FIELDS]
    sizes = [F.size(a) for a in arrays]
    broken = [a.isNull() | F.coalesce(F.exists(a, lambda x: x.isNull()), F.lit(True)) for a in arrays]
    return F.array_contains(F.array(*broken), True) | F.coalesce(F.least(*sizes) != F.greatest(*sizes), F.lit(True))


def flatten_daily(docs: DataFrame, strict: bool = False) -> DataFrame:
    """P16 + P14: one row per array index; ``time`` becomes ``day``.

    ``arrays_zip`` pads unequal arrays with NULLs. With ``strict`` the projection itself fails on a bad
    document (D8): one execution validates and flattens, and a job that fails writes no row of the batch.
    """
    zipped = F.arrays_zip(*[F.col(f"daily.{f}").alias(f) for f in ARRAY_FIELDS])
    if strict:
        where = F.concat(F.lit("weather document failed validation: "), F.coalesce(F.col("latitude").cast("string"), F.lit("?")),
                         F.lit(", "), F.coalesce(F.col("longitude").cast("string"), F.lit("?")))
        zipped = F.when(_is_bad(), F.raise_error(where)).otherwise(zipped)
    rows = docs.select("latitude", "longitude", F.inline(zipped))
    return rows.withColumnRenamed("time", "day")


def latest_documents(docs: DataFrame, order: Sequence[str] = DELIVERY, keys: Sequence[str | Column] = ("latitude", "longitude")) -> DataFrame:
    """Of the documents for one place the last delivered one counts.

    ``order`` are columns of ``docs`` that grow with the delivery (see ``read_weather_documents``); of
    documents that tie, the greatest counts. ``keys`` may hold expressions, such as the month of a document.
    """
    named = [F.col(k).alias(f"_key{i}") if isinstance(k, str) else k.alias(f"_key{i}") for i, k in enumerate(keys)]
    out = latest_by_key(docs.select("*", *named), [f"_key{i}" for i in range(len(named))], list(order))
    return out.select(*[c for c in docs.columns if c not in order])


def month_of_document() -> Column:
    """The month a document starts in: the third key where a place's series comes in monthly documents."""
    return F.trunc(F.get(F.col("daily.time"), F.lit(0)), "month")


# ------------------------------------------------------------------ locate and load


def one_name(places: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One name for each coordinate: the last by ``order``, else the greatest. A stored place takes the last name saved."""
    return latest_by_key(places, ["latitude", "longitude"], list(order)).select("name", "latitude", "longitude")


def locate(rows: DataFrame, places: DataFrame, precision: int | None = None, required: bool = False) -> DataFrame:
    """J6 + P17: attach the place name on exact (latitude, longitude) equality.

    Rows of documents whose coordinates name no place are dropped; see
    :func:`unmatched_places` / :func:`unmatched_rows` for the report. ``precision``
    joins on coordinates rounded to that many decimals instead (G12: an API may answer
    with the nearest grid node rather than the coordinates asked for); the document's
    own coordinates are kept. ``required`` makes the plan fail when nothing matches: a branch
    over the coordinates alone counts the matches and adds no row.

    Names that share a coordinate each get a row; reduce ``places`` by :func:`one_name` before a load.
    """
    if required:
        found = locate(rows.select("latitude", "longitude").distinct(), places, precision).agg(F.count(F.lit(1)).alias("_n"))
        fail = F.raise_error(F.lit("no weather row lies at a known place")).cast("boolean")
        out = locate(rows, places, precision)
        none = found.where(F.when(F.col("_n") > 0, F.lit(False)).otherwise(fail))
        return out.unionByName(none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema]))
    rest = [c for c in rows.columns if c not in ("latitude", "longitude")]
    if precision is None:
        located = rows.join(places.select("name", "latitude", "longitude"), ["latitude", "longitude"])
        return located.select("name", "latitude", "longitude", *rest)
    key = lambda df: [F.round(df["latitude"], precision).alias("_lat"), F.round(df["longitude"], precision).alias("_lon")]
    r = rows.select("*", *key(rows))
    p = places.select(F.col("name"), *key(places))
    return r.join(p, ["_lat", "_lon"]).select("name", "latitude", "longitude", *rest)


def unmatched_places(places: DataFrame, rows: DataFrame) -> DataFrame:
    return places.join(rows.select("latitude", "longitude").distinct(), ["latitude", "longitude"], "left_anti")


def unmatched_rows(rows: DataFrame, places: DataFrame) -> DataFrame:
    return rows.join(places.select("latitude", "longitude"), ["latitude", "longitude"], "left_anti")


def distinct_places(located: DataFrame) -> DataFrame:
    """The places that actually have data."""
    return located.select("name", "latitude", "longitude").distinct()


def to_fact(located: DataFrame, location_dim: DataFrame) -> DataFrame:
    """Swap the place for its surrogate id, joined on coordinates (not on the name,
    which two places may share)."""
    dim = location_dim.select("location_id", "latitude", "longitude")
    return located.join(dim, ["latitude", "longitude"]).select(*WEATHER_COLUMNS)


# ------------------------------------------------------------------------ analytics


def with_names(weather: DataFrame, location_dim: DataFrame) -> DataFrame:
    """Fact joined to the location dimension on ``location_id``."""
    return weather.join(location_dim, "location_id")


def hottest_per_day(joined: DataFrame) -> DataFrame:
    """The place(s) with the highest apparent maximum each day; ties all kept."""
    top = top_k(joined, ["day"], "apparent_temperature_max", 1, "rank", out="_rnk")
    return top.select("day", "name", "apparent_temperature_max")


def rolling_rain(
    joined: DataFrame, since: str, calendar: bool = False, rows: int = 7, ordered: bool = False
) -> DataFrame:
    """W7 (+F7): rain today plus the six rows (or calendar days) before it, per place.

    The date bound applies before the window, so the first days after it see a short
    frame. Rain is summed as exact cents.
    """
    src = joined.filter(F.col("day") > F.lit(since).cast("date")).withColumn(
        "_rain", F.col("rain_sum").cast("decimal(18,2)")
    )
    if calendar:
        out = rolling_sum_days(src, ["location_id"], "day", "_rain", rows, "past_seven_day_total")
    else:
        out = rolling_sum_rows(src, ["location_id"], "day", "_rain", rows, "past_seven_day_total")
    if ordered:  # O2: by day, then by a column the report does not show
        out = out.orderBy("day", "latitude")
    return out.select("name", "day", "rain_sum", "past_seven_day_total")


def daylight(joined: DataFrame) -> DataFrame:
    """P20: ``sunset - sunrise`` as an interval, and both durations as intervals and seconds."""
    return joined.select(
        "name",
        "day",
        (F.col("sunset") - F.col("sunrise")).alias("total_daylight"),
        F.make_dt_interval(secs=F.col("sunshine_duration")).alias("sunshine_time"),
        F.make_dt_interval(secs=F.col("daylight_duration")).alias("daylight_time"),
        F.timestamp_diff("SECOND", F.col("sunrise"), F.col("sunset")).alias("total_daylight_seconds"),
        F.col("sunshine_duration").cast("bigint").alias("sunshine_seconds"),
        F.col("daylight_duration").cast("bigint").alias("daylight_seconds"),
    )


def _cents(col: str) -> Column:
    return F.col(col).cast("decimal(18,2)")


def _per_place(joined: DataFrame, *aggs: Column, extra: Sequence[str] = (), ordered: bool = False,
               then: Sequence[Column] = ()) -> DataFrame:
    """Aggregate per place. ``latitude`` depends on ``location_id``, so it rides along as
    a group key and the report can be ordered by it without showing it (O2)."""
    out = joined.groupBy("location_id", "name", "latitude", *extra).agg(*aggs)
    if ordered:
        out = out.orderBy("latitude", *then)
    return out.drop("latitude")


def precipitation_totals(joined: DataFrame, ordered: bool = False) -> DataFrame:
    """Precipitation hours and rain per place (hours are whole numbers; rain in cents)."""
    return _per_place(
        joined,
        F.sum("precipitation_hours").alias("total_precipitation_hours"),
        F.sum(_cents("rain_sum")).alias("total_rain_sum"),
        ordered=ordered,
    )


def mean_wind_direction(joined: DataFrame, ordered: bool = False) -> DataFrame:
    """Arithmetic mean of the dominant direction (not a circular mean, as specified)."""
    d = "wind_direction_10m_dominant"
    return _per_place(joined, (F.sum(d) / F.count(d)).alias("avg_wind_direction"), ordered=ordered)


def circular_mean_direction(joined: DataFrame) -> DataFrame:
    """Direction-aware mean (degrees in [0, 360)), for comparison with A9."""
    rad = F.radians("wind_direction_10m_dominant")
    mean = F.degrees(F.atan2(F.avg(F.sin(rad)), F.avg(F.cos(rad))))
    return joined.groupBy("location_id", "name").agg(F.pmod(mean, F.lit(360.0)).alias("circular_wind_direction"))


def code_frequency(joined: DataFrame, ordered: bool = False) -> DataFrame:
    """A10: days per (place, weather code); most frequent first within a place."""
    return _per_place(
        joined, F.count(F.lit(1)).alias("weather_code_frequency"), extra=["weather_code"], ordered=ordered,
        then=[F.col("weather_code_frequency").desc()],
    )


def max_temperature(joined: DataFrame) -> DataFrame:
    """M1: the highest maximum per place and the (latest) day it occurred."""
    best = F.max(F.struct("temperature_2m_max", "day"))
    return joined.groupBy("location_id", "name").agg(
        best["temperature_2m_max"].alias("max_temperature"), best["day"].alias("hottest_day")
    )


def monthly_precipitation(joined: DataFrame) -> DataFrame:
    """M2: precipitation per place and calendar month."""
    return joined.groupBy("location_id", "name", F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.sum(_cents("precipitation_sum")).alias("total_precipitation")
    )


def windiest_week(joined: DataFrame) -> DataFrame:
    """M3: the ISO week (Monday start) with the highest mean daily maximum wind; ties kept."""
    monday = F.date_sub(F.col("day"), (F.dayofweek("day") + 5) % 7)  # calendar arithmetic, no time zone
    weekly = joined.groupBy(monday.alias("week_start")).agg(
        F.avg(_cents("wind_speed_10m_max")).alias("avg_wind_speed"),
        F.max("wind_speed_10m_max").alias("max_wind_speed"),
    )
    return top_k(weekly, [], "avg_wind_speed", 1, "rank", out="_rnk").drop("_rnk")


def mean_rain(joined: DataFrame) -> DataFrame:
    """M4: average daily rain per place."""
    return joined.groupBy("location_id", "name").agg(F.avg(_cents("rain_sum")).alias("avg_rain_sum"))


def extreme_days(joined: DataFrame, hot: float, cold: float) -> DataFrame:
    """M5: days per place whose maximum reaches ``hot`` or whose minimum reaches ``cold``."""
    extreme = (F.col("temperature_2m_max") >= hot) | (F.col("temperature_2m_min") <= cold)
    return joined.groupBy("location_id", "name").agg(F.count_if(extreme).alias("extreme_days"))


def hottest_month(joined: DataFrame) -> DataFrame:
    """M6: the calendar month with the highest mean daily temperature; ties kept."""
    monthly = joined.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.avg(F.col("temperature_2m_mean").cast("decimal(18,3)")).alias("avg_temperature")
    )
    return top_k(monthly, [], "avg_temperature", 1, "rank", out="_rnk").drop("_rnk")


# The relational tables with their NOT NULL columns (keys are checked by D9).
LOCATION_SCHEMA = T.StructType(
    [
        T.StructField("location_id", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
    ]
)
WEATHER_SCHEMA = T.StructType(
    [T.StructField("location_id", T.LongType(), False), T.StructField("day", T.DateType(), False),
     T.StructField("weather_code", T.IntegerType(), False)]
    + [T.StructField(f, T.DoubleType(), False) for f in DAILY_FIELDS if f not in ("weather_code", "sunset", "sunrise")]
    + [T.StructField("sunset", T.TimestampNTZType(), False), T.StructField("sunrise", T.TimestampNTZType(), False)]
)


WEATHER_BUCKETS = 8


def create_tables(spark, namespace: str, buckets: int = WEATHER_BUCKETS) -> None:
    """Create empty Location and Weather tables if absent.

    Weather is bucketed and sorted by its place, so a look-up of one place reads one bucket (S15).
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")
    for name, schema in (("location", LOCATION_SCHEMA), ("weather", WEATHER_SCHEMA)):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)
        layout = f"CLUSTERED BY (location_id) SORTED BY (location_id) INTO {buckets} BUCKETS" if name == "weather" else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {namespace}.{name} ({columns}) USING parquet {layout}")
