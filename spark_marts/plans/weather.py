"""The weather load (entry point D) as one plan: documents -> rows -> places -> tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import upsert
from ..operators import weather as w
from ..operators.rank import number_rows
from ..session import materialize
from ..sources import bindings, tables


@dataclass(frozen=True)
class WeatherTables:
    located: DataFrame  # name, latitude, longitude, day, measures
    location: DataFrame  # location_id, name, latitude, longitude
    weather: DataFrame  # location_id, day, 20 measures


def location_dimension(located: DataFrame) -> DataFrame:
    """Load into an empty Location table: ids 1..n in (latitude, longitude) order, the first name of a coordinate."""
    places = located.groupBy("latitude", "longitude").agg(F.min("name").alias("name"))
    return number_rows(places, ["latitude", "longitude"], start=0, out="location_id").select(
        "location_id", "name", "latitude", "longitude"
    )


def rows_from_documents(spark: SparkSession, sf_dir: str, strict: bool = True) -> DataFrame:
    return w.flatten_daily(bindings.weather_documents(spark, sf_dir), strict)


def daily_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as flattened documents, straight from the daily aggregate."""
    daily = bindings.daily_measures(spark, sf_dir)
    key = daily["user_id"]
    return daily.select(bindings.grid_latitude(key), bindings.grid_longitude(key), "day", *bindings.DAILY_FIELDS)


def load(spark: SparkSession, sf_dir: str, via_documents: bool = False) -> WeatherTables:
    """Located rows feed both the place dimension and the fact, so they are
    materialised once rather than aggregated from the events twice."""
    rows = rows_from_documents(spark, sf_dir) if via_documents else daily_rows(spark, sf_dir)
    located = materialize(w.locate(rows, w.one_name(bindings.locations(spark, sf_dir)), required=True))
    location = location_dimension(located)
    return WeatherTables(located, location, w.to_fact(located, location))


def load_batch(location: DataFrame, weather: DataFrame, rows: DataFrame, places: DataFrame, place_order: Sequence[str] = ()) -> WeatherTables:
    """The next versions of Location and Weather after one batch of daily rows.

    Stored coordinates keep their id and take the batch's name, new ones are numbered after the greatest id
    in (latitude, longitude) order, and rows replace those of the same (place, day). A coordinate
    with several names in the batch has the last one (``place_order``), so Weather stays unique by
    (location_id, day). A batch that lies at no known place fails.
    """
    located = materialize(w.locate(rows, w.one_name(places, place_order), required=True), "located")
    found = w.distinct_places(located).select("latitude", "longitude", "name")
    next_location = upsert.upsert_dimension(location, found, ["latitude", "longitude"], "location_id")
    next_location = materialize(next_location.select("location_id", "name", "latitude", "longitude"), "location")
    facts = w.to_fact(located, next_location)
    return WeatherTables(located, next_location, upsert.upsert_fact(weather, facts, ["location_id", "day"]))


def reload(spark: SparkSession, namespace: str, docs: DataFrame, places: DataFrame, order: Sequence[str] = w.DELIVERY,
           keys: Sequence = ("latitude", "longitude"), place_order: Sequence[str] = (), buckets: int = w.WEATHER_BUCKETS) -> dict[str, int]:
    """Loads a batch of documents into the stored tables (made if absent); returns their row counts.

    Of documents for one place the last delivered counts, a bad document fails the batch before
    either table is switched, and each table is switched to its next version at once.
    """
    w.create_tables(spark, namespace, buckets)
    stored = {name: f"{namespace}.{name}" for name in ("location", "weather")}
    rows = w.flatten_daily(w.latest_documents(docs, order, keys), strict=True)
    t = load_batch(spark.table(stored["location"]), spark.table(stored["weather"]), rows, places, place_order)
    layout = {"weather": (buckets, ["location_id"])}
    return {name: tables.replace_table(spark, getattr(t, name), stored[name], bucket_by=layout.get(name)) for name in stored}


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir)
    return w.with_names(t.weather, t.location)
