import datetime as dt
import json
import os

import pytest

from spark_marts.operators import upsert, weather
from spark_marts.sources import raw
from spark_marts.sources.bindings import DAILY_FIELDS


def _doc(lat, lon, days, start=1, break_array=None):
    daily = {"time": [f"2026-05-{start + i:02d}" for i in range(days)]}
    for f in DAILY_FIELDS:
        if f == "weather_code":
            daily[f] = [3] * days
        elif f in ("sunset", "sunrise"):
            daily[f] = [f"2026-05-{start + i:02d}T{'20' if f == 'sunset' else '06'}:0{i % 10}" for i in range(days)]
        else:
            daily[f] = [float(i) for i in range(days)]
    daily["apparent_temperature_max"] = [10.0 + i for i in range(days)]
    daily["rain_sum"] = [1.5] * days
    if break_array:
        daily[break_array] = daily[break_array][:-1]
    return {"latitude": lat, "longitude": lon, "generationtime_ms": 1.0, "utc_offset_seconds": 0,
            "timezone": "GMT", "timezone_abbreviation": "GMT", "elevation": 10.0,
            "daily_units": {f: "u" for f in ["time", *DAILY_FIELDS]}, "daily": daily}


@pytest.fixture()
def doc_files(scratch):
    docs = [_doc(38.5, -121.75, 9), _doc(37.25, -121.875, 9), _doc(10.0, 10.0, 3)]
    places = [{"name": "Davis", "latitude": 38.5, "longitude": -121.75},
              {"name": "San Jose", "latitude": 37.25, "longitude": -121.875},
              {"name": "Nowhere", "latitude": 0.0, "longitude": 0.0}]
    dp, lp = os.path.join(scratch, "api.json"), os.path.join(scratch, "locations.json")
    with open(dp, "w") as fh:
        json.dump(docs, fh)
    with open(lp, "w") as fh:
        json.dump(places, fh)
    return dp, lp


def test_json_scan_flatten_and_locate(spark, doc_files):
    docs = weather.validate_documents(raw.read_weather_documents(spark, doc_files[0]))
    rows = weather.flatten_daily(docs)
    assert rows.count() == 21
    first = rows.filter("latitude = 38.5").orderBy("day").first()
    assert first.day == dt.date(2026, 5, 1) and first.sunset == dt.datetime(2026, 5, 1, 20, 0)
    places = raw.read_locations(spark, doc_files[1])
    located = weather.locate(rows, places)
    assert located.count() == 18
    assert [r.name for r in weather.unmatched_places(places, rows).collect()] == ["Nowhere"]
    assert weather.unmatched_rows(rows, places).count() == 3


def test_strict_validation_rejects_unequal_arrays(spark, scratch):
    p = os.path.join(scratch, "bad.json")
    with open(p, "w") as fh:
        json.dump([_doc(1.0, 1.0, 4), _doc(2.0, 2.0, 4, break_array="rain_sum")], fh)
    docs = raw.read_weather_documents(spark, p)
    assert weather.document_problems(docs).count() == 1
    with pytest.raises(ValueError, match="1 weather document"):
        weather.validate_documents(docs)


def _joined(spark):
    rows = [
        (1, "A", 1.0, dt.date(2024, 1, d), float(d), 1.0 + d % 2) for d in range(1, 11)
    ] + [
        (2, "B", 2.0, dt.date(2024, 1, d), float(d) if d != 3 else 99.0, 2.0) for d in (1, 2, 3, 5, 9)
    ]
    return spark.createDataFrame(rows, "location_id long, name string, latitude double, day date, "
                                       "apparent_temperature_max double, rain_sum double")


def test_hottest_per_day_keeps_ties(spark):
    got = sorted((r.day.day, r.name) for r in weather.hottest_per_day(_joined(spark)).collect())
    assert got[:3] == [(1, "A"), (1, "B"), (2, "A")] and (3, "B") in got


def test_rolling_rows_vs_calendar_days(spark):
    j = _joined(spark)
    rows = {r.day.day: r.past_seven_day_total for r in weather.rolling_rain(j.filter("name = 'B'"), "2023-12-31").collect()}
    cal = {r.day.day: r.past_seven_day_total for r in weather.rolling_rain(j.filter("name = 'B'"), "2023-12-31", calendar=True).collect()}
    assert float(rows[9]) == 10.0  # five rows
    assert float(cal[9]) == 6.0  # days 3, 5 and 9 fall in the 7 calendar days ending on the 9th


def test_upsert_dimension_keeps_ids_and_numbers_new_keys(spark):
    target = spark.createDataFrame([(1, 1.0, 1.0, "a"), (2, 2.0, 2.0, "b")], "location_id long, latitude double, longitude double, name string")
    updates = spark.createDataFrame([(2.0, 2.0, "b2"), (0.5, 9.0, "new2"), (0.5, 3.0, "new1")], "latitude double, longitude double, name string")
    got = sorted(tuple(r) for r in upsert.upsert_dimension(target, updates, ["latitude", "longitude"], "location_id").collect())
    assert got == [(1, 1.0, 1.0, "a"), (2, 2.0, 2.0, "b2"), (3, 0.5, 3.0, "new1"), (4, 0.5, 9.0, "new2")]


def test_upsert_fact_replaces_matching_keys(spark):
    t = spark.createDataFrame([(1, "d1", 1.0), (1, "d2", 2.0)], "k int, day string, v double")
    u = spark.createDataFrame([(1, "d2", 20.0), (2, "d1", 5.0)], "k int, day string, v double")
    got = sorted(tuple(r) for r in upsert.upsert_fact(t, u, ["k", "day"]).collect())
    assert got == [(1, "d1", 1.0), (1, "d2", 20.0), (2, "d1", 5.0)]
    assert upsert.lookup(upsert.upsert_fact(t, u, ["k", "day"]), "k", 1).count() == 2


def test_circular_mean_differs_from_arithmetic(spark):
    df = spark.createDataFrame([(1, "A", 1.0, 350.0), (1, "A", 1.0, 10.0)],
                               "location_id long, name string, latitude double, wind_direction_10m_dominant double")
    assert weather.mean_wind_direction(df).first().avg_wind_direction == 180.0
    c = weather.circular_mean_direction(df).first().circular_wind_direction
    assert abs(c) < 1e-9 or abs(c - 360.0) < 1e-9


def test_rounded_coordinate_join(spark):
    rows = spark.createDataFrame([(38.4999, -121.7501, 1)], "latitude double, longitude double, v int")
    places = spark.createDataFrame([("Davis", 38.5, -121.75)], "name string, latitude double, longitude double")
    assert weather.locate(rows, places).count() == 0  # exact equality misses grid offsets
    got = weather.locate(rows, places, precision=2).first()
    assert (got.name, got.latitude) == ("Davis", 38.4999)


def test_place_reports_are_ordered_by_hidden_latitude(spark):
    df = spark.createDataFrame(
        [(2, "North", 50.0, 1.0, 1.0), (1, "South", -10.0, 2.0, 3.0), (1, "South", -10.0, 2.0, 3.0)],
        "location_id long, name string, latitude double, precipitation_hours double, rain_sum double")
    out = weather.precipitation_totals(df, ordered=True)
    assert "latitude" not in out.columns
    assert [r.name for r in out.collect()] == ["South", "North"]


def test_create_tables_declares_not_null(spark):
    weather.create_tables(spark, "ddl_test")
    schema = spark.table("ddl_test.weather").schema
    assert schema["day"].dataType.simpleString() == "date"
    assert len(schema) == 22
    assert [f.name for f in spark.table("ddl_test.location").schema] == ["location_id", "name", "latitude", "longitude"]
