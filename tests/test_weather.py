import datetime as dt

import pytest
from samples import COLUMNS, WEATHER, occurrences
from pyspark.sql import functions as F

from cinderlake.operators import spatial, weather


@pytest.fixture(scope="module")
def daily(spark):
    return spark.createDataFrame(WEATHER, "date string, lat double, lon double, temp_max double, temp_min double") \
        .withColumn("date", F.col("date").cast("date"))


@pytest.fixture(scope="module")
def sample(spark):
    return occurrences(spark).withColumn("source_file", F.lit("2001.csv"))


def test_detail(sample, daily, rows):
    got = rows(weather.weather_detail(weather.incident_spans(sample), daily))
    assert len(got) == 9
    assert [(r[0], str(r[2]), r[5], r[6]) for r in got if r[0] == "F-24"] == [
        ("F-24", "2013-06-10", 30.5, 16.25), ("F-24", "2013-06-11", 28.0, 15.25)]
    assert got[0] == ("F-11", "2001.csv", dt.date(2013, 3, 4), 40.125, -7.5, 14.5, 5.25)


def test_summary(sample, daily):
    out = weather.weather_summary(weather.weather_detail(weather.incident_spans(sample), daily))
    got = {r.incident_id: r for r in out.collect()}
    assert len(got) == 8
    long = got["F-24"]
    assert (long.start_date, long.end_date, long.n_days) == (dt.date(2013, 6, 10), dt.date(2013, 6, 11), 2)
    assert long.mean_temp_max == pytest.approx(29.25) and long.mean_temp_min == pytest.approx(15.75)
    assert (got["F-12"].mean_temp_max, got["F-12"].mean_temp_min) == (19.0, 8.5)
    assert sorted(got) == ["F-11", "F-12", "F-13", "F-21", "F-22", "F-23", "F-24", "F-25"]


def incident(**cells):
    base = {"id": "x", "LAT": "37.0", "LON": "-8.0", "source_file": "f"}
    return tuple({**base, **cells}.get(c) for c in (*COLUMNS, "source_file"))


@pytest.mark.parametrize("cells, span", [
    (dict(DHINICIO="02-07-2001 12:59:00", DHFIM="03-07-2001 02:39:00"), ("2001-07-02", "2001-07-03")),
    (dict(DHINICIO="02/07/2001 12:59", DHFIM=""), ("2001-07-02", "2001-07-02")),
    (dict(DHINICIO=" ", DATAALERTA="02-07-2001", HORAALERTA="23:10", DATAEXTINCAO="04-07-2001"), ("2001-07-02", "2001-07-04")),
    (dict(DHINICIO=None, DATAALERTA="02-07-2001", DATAEXTINCAO="-"), ("2001-07-02", "2001-07-02")),
    (dict(DHINICIO="not a date", DATAALERTA="02-07-2001"), None),
    (dict(DHFIM="03-07-2001 02:39:00"), None),
    (dict(DHINICIO="02-07-2001", LAT=""), None), (dict(DHINICIO="02-07-2001", LON="x"), None), (dict(DHINICIO="02-07-2001", id=" "), None),
])
def test_spans(spark, cells, span):
    df = spark.createDataFrame([incident(**cells)], ", ".join(f"{c} string" for c in (*COLUMNS, "source_file")))
    got = [(str(r.start_date), str(r.end_date)) for r in weather.incident_spans(df).collect()]
    assert got == ([span] if span else [])


def test_end_before_start_gives_no_day(spark):
    df = spark.createDataFrame([incident(DHINICIO="05-07-2001", DHFIM="03-07-2001")], ", ".join(f"{c} string" for c in (*COLUMNS, "source_file")))
    assert weather.incident_days(weather.incident_spans(df)).count() == 0


def test_weather_by_cell(sample, daily):
    step = 0.25
    spans = spatial.snap_to_weather_cell(weather.incident_spans(sample), step)
    cells = spatial.snap_to_weather_cell(daily, step).groupBy("cell_lat", "cell_lon", "date").agg(
        F.max("temp_max").alias("temp_max"), F.min("temp_min").alias("temp_min"))
    got = weather.weather_detail(spans, cells, {"cell_lat": "cell_lat", "cell_lon": "cell_lon"})
    assert got.count() == 9


def test_unreadable_temperatures_are_ignored(spark):
    df = spark.createDataFrame(
        [("i", "f", dt.date(2001, 1, 1), None, None, float("nan"), 1.0), ("i", "f", dt.date(2001, 1, 2), 3.0, 4.0, 10.0, None)],
        "incident_id string, source_file string, date date, lat double, lon double, temp_max double, temp_min double")
    row = weather.weather_summary(df).first()
    assert (row.mean_temp_max, row.mean_temp_min, row.n_days, row.lat, row.lon) == (10.0, 1.0, 2, 3.0, 4.0)
