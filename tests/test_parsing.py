import datetime as dt

import pytest
from pyspark.sql import functions as F

from cinderlake.functions import parsing as p


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column.alias("v")).first()[0]


@pytest.mark.parametrize("text, expected", [
    ("0,5", 0.5), ("0.693", 0.693), (" 11 ", 11.0), ("9.09090909090909E-04", 9.09090909090909e-4), ("-8,5", -8.5),
    ("1.234,5", None), ("n/d", None), ("", None), (None, None), ("nan", None), ("1d", None), ("0x1p3", None), ("+.5", 0.5),
])
def test_num(spark, text, expected):
    assert one(spark, p.num("c"), text) == expected


@pytest.mark.parametrize("text, expected", [
    ("18-02-2001 13:20:00", dt.datetime(2001, 2, 18, 13, 20)), ("18/02/2001 13:20", dt.datetime(2001, 2, 18, 13, 20)),
    ("2001-02-18 13:20:00", dt.datetime(2001, 2, 18, 13, 20)), ("18-02-2001", dt.datetime(2001, 2, 18)),
    ("31-02-2001 10:00", None), ("x", None), ("", None), (None, None), ("2001", None),
    ("1-7-2001 9:05", dt.datetime(2001, 7, 1, 9, 5)), ("25-03-2001 01:30", dt.datetime(2001, 3, 25, 1, 30)),
])
def test_wall_clock(spark, text, expected):
    assert one(spark, p.wall_clock("c"), text) == expected


def test_wall_clock_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Lisbon")
    try:
        # 01:30 did not exist there that night
        assert one(spark, p.wall_clock("c").cast("string"), "25-03-2001 01:30") == "2001-03-25 01:30:00"
        gap = F.lit("2001-03-25 03:00").cast("timestamp_ntz")
        assert one(spark, p.millis_between(p.wall_clock("c"), gap), "25-03-2001 00:00") == 3 * 3600 * 1000.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_day_and_time_needs_both(spark):
    df = spark.createDataFrame([("02-07-2001", "12:59"), ("02-07-2001", None), (None, "12:59")], "d string, t string")
    got = [r[0] for r in df.select(p.day_and_time("d", "t")).collect()]
    assert got == [dt.datetime(2001, 7, 2, 12, 59), None, None]


def test_hour_stamp_of_bad_parts(spark):
    df = spark.createDataFrame([(2001, 7, 2, 12), (2001, 2, 31, 1), (None, 1, 1, 1)], "y int, m int, d int, h int")
    got = [r[0] for r in df.select(p.hour_stamp(F.col("y"), F.col("m"), F.col("d"), F.col("h"))).collect()]
    assert got == [dt.datetime(2001, 7, 2, 12), None, None]


@pytest.mark.parametrize("text, expected", [
    ("SIM", True), ("sim", True), ("1", True), ("NAO", False), ("não", False), ("0", False), ("talvez", None), (None, None)])
def test_flag(spark, text, expected):
    assert one(spark, p.flag("c"), text) is expected


@pytest.mark.parametrize("text, expected", [("NA", None), ("-", None), ("", None), ("n/a", None), (" NA", " NA"), ("x", "x")])
def test_missing_tokens(spark, text, expected):
    assert one(spark, p.missing_to_null("c"), text) == expected


def test_small_helpers(spark):
    assert one(spark, p.snap("c"), 1.234567, "double") == pytest.approx(1.23457, abs=1e-12)
    assert one(spark, p.drop_sentinel("c"), 1.734723e-15, "double") is None
    assert one(spark, p.drop_sentinel("c"), 0.0, "double") == 0.0
    assert one(spark, p.file_name("c"), "http://h/a b/área 1.zip") == "%C3%A1rea%201.zip"
    urls = spark.createDataFrame([("a", None, "b"), (None, None, None), (None, "", None)], "x string, y string, z string")
    assert [r[0] for r in urls.select(p.joined_list(["x", "y", "z"])).collect()] == ["a,b", None, None]


def test_on_or_after_compares_whole_dates(spark):
    df = spark.createDataFrame([(2001, 2, 2), (2000, 11, 19), (2000, 11, 20), (2000, 12, 1), (None, 1, 1)], "y int, m int, d int")
    kept = df.filter(p.on_or_after(F.col("y"), F.col("m"), F.col("d"), dt.date(2000, 11, 20)))
    assert sorted(tuple(r) for r in kept.collect()) == [(2000, 11, 20), (2000, 12, 1), (2001, 2, 2)]
