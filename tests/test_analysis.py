import datetime as dt

import pytest
from pyspark.sql import functions as F

from cinderlake.plans import analysis as an

T = dt.datetime


@pytest.fixture(scope="module")
def fact(spark):
    data = [(1, 2001, T(2001, 1, 5), "p1", 10.0), (2, 2001, T(2001, 7, 5), "p1", 30.0), (3, 2002, T(2002, 7, 6), "p2", None),
            (4, 2002, T(2002, 7, 6), "p2", 500.0), (5, 2002, T(2002, 12, 31), "zz", 7.0), (6, 2003, T(2003, 7, 6), "p1", 1.0)]
    return spark.createDataFrame(data, "id int, year int, ts timestamp_ntz, id_rel_lau string, total_area double")


@pytest.fixture(scope="module")
def flat(spark):
    return spark.createDataFrame([("p1", "P1", "m1", "M1", "d1", "D1"), ("p2", "P2", "m2", "M2", "d1", "D1")],
                                 "lau3_code string, lau3 string, lau2_code string, lau2 string, lau1_code string, lau1 string")


def test_rollup_levels(fact, flat, rows):
    got = rows(an.unit_rollup(fact, flat), "level", "lau1_code", "lau2_code", "fires")
    assert (0, None, None, 6) in got and (1, "d1", None, 5) in got and (2, "d1", "m1", 3) in got and (3, "d1", "m2", 2) in got
    assert (1, None, None, 1) in got  # fires outside every district


def test_ratios(fact, flat, spark, rows):
    areas = spark.createDataFrame([("d1", 1000.0)], "lau1_code string, area double")
    assert rows(an.share_of_area(fact, flat, areas), "lau1_code", "burned_percent") == [("d1", 54.1), (None, None)]
    assert rows(an.density(fact, flat, areas), "lau1_code", "fires_per_km2") == [("d1", 5000.0), (None, None)]


def test_time_views(fact, flat, rows):
    assert ("winter",) in rows(an.season_week_counts(fact), "season")
    heat = an.month_region_heatmap(fact, flat)
    assert heat.columns == ["lau1_code", *[f"m{i}" for i in range(1, 13)]]
    assert rows(heat, "lau1_code", "m1", "m7", "m12") == [("d1", 1, 4, 0), (None, 0, 0, 1)]
    trend = rows(an.yearly_trend(fact), "year", "fires", "change", "slope")
    assert [t[:3] for t in trend] == [(2001, 2, None), (2002, 3, 1), (2003, 1, -2)]
    assert trend[0][3] == pytest.approx(-0.5)


def test_bands(fact, rows):
    sizes = an.size_classes(fact, [10.0, 100.0], ["small", "medium", "large"])
    assert rows(sizes, "year", "size_class", "fires") == [
        (2001, "medium", 2), (2002, "large", 1), (2002, "small", 1), (2002, None, 1), (2003, "small", 1)]
    warm = fact.withColumn("t", F.lit(-0.5))
    assert rows(an.temperature_bands(warm, "t", 5.0, severity=F.col("total_area") * 2), "band", "fires") == [(-5.0, 6)]
    with pytest.raises(ValueError):
        an.labelled_band("t", [1.0], ["only one"])


def test_before_after(spark, rows):
    d = dt.date(2020, 5, 10)
    moments = spark.createDataFrame([(1, "a", d), (2, "b", d)], "id int, key string, day date")
    series = spark.createDataFrame([("a", d - dt.timedelta(1), 2.0), ("a", d - dt.timedelta(2), 4.0), ("a", d, 99.0),
                                    ("a", d + dt.timedelta(2), 8.0), ("a", d + dt.timedelta(3), 50.0), ("a", d + dt.timedelta(1), None)],
                                   "key string, day date, v double")
    got = an.before_after(moments, series, id_column="id", key="key", day="day", value="v", width=2)
    assert rows(got) == [(1, 3.0, 8.0), (2, None, None)]


def test_share_correlation_and_top(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 3.0, 6.0), ("b", 5.0, None)], "k string, x double, y double")
    assert rows(an.conditional_share(df, ["k"], F.col("x") > 1, "s", weight=F.col("x"))) == [("a", pytest.approx(5 / 6)), ("b", 1.0)]
    assert rows(an.correlation(df, ["k"], "x", "y")) == [("a", pytest.approx(1.0)), ("b", None)]
    top = an.top_by_group(df, ["k"], [F.desc("x")], 2)
    assert rows(top, "k", "x", "rank") == [("a", 2.0, 2), ("a", 3.0, 1), ("b", 5.0, 1)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_monthly_counts_add_up_to_yearly(spark, rows):
    from cinderlake.plans.dashboard import event_counts

    fact = spark.range(500).select(
        F.col("id"), (F.lit(2001) + F.col("id") % 3).cast("int").alias("year"),
        F.make_timestamp_ntz((F.lit(2001) + F.col("id") % 3).cast("int"), (F.col("id") % 12 + 1).cast("int"), F.lit(3), F.lit(1), F.lit(0), F.lit(0)).alias("ts"),
        F.concat(F.lit("p"), (F.col("id") % 4).cast("string")).alias("id_rel_lau"), F.lit(100.0).alias("total_area"))
    flat = spark.createDataFrame([("p1", "d1"), ("p2", "d2")], "lau3_code string, lau1_code string")
    monthly = event_counts(fact, flat, "monthly").groupBy("year", "lau1_code").agg(F.sum("count").alias("count"))
    assert rows(monthly, "year", "lau1_code", "count") == rows(event_counts(fact, flat), "year", "lau1_code", "count")
