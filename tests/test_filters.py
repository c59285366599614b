from pyspark.sql import functions as F
from samples import occurrences

from cinderlake.operators import filters as f


def test_default_chain_on_the_sample(spark, rows):
    assert rows(f.default_chain().apply(occurrences(spark)), "id") == [("F-21",), ("F-24",)]


def test_missing_values_follow_the_documented_rules(spark, rows):
    data = [
        ("null flag", None, "37,1", "-8,1", "1", "Florestal"), ("float flag", "1.0", "37", "-8", "1", "Florestal"),
        ("lower flag", "sim", "37", "-8", "1", "Florestal"), ("zero pair", "0", "0", "0,0", "1", "Florestal"),
        ("one zero", "0", "0", "-8", "1", "Florestal"), ("no lat", "0", None, "-8", "1", "Florestal"),
        ("nan lat", "0", "nan", "-8", "1", "Florestal"), ("null area", "0", "37", "-8", None, "Florestal"),
        ("bad area", "0", "37", "-8", "n/d", "Florestal"), ("comma area", "0", "37", "-8", "0,49", "Florestal"),
        ("edge area", "0", "37", "-8", "0,5", "Florestal"), ("null type", "0", "37", "-8", "1", None),
        ("burn", "0", "37", "-8", "1", "QUEIMADA"), ("burn lower", "0", "37", "-8", "1", "queimada"),
        ("farm", "0", "37", "-8", "1", "Agrícola"),
    ]
    df = spark.createDataFrame(data, "id string, FALSOALARME string, LAT string, LON string, AREATOTAL string, TIPO string")
    kept = {r[0] for r in f.default_chain().apply(df).select("id").collect()}
    assert kept == {"null flag", "float flag", "one zero", "null area", "bad area", "edge area", "null type", "burn lower"}


def test_filters_without_their_columns_keep_everything(spark):
    df = spark.createDataFrame([("a",)], "id string")
    chain = f.FilterChain().add(f.drop_false_alarms()).add(f.drop_missing_coordinates()).add(f.drop_small_areas())
    assert chain.apply(df).count() == 1


def test_report_counts_each_step_once(spark, rows):
    chain = f.FilterChain().add(f.drop_small_areas(0.01)).add(f.drop_small_areas(0.03)).add(
        f.custom("id", "keeps ids ending in 1", lambda d: d.filter(F.col("id").endswith("1")))).add(f.drop_small_areas(0.5))
    got = rows(chain.report(occurrences(spark)), "step", "filter", "removed", "original")
    assert got == [(1, "small_area", 2, 8), (2, "small_area", 1, 8), (3, "id", 3, 8), (4, "small_area", 1, 8), (5, "total", 7, 8)]
    assert chain.apply(occurrences(spark)).count() == 1


def test_report_ending_in_a_custom_filter_and_on_no_rows(spark, rows):
    chain = f.FilterChain().add(f.drop_small_areas(0.5)).add(f.custom("none", "drops all", lambda d: d.filter("false")))
    assert rows(chain.report(occurrences(spark)), "removed") == [(2,), (6,), (8,)]
    empty = chain.report(occurrences(spark).filter("false"))
    assert rows(empty, "removed", "removed_share") == [(0, None), (0, None), (0, None)]


def test_chain_is_one_scan_filter(spark):
    plan = f.default_chain().apply(occurrences(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") <= 1
