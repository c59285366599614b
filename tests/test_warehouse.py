"""Conforming, layers and dashboards on a small hand-made warehouse."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_spatial import PARISHES, RINGS

from cinderlake import schema
from cinderlake.operators.geography import (
    flatten_geography, level2_units, level3_units, rollup_by_prefix)
from cinderlake.plans import conform, dashboard, layers
from cinderlake.sources.occurrences import accepted, typed_occurrences

T = dt.datetime


def occurrence(**cells):
    base = dict(
        ANO="2001", MES="7", DIA="2", HORA="12", TIPO="Florestal", AREATOTAL="11", LAT="0.5", LON="0.5", NCCO="22172",
        REACENDIMENTOS="0", AGRICOLA="1", DATAALERTA="02-07-2001", HORAALERTA="12:59", DATAEXTINCAO="03-07-2001",
        HORAEXTINCAO="02:39", FONTEALERTA="PV", TIPOCAUSA="Desconhecida", CAUSAFAMILIA="Indeterminadas",
        PRECEPITACAO="1.734723E-15", AREASFICHEIROS_GNR="a.kml", AREASFICHEIROZIP_SAA="b.zip", FICHEIROIMAGEM_GNR="c.png")
    return tuple({**base, **cells}.get(c) for c in schema.OCCURRENCE_COLUMNS)


@pytest.fixture(scope="module")
def conformed(spark):
    data = [
        occurrence(id="inside"), occurrence(id="border", LON="1.0", TIPOCAUSA="Novidade", FONTEALERTA=None),
        occurrence(id="nowhere", LON="50"), occurrence(id="no type", TIPO=None), occurrence(id="bad day", DIA="31", MES="2"),
        occurrence(id="old", ANO="1999", MES="12", DIA="31"), occurrence(id="fine grid", LAT="0.5000049"),
    ]
    text = spark.createDataFrame(data, schema.occurrence_schema())
    parishes = spark.createDataFrame(PARISHES, f"code string, rings {RINGS}")
    empty = spark.createDataFrame([], "id int, raw_name string, code string")
    return conform.conform(
        accepted(typed_occurrences(text)), parishes, {n: empty for n in schema.CODE_TABLES}, start=dt.date(2000, 2, 1), cell=0.5)


def test_fact_rows(conformed, rows):
    fact = conformed.fact
    assert fact.columns == conform.FACT_COLUMNS
    assert rows(fact, "original_id", "id_rel_lau") == [
        ("border", "010101"), ("border", "010102"), ("fine grid", "010101"), ("inside", "010101")]
    row = fact.filter("original_id = 'inside'").first()
    assert (row.year, row.ts, row.alarm_ts, row.extinguishing_ts, row.first_response_ts) == (
        2001, T(2001, 7, 2, 12), T(2001, 7, 2, 12, 59), T(2001, 7, 3, 2, 39), None)
    assert (row.total_area, row.rekindle, row.slash_and_burn, row.agricultural) == (110000.0, False, None, True)
    assert (row.precipitation, row.file_urls, row.cco_id) == (None, "a.kml,b.zip", "22172")
    assert fact.filter("original_id = 'fine grid'").first().lat == pytest.approx(0.5)


def test_keys_are_unique_and_layers_read_the_fact(conformed, spark, rows):
    ids = [r[0] for r in rows(conformed.fact, "id")]
    assert len(set(ids)) == 4 and "2001-border-010102" in ids
    flat = flatten_geography(spark.createDataFrame([("010101", None, "p1", 1.0, 3)], LAU_DDL))
    layer = layers.fire_layer(conformed.fact, flat, conformed.dimensions)
    assert rows(layer.filter("original_id = 'inside'"), "lau3", "fire_type", "cause", "cause_type", "alarm_source") == [
        ("p1", "FOREST", "UNDETERMINED", "UNKNOWN", "PV")]
    assert layer.columns[:2] == ["id", "original_id"] and set(layers.LAYER_COLUMNS) <= set(layer.columns)


def test_statistical_code_as_fallback(spark, rows):
    data = [occurrence(id="covered", INE="20101"), occurrence(id="outside", LON="50", INE="10102.0"),
            occurrence(id="unknown code", LON="50", INE="99"), occurrence(id="no point", LAT=None, INE="20101")]
    typed = accepted(typed_occurrences(spark.createDataFrame(data, schema.occurrence_schema())))
    parishes = spark.createDataFrame(PARISHES, f"code string, rings {RINGS}")
    empty = spark.createDataFrame([], "id int, raw_name string, code string")
    done = conform.conform(typed, parishes, {n: empty for n in schema.CODE_TABLES}, cell=0.5, use_ine=True)
    assert rows(done.fact, "original_id", "id_rel_lau") == [("covered", "010101"), ("no point", "020101"), ("outside", "010102")]


def test_incomplete_occurrences_are_handed_back(conformed, rows):
    assert rows(conformed.rejected, "original_id") == [("bad day",), ("no type",)]  # 31 February is no date


def test_dimensions(conformed, rows):
    assert rows(conformed.dimensions["cause_type"], "raw_name", "code") == [("desconhecida", "UNKNOWN"), ("novidade", None)]
    assert rows(conformed.dimensions["alarm_source"], "raw_name", "code") == [("pv", "PV")]
    assert conformed.fact.filter("original_id = 'border' AND id_ref_alarm_source IS NOT NULL").count() == 0


def test_reload_never_doubles(conformed, spark):
    fact = conformed.fact
    assert conform.reload(fact, fact, None).count() == 4
    assert conform.reload(fact, fact, dt.date(2001, 7, 2)).count() == 4
    assert conform.reload(fact, fact.limit(0), dt.date(2001, 7, 3)).count() == 4


LAU_DDL = "code string, code_parent string, name string, area double, level int"
LAU = [
    ("01", None, "North", 100.0, 1), ("02", None, "South", 50.0, 1), ("0101", "01", "N-a", 60.0, 2), ("0102", "01", "N-b", 40.0, 2),
    ("0201", "02", "S-a", 50.0, 2), ("010101", "0101", "p1", 30.0, 3), ("010201", "0102", "p2", 40.0, 3),
    ("020101", "0201", "p3", 50.0, 3), ("990101", "9901", "orphan", 1.0, 3),
]


@pytest.fixture(scope="module")
def lau(spark):
    return spark.createDataFrame(LAU, LAU_DDL)


@pytest.fixture(scope="module")
def fact(spark):
    a = T(2001, 7, 2, 12)
    data = [  # id, parish, area, first response minutes, extinction minutes
        (1, "010101", 100.0, 10, 100), (2, "010101", None, 20, 200), (3, "010101", 10.0, 30, 300), (4, "010201", 50.0, 40, 400),
        (5, "020101", 11.0, None, 30), (6, "990101", 99.0, 5, 50), (7, "888888", 99.0, 5, 50), (8, "010201", 60.0, 0, 10),
    ]
    rows = [(i, str(i), 2001, p, a, area, a, None if r is None else a + dt.timedelta(minutes=r), a + dt.timedelta(minutes=e), i % 2)
            for i, p, area, r, e in data]
    return spark.createDataFrame(
        rows, "id int, original_id string, year int, id_rel_lau string, ts timestamp_ntz, total_area double, alarm_ts timestamp_ntz, "
              "first_response_ts timestamp_ntz, extinguishing_ts timestamp_ntz, id_ref_cause_type int")


def test_hierarchy(lau, rows):
    flat = flatten_geography(lau)
    assert ("orphan", None, None) in rows(flat, "lau3", "lau2", "lau1") and flat.count() == 4
    assert rows(level2_units(lau), "code", "parent_name") == [("0101", "North"), ("0102", "North"), ("0201", "South")]
    assert rows(level3_units(lau), "code", "grand_parent_name") == [("010101", "North"), ("010201", "North"), ("020101", "South")]


def test_prefix_rollup(spark, rows):
    df = spark.createDataFrame([("010101", "p1", "A", "N", 1.0), ("010101", "p1", "A", "N", 2.0), ("010201", "p2", "B", "N", 4.0)],
                               "dicofre string, freguesia string, concelho string, distrito string, area double")
    assert rows(rollup_by_prefix(df)) == [
        ("01", None, "N", 1, 7.0), ("0101", "01", "A", 2, 3.0), ("010101", "0101", "p1", 3, 3.0),
        ("0102", "01", "B", 2, 4.0), ("010201", "0102", "p2", 3, 4.0)]


def test_counts_keep_unknown_areas_and_districts(fact, lau, rows):
    flat = flatten_geography(lau)
    assert rows(dashboard.event_counts(fact, flat), "lau1_code", "count") == [("01", 4), ("02", 1), (None, 2)]
    monthly = dashboard.event_counts(fact, flat, "monthly")
    assert rows(monthly, "month", "lau1_code", "count") == [(7, "01", 4), (7, "02", 1), (7, None, 2)]
    assert rows(dashboard.event_counts(fact, flat, "hourly"), "hour", "count") == [(12, 1), (12, 2), (12, 4)]


def test_areas_drop_unknown_and_small(fact, lau, rows):
    flat = flatten_geography(lau)
    got = dashboard.area_distribution(fact, flat)
    assert rows(got, "lau1_code", "total_area", "min_area", "p25_area", "median_area", "p75_area", "max_area") == [
        ("01", 210.0, 50.0, 55.0, 60.0, 80.0, 100.0), ("02", 11.0, 11.0, 11.0, 11.0, 11.0, 11.0),
        (None, 198.0, 99.0, 99.0, 99.0, 99.0, 99.0)]
    total = dashboard.area_totals(fact, flat).agg(F.sum("total_area")).first()[0]
    assert total == 419.0


def test_causes(fact, lau, spark, rows):
    types = spark.createDataFrame([(0, "NATURAL")], "id int, code string")
    got = dashboard.cause_counts(fact, flatten_geography(lau), types)
    assert rows(got, "lau1_code", "cause_type_code", "count", "area") == [
        ("01", "NATURAL", 2, 110.0), ("01", None, 1, 100.0), ("02", None, 1, 11.0), (None, "NATURAL", 1, 99.0), (None, None, 1, 99.0)]


def test_durations_lose_fires_without_district(fact, lau, rows):
    flat = flatten_geography(lau)
    # the fire answered at once is not strictly ordered; the small one is not shown
    assert rows(dashboard.response_time(fact, flat), "lau1_code", "min", "median", "max") == [("01", 6e5, 12e5, 24e5)]
    assert [r[0] for r in rows(dashboard.total_duration(fact, flat), "lau1_code")] == ["01", "02"]
    assert rows(dashboard.firefighting_duration(fact, flat), "lau1_code", "min", "max") == [("01", 6e5, 216e5)]
    open_ended = dashboard.untrimmed_duration(fact, flat, "alarm_ts", "extinguishing_ts")
    assert [r[0] for r in rows(open_ended, "lau1_code")] == ["01", "02", None]


def test_layer_and_summaries(fact, lau, spark, rows):
    flat = flatten_geography(lau)
    types = spark.createDataFrame([(0, "NATURAL")], "id int, code string")
    layer = layers.fire_layer(fact, flat, {"cause_type": types})
    assert layer.count() == 8 and rows(layer.filter("id = 4"), "lau3", "lau1", "cause_type") == [("p2", "North", "NATURAL")]
    shapes = spark.createDataFrame([(1, 0, [[(0.0, 0.0)]], 4.0), (1, 1, [[(0.0, 0.0)]], 2.0)],
                                   f"fire_id int, part int, rings {RINGS}, area double")
    assert rows(layers.perimeter_layer(layer, shapes), "id", "part", "part_area") == [(1, 0, 4.0), (1, 1, 2.0)]
    units = lau.filter("level = 2").select("code", "area")
    inner = layers.area_summary(fact, flat, 2, units)
    assert rows(inner, "code", "month", "count", "area") == [("0101", 7, 3, 60.0), ("0102", 7, 2, 40.0), ("0201", 7, 1, 50.0)]
    more = units.unionByName(spark.createDataFrame([("0309", 9.0)], "code string, area double"))
    assert rows(layers.area_summary(fact, flat, 2, more, keep_empty=True), "code", "count")[-1] == ("0309", 0)
    assert rows(layers.summary_of_year(layers.area_summary(fact, flat, 1), 1, 2001), "lau1", "count") == [("North", 5), ("South", 1)]


def test_newest_first(fact):
    assert [r.id for r in layers.newest_first(fact, 2001, dt.date(2001, 7, 1), limit=3).collect()] == [1, 2, 3]
    assert layers.newest_first(fact, 2001, dt.date(2001, 7, 3)).count() == 0


def test_first_and_last_known(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, "y"), ("a", 4, None), ("b", 1, None)], "k string, o int, v string")
    got = {r.k: (r.f, r.l) for r in df.groupBy("k").agg(
        layers.first_known("v", "o").alias("f"), layers.last_known("v", "o").alias("l")).collect()}
    assert got == {"a": ("x", "y"), "b": (None, None)}


def test_flags_and_units(spark, rows):
    df = spark.createDataFrame([("f1", "SIM", 2.0), ("f1", "x", 4.0), ("f2", "0", 5000.0), ("f2", None, 20000.0)], "file string, QUEIMA string, v double")
    assert rows(conform.with_flags(df), "file", "QUEIMA") == [("f1", True), ("f1", None), ("f2", False), ("f2", None)]
    assert rows(conform.infer_unit(df, "v", "file", 1000.0, 1e-4, "ha"), "file", "ha") == [
        ("f1", 2.0), ("f1", 4.0), ("f2", 0.5), ("f2", 2.0)]
