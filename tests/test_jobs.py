import datetime as dt

import pytest
from pyspark.sql import functions as F
from samples import COLUMNS, INCIDENTS, WEATHER
from test_spatial import PARISHES, RINGS
from test_warehouse import occurrence

from cinderlake import schema
from cinderlake.operators.geography import units_from_boundaries
from cinderlake.plans import jobs
from cinderlake.session import scratch_path
from cinderlake.sources.occurrences import find_files


def write_year(folder, year, *cells):
    lines = ["|".join(schema.OCCURRENCE_COLUMNS)]
    lines += ["|".join(c or "" for c in occurrence(**{"ANO": str(year), **x})) for x in cells]
    (folder / f"{year}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture
def sample_folder(tmp_path):
    rows = ["|".join(COLUMNS)] + [
        "|".join([i, "Florestal", "0", lat, lon, area, a, b, "", "", "", ""]) for i, area, a, b, lat, lon in INCIDENTS]
    (tmp_path / "2001.csv").write_text("\n".join(rows) + "\n")
    (tmp_path / "2002.csv").write_text("|".join(COLUMNS) + "\nZ1|QUEIMADA|0|37,1|-8,1|9|05-03-2002|||||\n")
    return tmp_path


def test_clean_files(spark, sample_folder, rows):
    out = scratch_path(spark, "test-clean")
    jobs.clean_files(spark, str(sample_folder), out)
    kept = spark.read.option("sep", "|").option("header", "true").csv(out)
    assert rows(kept, "id", "source_file") == [("F-21", "2001.csv"), ("F-24", "2001.csv")]


def test_extract_weather(spark, sample_folder, rows):
    daily = spark.createDataFrame(WEATHER, "date string, lat double, lon double, temp_max double, temp_min double") \
        .withColumn("date", F.col("date").cast("date"))
    out = scratch_path(spark, "test-weather")
    jobs.extract_weather(spark, str(sample_folder), daily, out)
    detail = spark.read.option("header", "true").csv(f"{out}/meteorology")
    summary = spark.read.option("header", "true").csv(f"{out}/summary")
    assert (detail.count(), summary.count()) == (9, 8)
    assert rows(summary.filter("incident_id = 'F-24'"), "start_date", "end_date", "n_days") == [("2013-06-10", "2013-06-11", "2")]


def test_build_and_refresh(spark, tmp_path, rows):
    parishes = spark.createDataFrame(PARISHES, f"code string, rings {RINGS}")
    source, store = tmp_path / "in", scratch_path(spark, "test-store")
    source.mkdir()
    write_year(source, 2001, dict(id="a"), dict(id="a", LOCAL="later row"), dict(id="b", AREATOTAL="oops"), dict(id="c", LON="70"))
    write_year(source, 2002, dict(id="d", MES="1"), dict(id="e", MES="5", TIPO="Queima"), dict(id="f", MES="6", TIPO=None))
    jobs.build_fact(spark, str(source), parishes, store, cell=0.5)
    fire = spark.read.parquet(f"{store}/fire")
    assert rows(fire, "original_id", "locality", "year") == [("a", "later row", 2001), ("d", None, 2002), ("e", None, 2002)]
    assert rows(spark.read.parquet(f"{store}/quarantine"), "original_id") == [("b",)]
    assert rows(spark.read.parquet(f"{store}/rejected"), "original_id") == [("f",)]
    first_ids = {r.raw_name: r.id for r in spark.read.parquet(f"{store}/ref/fire_type").collect()}
    assert set(first_ids) == {"florestal", "queima"}

    write_year(source, 2002, dict(id="d", MES="1", LOCAL="not loaded"), dict(id="g", MES="7", TIPO="Novo"))
    for _ in range(2):  # a second run changes nothing
        jobs.build_fact(spark, str(source), parishes, store, start=dt.date(2002, 3, 15), cell=0.5)
        fire = spark.read.parquet(f"{store}/fire")
        assert rows(fire, "original_id", "locality", "year") == [("a", "later row", 2001), ("d", None, 2002), ("g", None, 2002)]
    ids = {r.raw_name: r.id for r in spark.read.parquet(f"{store}/ref/fire_type").collect()}
    assert first_ids.items() <= ids.items() and set(ids) == {"florestal", "queima", "novo"} and len(set(ids.values())) == 3
    jobs.refresh_fact(spark, str(source), parishes, store, dt.date(2002, 8, 1), "weekly", cell=0.5)
    assert spark.read.parquet(f"{store}/fire").count() == 3

    # the source no longer has 2002: a window over that year empties it, a full load drops it too
    (source / "2002.csv").unlink()
    jobs.build_fact(spark, str(source), parishes, store, start=dt.date(2002, 1, 1), cell=0.5)
    assert rows(spark.read.parquet(f"{store}/fire"), "original_id", "year") == [("a", 2001)]
    write_year(source, 2003, dict(id="h"))
    (source / "2001.csv").unlink()
    jobs.build_fact(spark, str(source), parishes, store, cell=0.5)
    assert rows(spark.read.parquet(f"{store}/fire"), "original_id", "year") == [("h", 2003)]


def test_undated_rows_are_rejected_in_every_mode(spark, tmp_path, rows):
    parishes = spark.createDataFrame(PARISHES, f"code string, rings {RINGS}")
    source, store = tmp_path / "in", scratch_path(spark, "test-undated")
    source.mkdir()
    write_year(source, 2002, dict(id="a", MES="5"), dict(id="b", MES=None))
    for start in (None, dt.date(2002, 1, 1)):
        jobs.build_fact(spark, str(source), parishes, store, start=start, cell=0.5)
        assert rows(spark.read.parquet(f"{store}/fire"), "original_id") == [("a",)]
    # kept under each load that met them
    assert rows(spark.read.parquet(f"{store}/rejected"), "original_id", "load") == [("b", "2002-01-01"), ("b", "full")]


def test_a_refresh_reads_the_files_of_its_years_only(spark, tmp_path, rows):
    parishes = spark.createDataFrame(PARISHES, f"code string, rings {RINGS}")
    source, store = tmp_path / "in", scratch_path(spark, "test-years")
    source.mkdir()
    write_year(source, 2001, dict(id="a"))
    write_year(source, 2002, dict(id="b", MES="7", DIA="20"))
    jobs.build_fact(spark, str(source), parishes, store, cell=0.5)
    (source / "2001.csv").write_text("not|a|table\n1|2|3\n")
    write_year(source, 2002, dict(id="b", MES="7", DIA="20", LOCAL="seen again"))
    jobs.refresh_fact(spark, str(source), parishes, store, dt.date(2002, 8, 1), "weekly", cell=0.5)
    assert rows(spark.read.parquet(f"{store}/fire"), "original_id", "locality", "year") == [("a", None, 2001), ("b", "seen again", 2002)]


def test_a_fire_that_moves_into_the_window_is_kept_once(spark, tmp_path, rows):
    parishes = spark.createDataFrame(PARISHES, f"code string, rings {RINGS}")
    source, store = tmp_path / "in", scratch_path(spark, "test-moved")
    source.mkdir()
    write_year(source, 2002, dict(id="a", MES="1"), dict(id="b", MES="1"))
    jobs.build_fact(spark, str(source), parishes, store, cell=0.5)
    write_year(source, 2002, dict(id="a", MES="7"), dict(id="b", MES="1"))
    jobs.build_fact(spark, str(source), parishes, store, start=dt.date(2002, 6, 1), cell=0.5)
    assert [(r.original_id, r.ts.month) for r in spark.read.parquet(f"{store}/fire").orderBy("original_id").collect()] == [("a", 7), ("b", 1)]


def test_find_files(spark, sample_folder, rows):
    assert [r.source_file for r in find_files(spark, str(sample_folder), "*.csv").collect()] == ["2001.csv", "2002.csv"]
    assert find_files(spark, str(sample_folder / "missing")).count() == 0


def test_units_from_boundaries(spark, rows):
    df = spark.createDataFrame([(c, "p", "A", "N", r) for c, r in PARISHES if c.startswith("01")],
                               f"dicofre string, freguesia string, concelho string, distrito string, rings {RINGS}")
    assert rows(units_from_boundaries(df), "code", "level", "area") == [
        ("01", 1, 2.75), ("0101", 2, 2.0), ("010101", 3, 1.0), ("010102", 3, 1.0), ("0102", 2, 0.75), ("010201", 3, 0.75)]


def test_only_rows_of_shared_keys_are_compared(spark, tmp_path, rows, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    write_year(source, 2001, dict(id="a", LOCAL="a1"), dict(id="a", LOCAL="a2"), dict(id="b"), dict(id=None, LOCAL="n1"), dict(id=None, LOCAL="n2"), dict(id="c", AREATOTAL="oops"))
    write_year(source, 2002, dict(id="a", LOCAL="other year"), dict(id="d"), dict(id="d"))
    compared, pick = [], jobs.last_write_wins
    monkeypatch.setattr(jobs, "last_write_wins", lambda df, *order: compared.append(df.count()) or pick(df, *order))
    good, bad = jobs.typed_from_files(spark, str(source))
    assert rows(good, "ANO", "original_id", "LOCAL") == sorted(
        [(2001, "a", "a2"), (2001, "b", None), (2001, None, "n2"), (2002, "a", "other year"), (2002, "d", None)], key=lambda t: tuple((v is None, str(v)) for v in t))
    assert rows(bad, "original_id") == [("c",)] and compared == [6]
    (source / "2001.csv").unlink()
    write_year(source, 2002, dict(id="a"), dict(id="b"))
    assert rows(jobs.typed_from_files(spark, str(source))[0], "original_id") == [("a",), ("b",)] and compared == [6]
