import os

import pytest

from cinderlake import schema
from cinderlake.session import scratch_path
from cinderlake.sources import lookups, occurrences as occ, sinks


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "2001.csv").write_bytes("id| LOCAL |TIPO\nA1|São João|Florestal\nA2|NA|-\nA3|n/a|Agrícola\n".encode("utf-8"))
    (tmp_path / "2002.csv").write_bytes("id| LOCAL |TIPO\nB1|São João|Florestal\nB2|plain|x\n".encode("latin-1"))
    (tmp_path / "notes.txt").write_text("not a table")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "2003.csv").write_bytes(b"id| LOCAL |TIPO\nC1|x|y\n")
    return str(tmp_path)


def test_encoding_is_chosen_per_file(spark, folder, rows):
    df = occ.read_pipe_csv(spark, folder, pattern="*.csv")
    assert df.columns == ["id", "LOCAL", "TIPO", "source_file"]
    assert rows(df) == [
        ("A1", "São João", "Florestal", "2001.csv"), ("A2", None, None, "2001.csv"), ("A3", None, "Agrícola", "2001.csv"),
        ("B1", "São João", "Florestal", "2002.csv"), ("B2", "plain", "x", "2002.csv")]


def test_recursive_and_fixed_encoding(spark, folder, rows):
    df = occ.read_pipe_csv(spark, folder, pattern="*.csv", recursive=True, encoding="ISO-8859-1", na_tokens=False)
    assert ("C1", "x", "y", "2003.csv") in rows(df) and df.count() == 6
    assert ("A2", "NA", "-", "2001.csv") in rows(df)


def test_header_must_match_given_columns(spark, folder):
    with pytest.raises(Exception):
        occ.read_pipe_csv(spark, folder, pattern="*.csv", columns=["id", "TIPO", "LOCAL"]).collect()


def test_xml(spark, tmp_path, rows):
    (tmp_path / "a.xml").write_text(
        '<CODIGOS><OCC id="X1"><TIPO>Florestal</TIPO><LOCAL>|</LOCAL></OCC><OCC id="X2"><LOCAL>a|b</LOCAL></OCC></CODIGOS>')
    (tmp_path / "b.xml").write_text(f"<p>{schema.NO_DATA_MARKER}</p>")
    df = occ.read_occurrence_xml(spark, str(tmp_path), "OCC")
    assert df.columns == schema.OCCURRENCE_COLUMNS
    assert rows(df, "id", "TIPO", "LOCAL") == [("X1", "Florestal", "/"), ("X2", None, "a|b")]


def test_typed_and_quarantined(spark, rows):
    cols = "id string, ANO string, AREATOTAL string, NCCO string, LOCAL string"
    text = spark.createDataFrame([("1", "2001", "0.5", "77", "x"), ("2", "2001.5", "1e-4", "", ""), ("3", "2001", "abc", "z", None)], cols)
    typed = occ.typed_occurrences(text)
    assert dict(typed.dtypes) == {
        "original_id": "string", "ANO": "int", "AREATOTAL": "double", "NCCO": "bigint", "LOCAL": "string",
        "bad_columns": "array<string>"}
    assert rows(occ.accepted(typed)) == [("1", 2001, 0.5, 77, "x")]
    bad = {r["original_id"]: r["bad_columns"] for r in occ.quarantined(typed).collect()}
    assert bad == {"2": ["ANO"], "3": ["AREATOTAL", "NCCO"]}


def test_weather_json(spark, tmp_path, rows):
    (tmp_path / "w.json").write_text(
        '{"latitude": 37.3, "longitude": -8.3, "daily": {"time": ["2001-07-02", "2001-07-03"],'
        ' "temperature_2m_max": [32.7], "temperature_2m_min": [20.3, 17.1, 1.0]}}')
    got = [(str(r[2]), r[3], r[4]) for r in lookups.daily_weather(lookups.read_weather_json(spark, str(tmp_path))).collect()]
    assert sorted(got) == [("2001-07-02", 32.7, 20.3), ("2001-07-03", None, 17.1)]


def test_places(spark, rows):
    gaz = spark.createDataFrame([("Faro", "PT", 37.0, -7.9, 1), ("Faro", "BR", -2.1, -56.7, 2)],
                                "name string, country string, lat double, lon double, rank int")
    asked = spark.createDataFrame([("Faro", "BR"), ("Faro", "PT"), ("Nowhere", "PT")], "place string, land string")
    assert rows(lookups.place_coordinates(asked, gaz, "place"), "land", "lat") == [("BR", 37.0), ("PT", 37.0), ("PT", None)]
    assert rows(lookups.place_coordinates(asked, gaz, "place", "land"), "land", "lat") == [("BR", -2.1), ("PT", 37.0), ("PT", None)]


def test_boundaries(spark, tmp_path, rows):
    (tmp_path / "b.json").write_text(
        '{"dicofre":"010101","freguesia":"F","concelho":"C","distrito":"D","rings":[[{"x":0,"y":0},{"x":1,"y":0},{"x":1,"y":1},{"x":0,"y":0}]]}')
    df = lookups.read_boundaries(spark, str(tmp_path), "json")
    assert rows(df, "dicofre", "rings")[0][1][0][2].x == 1.0


def test_pipe_sink_refuses_its_input(spark, folder, rows):
    df = occ.read_pipe_csv(spark, folder, pattern="*.csv")
    with pytest.raises(ValueError):
        sinks.write_pipe_csv(df, folder)
    out = scratch_path(spark, "test-pipe")
    sinks.write_pipe_csv(df, out)
    again = spark.read.option("sep", "|").option("header", "true").csv(out)
    assert rows(again, "id", "source_file") == rows(df, "id", "source_file")


def test_yearly_sink_sorts_ids_as_text(spark):
    df = spark.createDataFrame([("10", 2001), ("9", 2001), ("1", 2002)], "id string, ANO int").coalesce(1)
    out = scratch_path(spark, "test-yearly")
    sinks.write_yearly_csv(df, out)
    folder = out.removeprefix("file:")
    assert {n for n in os.listdir(folder) if n.startswith("ANO")} == {"ANO=2001", "ANO=2002"}
    files = sorted(n for n in os.listdir(f"{folder}/ANO=2001") if n.endswith(".csv"))
    ids = [line for n in files for line in open(f"{folder}/ANO=2001/{n}").read().split()[1:]]
    assert ids == ["10", "9"]


def test_fact_sink_replaces_only_its_years(spark, rows):
    out = scratch_path(spark, "test-fact")
    cols = "v int, ts timestamp_ntz, year int"
    import datetime as dt
    sinks.write_fact(spark.createDataFrame([(1, dt.datetime(2001, 1, 1), 2001), (2, dt.datetime(2002, 1, 1), 2002)], cols), out)
    sinks.write_fact(spark.createDataFrame([(3, dt.datetime(2002, 1, 2), 2002)], cols), out)
    assert rows(spark.read.parquet(out), "v", "year") == [(1, 2001), (3, 2002)]


def test_empty_weather_keeps_headers(spark):
    out = scratch_path(spark, "test-weather")
    sinks.write_weather(spark.createDataFrame([], schema.WEATHER_DETAIL), spark.createDataFrame([], schema.WEATHER_SUMMARY), out)
    back = spark.read.option("header", "true").csv(f"{out}/summary")
    assert back.columns[:2] == ["source_file", "incident_id"] and back.count() == 0


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id|LAT| LON \n1|x|y\n")
    (tmp_path / "b.csv").write_text("LON|id|LAT\ny2|2|x2\n")
    (tmp_path / "c d.csv").write_bytes("id|OBS\n3|água\n".encode("latin-1"))
    (tmp_path / "empty.csv").write_text("")
    rows = occ.read_pipe_csv(spark, str(tmp_path), pattern="*.csv")
    assert rows.columns == ["id", "LAT", "LON", "OBS", "source_file"]
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("1", "x", "y", None, "a.csv"), ("2", "x2", "y2", None, "b.csv"), ("3", None, None, "água", "c d.csv")]


def test_odd_file_names_stay_as_they_are(spark, tmp_path):
    names = ["c d.csv", "a%20b.csv", "ç+e.csv", "p%q.csv"]
    for n, name in enumerate(names):
        (tmp_path / name).write_text(f"id|X\n{n}|x\n")
    rows = occ.read_pipe_csv(spark, str(tmp_path)).select("id", "source_file").collect()
    assert sorted(map(tuple, rows)) == [(str(n), name) for n, name in enumerate(names)]
    found = [r["source_file"] for r in occ.find_files(spark, str(tmp_path), "*.csv").collect()]
    assert found == sorted(names)


def test_weather_replies_land_in_few_files(spark, tmp_path, monkeypatch):
    """One reply per user, a line each: no folder for each user."""
    from cinderlake.catalog import source_queries

    spark.range(400).selectExpr("id AS event_id", "timestamp_ntz'2020-01-01 05:00:00' + make_dt_interval(cast(id % 2 AS int)) AS ts",
                                "CASE WHEN id >= 4 THEN id div 4 END AS user_id", "'a' AS event_type", "cast(id AS double) AS value", "'{}' AS props") \
        .write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(source_queries, "scratch_path", lambda *_: f"{tmp_path}/landed")
    found = {(r["user_id"], str(r["date"])): (r["temp_max"], r["temp_min"]) for r in source_queries.weather_json_roundtrip(spark, str(tmp_path)).collect()}
    assert len(found) == 200 and found[7, "2020-01-01"] == (30.0, 28.0) and found[None, "2020-01-02"] == (None, 1.0)
    assert len(list((tmp_path / "landed").rglob("part-*"))) <= 8
