import datetime as dt

import pytest
from pyspark.sql import functions as F

from cinderlake.operators import dimensions as dim
from cinderlake.operators import incremental as inc
from cinderlake.session import scratch_path

SCHEMA = "original_id string, year int, ts timestamp_ntz, v int, ingest_seq int"


def frame(spark, data):
    return spark.createDataFrame([(i, t.year, t, v, s) for i, t, v, s in data], SCHEMA)


DAY = dt.datetime
STORED = [("a", DAY(2001, 1, 5), 1, 0), ("b", DAY(2001, 12, 1), 2, 0), ("c", DAY(2002, 2, 2), 3, 0), ("d", DAY(2002, 3, 3), 4, 0)]
FRESH = [("c", DAY(2002, 2, 2), 30, 1), ("e", DAY(2002, 2, 9), 50, 1), ("e", DAY(2002, 2, 9), 51, 2), ("b", DAY(2001, 12, 1), 20, 1)]


def test_refresh_replaces_the_window_and_is_idempotent(spark, rows):
    stored, fresh = frame(spark, STORED), frame(spark, FRESH)
    once = inc.refresh(stored, fresh, dt.date(2002, 2, 1))
    # 'b' of the pull lies before the window; 'd' of the store was in it and was not pulled again
    assert rows(once, "original_id", "v") == [("a", 1), ("b", 2), ("c", 30), ("e", 51)]
    assert rows(inc.refresh(once.select(*fresh.columns), fresh, dt.date(2002, 2, 1))) == rows(once)


def test_keep_before_is_lexicographic(spark, rows):
    df = frame(spark, [("feb", DAY(2002, 2, 2), 1, 0), ("nov", DAY(2001, 11, 19), 1, 0), ("from", DAY(2001, 11, 20), 1, 0)])
    assert rows(inc.keep_before(df, "ts", dt.date(2001, 11, 20)), "original_id") == [("nov",)]


def test_last_write_wins_groups_null_ids(spark, rows):
    df = spark.createDataFrame([(2001, None, 1, "x"), (2001, None, 2, "y"), (2001, "a", 1, "z"), (2002, "a", 1, "w")],
                               "ANO int, original_id string, ingest_seq int, v string")
    assert rows(inc.last_write_wins(df), "ANO", "original_id", "v") == [(2001, "a", "z"), (2001, None, "y"), (2002, "a", "w")]


def test_concat_dedup(spark, rows):
    cols = "id string, v int"
    fresh = spark.createDataFrame([("a", 1), ("b", 2), ("b", 9)], cols)
    stored = spark.createDataFrame([("b", 7), ("c", 3), ("c", 4)], cols)
    assert rows(inc.concat_dedup(fresh, stored)) == [("a", 1), ("b", 2), ("c", 3)]
    none = spark.createDataFrame([], cols)
    assert rows(inc.concat_dedup(none, stored)) == [("b", 7), ("c", 3)]
    assert rows(inc.concat_dedup(fresh, none)) == [("a", 1), ("b", 2)]


def test_landed_periods():
    today = dt.date(2024, 3, 2)
    assert inc.landed_periods(today, 3) == [(2024, 3, 1), (2024, 2, 29), (2024, 2, 28)]
    assert inc.landed_periods(today, 30) == [(2024, 2, None), (2024, 3, None)]
    assert inc.landed_periods(today, 70)[0] == (2023, 12, None)
    assert len(inc.landed_periods(today, 10)) == 10


def test_upsert_keeps_the_creation_time(spark, rows):
    old, now = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)
    cols = "id int, v int, created_ts timestamp_ntz, updated_ts timestamp_ntz"
    stored = spark.createDataFrame([(1, 10, old, old), (2, 20, old, old)], cols)
    fresh = spark.createDataFrame([(2, 21, now, now), (3, 30, now, now)], cols)
    assert rows(inc.upsert(stored, fresh, ["id"], F.lit(now).cast("timestamp_ntz"))) == [
        (1, 10, old, old), (2, 21, old, now), (3, 30, now, now)]


def test_refresh_table_in_place(spark, rows):
    path = scratch_path(spark, "test-fact")
    frame(spark, STORED).write.partitionBy("year").parquet(path)
    fresh = frame(spark, [("b", DAY(2001, 12, 1), 20, 1)])
    inc.refresh_table(spark, path, fresh, dt.date(2001, 12, 1))
    # nothing was pulled for 2002, so that year is empty and gone
    assert rows(spark.read.parquet(path), "original_id", "v", "year") == [("a", 1, 2001), ("b", 20, 2001)]
    inc.refresh_table(spark, path, fresh, dt.date(2001, 12, 1))
    assert rows(spark.read.parquet(path), "original_id", "v", "year") == [("a", 1, 2001), ("b", 20, 2001)]


def test_dimension_growth(spark, rows):
    ref = spark.createDataFrame([(4, "florestal", "FOREST")], "id int, raw_name string, code string")
    df = spark.createDataFrame([("Florestal",), ("Queima",), ("QUEIMA",), ("Novo",), (None,)], "TIPO string")
    grown = dim.extend_dimension(df, "TIPO", ref)
    got = rows(grown)
    assert [r[0] for r in got] == [4, 5, 6] and {r[1] for r in got} == {"florestal", "queima", "novo"}
    codes = spark.createDataFrame([("queima", "WASTE_BURNING")], "raw_name string, code string")
    mapped = dim.map_codes(grown, codes)
    assert rows(mapped, "raw_name", "code") == [("florestal", "FOREST"), ("novo", None), ("queima", "WASTE_BURNING")]
    decoded = dim.decode(dim.lookup_id(df, "TIPO", mapped, "type_id"), "type_id", mapped, "code")
    assert rows(decoded, "TIPO", "code") == [
        ("Florestal", "FOREST"), ("Novo", None), ("QUEIMA", "WASTE_BURNING"), ("Queima", "WASTE_BURNING"), (None, None)]


def test_numbering_is_dense_and_repeatable(spark, rows):
    df = spark.range(5000).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("raw_name"))
    first = rows(dim.number_rows(df, "raw_name", 10), "raw_name", "id")
    assert sorted(i for _, i in first) == list(range(10, 5010))
    assert rows(dim.number_rows(df.repartition(7), "raw_name", 10), "raw_name", "id") == first


def test_known_code_tables():
    from cinderlake import schema

    sizes = {name: len(schema.parse_codes(text)) for name, text in schema.CODE_TABLES.items()}
    assert sizes == {"cause": 20, "fire_type": 3, "cause_type": 5, "alarm_source": 30}
    assert len(schema.OCCURRENCE_COLUMNS) == 77 and len(set(schema.OCCURRENCE_COLUMNS)) == 77


def test_backfill(spark, rows):
    df = spark.createDataFrame([(1, "old"), (2, "old")], "raw_id int, v string")
    source = spark.createDataFrame([(1, "new")], "id int, v string")
    assert rows(inc.backfill(df, source, ("raw_id", "id"), ["v"])) == [(1, "new"), (2, None)]


@pytest.mark.parametrize("share", [0.34])
def test_hot_key_is_reduced_before_the_shuffle(spark, share):
    df = spark.range(3000).select(
        F.when(F.col("id") < int(3000 * share), 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq"), F.lit(1).alias("v"))
    plan = inc.pick_per_key(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(" in plan and "Window" not in plan
