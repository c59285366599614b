import datetime as dt

from pyspark.sql import functions as F

from cinderlake.session import scratch_path
from cinderlake.streaming import live

SCHEMA = "event_id long, ts timestamp, kind string, v int"


def land(spark, path, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/{name}")


def stream_of(spark, path):
    return spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(path)


def at(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def test_partial_counts_survive_a_second_run(spark, rows):
    src, out, mark = (scratch_path(spark, f"test-{n}") for n in ("src", "out", "mark"))
    land(spark, src, [(1, at(1), "a", 1), (2, at(1), "a", 1)], "one")
    land(spark, src, [(3, at(1), "a", 1), (4, at(2), "b", 1)], "two")
    def hourly(batch):
        return batch.withColumn("hour", F.hour("ts"))
    live.write_partial_counts(stream_of(spark, src), ["hour", "kind"], out, mark, hourly).awaitTermination()
    land(spark, src, [(5, at(2), "b", 1)], "three")
    live.write_partial_counts(stream_of(spark, src), ["hour", "kind"], out, mark, hourly).awaitTermination()
    got = live.total_counts(spark, ["hour", "kind"], out, "hour int, kind string, count bigint")
    assert rows(got) == [(1, "a", 3), (2, "b", 2)]


def test_arrivals_give_the_last_write(spark, rows):
    src, out, mark = (scratch_path(spark, f"test-{n}") for n in ("src", "out", "mark"))
    land(spark, src, [(1, at(1), "a", 10), (2, at(1), "a", 20)], "one")
    live.write_arrivals(stream_of(spark, src), out, mark).awaitTermination()
    land(spark, src, [(1, at(1), "a", 11)], "two")
    live.write_arrivals(stream_of(spark, src), out, mark).awaitTermination()
    arrivals = spark.read.schema(SCHEMA + ", ingest_seq long").parquet(out)
    assert rows(live.current_rows(arrivals, ["event_id"], ["ts", "v"]), "event_id", "v") == [(1, 11), (2, 20)]


def test_windowed_counts_with_watermark(spark):
    src, mark = scratch_path(spark, "test-src"), scratch_path(spark, "test-mark")
    land(spark, src, [(1, at(1, 5), "a", 1), (2, at(1, 50), "a", 1), (3, at(4), "a", 1), (3, at(4), "a", 1)], "one")
    stream = live.drop_repeats(stream_of(spark, src), "event_id", "ts", "2 hours")
    counts = stream.groupBy(F.window("ts", "1 hour").alias("w"), "kind").agg(F.count(F.lit(1)).alias("count"))
    q = counts.writeStream.outputMode("append").format("memory").queryName("win").option(
        "checkpointLocation", mark).trigger(availableNow=True).start()
    q.awaitTermination()
    q = live.windowed_counts(stream_of(spark, src), "ts", "1 hour", "1 hour", ["kind"]).writeStream.outputMode("complete") \
        .format("memory").queryName("live_counts").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r["start"].hour, r["count"]) for r in spark.sql("SELECT * FROM live_counts").collect())
    assert got == [(1, 2), (4, 2)]


def test_upserts_keep_the_last_row_over_batches(spark, tmp_path, rows):
    source, schema = tmp_path / "in", "year int, k string, seq int, v string"
    source.mkdir()
    table = scratch_path(spark, "test-upsert")
    mark = scratch_path(spark, "test-upsert-mark")
    for part in ([(2001, "a", 1, "old"), (2002, "b", 1, "x")], [(2001, "a", 2, "new"), (2001, "a", 0, "late"), (2003, "c", 1, "y")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(source / "t"))
        stream = spark.readStream.schema(schema).parquet(str(source / "t"))
        live.write_upserts(stream, table, mark, ["year", "k"], ["seq"]).awaitTermination()
    assert rows(spark.read.parquet(table), "year", "k", "v") == [(2001, "a", "new"), (2002, "b", "x"), (2003, "c", "y")]
