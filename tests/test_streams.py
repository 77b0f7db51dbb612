import datetime as dt
import os
from dataclasses import replace

import pytest
from helpers import at, rows, scanned_files
from pyspark.sql import types as T
from test_files import put

from starloom.sources.files import text_schema
from starloom.sources.maintenance import compact_cluster
from starloom.sources.tables import Layout
from starloom.streaming import (
    alerts,
    read_alerts,
    stream_bronze,
    stream_evolving,
    stream_failed_runs,
    stream_files,
    stream_metric,
    stream_upsert,
    write_windows,
)
from starloom.streaming.bronze import read_raw
from starloom.streaming.upsert import CleansedTable

DAY = at("2024-01-01")


def test_each_file_is_taken_once(spark, tmp_path):
    folder, path, checkpoint = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "checkpoint")

    def drain():
        stream = stream_files(spark, str(folder), text_schema(["id", "v"]), stamp=DAY)
        stream_bronze(stream, path, checkpoint).awaitTermination()
        return rows(spark.read.parquet(path), "id", "v")

    put(folder, "a.csv", "id,v", "1,x")
    assert drain() == [("1", "x")] and drain() == [("1", "x")]
    put(folder, "b.csv", "id,v", "2,y")
    assert drain() == [("1", "x"), ("2", "y")]
    assert spark.read.parquet(path).where("_ingest_file LIKE '%b.csv'").count() == 1


def test_new_columns_are_added_wherever_they_appear(spark, tmp_path):
    folder, path, checkpoint = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    put(folder, "a.csv", "id,v", "1,x")
    stream_evolving(spark, str(folder), path, checkpoint, pattern="*.csv").awaitTermination()
    put(folder, "b.csv", "id,mid,v", "2,m,y")
    put(folder, "c.csv", "v,id", "z,3")
    stream_evolving(spark, str(folder), path, checkpoint, pattern="*.csv").awaitTermination()
    assert rows(read_raw(spark, path), "id", "v", "mid") == [("1", "x", None), ("2", "y", "m"), ("3", "z", None)]
    with pytest.raises(ValueError, match="another checkpoint"):
        stream_evolving(spark, str(folder), path, checkpoint + "-new")


def test_upsert_inserts_new_keys_once_even_when_replayed(spark, tmp_path):
    folder, layout = tmp_path / "in", Layout(str(tmp_path / "lake"))
    schema = text_schema(["id", "v"])
    target = CleansedTable(spark, layout, "things", schema)

    def drain(checkpoint):
        stream = stream_files(spark, str(folder), schema, stamp=DAY)
        stream_upsert(stream, target, ["id"], layout.checkpoint("silver", checkpoint)).awaitTermination()
        return rows(target.read())

    put(folder, "a.csv", "id,v", "1, a ", "1, b ", ",c")
    assert drain("main") == [("1", "b")]
    put(folder, "b.csv", "id,v", "1,z", "2,y")
    assert drain("main") == [("1", "b"), ("2", "y")]
    assert drain("main") == drain("replay") == [("1", "b"), ("2", "y")]


def test_batch_that_died_before_its_marker_is_written_again(spark, tmp_path, text):
    target = CleansedTable(spark, Layout(str(tmp_path)), "things", text_schema(["id", "v"]))
    target.append_new(text("id v", ("1", "a")), ["id"], [])
    text("id v", ("2", "b")).write.parquet(target.table.rows_path(2))
    assert rows(target.read()) == [("1", "a")]
    assert target.append_new(text("id v", ("2", "b"), ("3", "c")), ["id"], []) == 2
    assert rows(target.read()) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_stream_that_runs_on(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "raw")
    put(folder, "a.csv", "id,v", "1,x")
    stream = stream_files(spark, str(folder), text_schema(["id", "v"]))
    running = stream_bronze(stream, path, str(tmp_path / "checkpoint"), seconds=1)
    try:
        running.processAllAvailable()
        put(folder, "b.csv", "id,v", "2,y")
        running.processAllAvailable()
        assert rows(spark.read.parquet(path), "id") == [("1",), ("2",)]
    finally:
        running.stop()


def test_batch_form_replaces_the_whole_table(spark, tmp_path, text):
    target = CleansedTable(spark, Layout(str(tmp_path)), "things", text_schema(["id", "v"]))
    target.append_new(text("id v", ("1", "a")), ["id"], [])
    target.replace_with(text("id v", ("2", " b "), ("2", "a")), ["id"], [], dt.datetime(2024, 1, 1))
    assert rows(target.read()) == [("2", "b")]
    target.append_new(text("id v", ("2", "z"), ("3", "c")), ["id"], [])
    assert compact_cluster(target.table, [], dt.datetime(2024, 1, 2), files=1, column="id") == 4
    assert rows(target.read()) == [("2", "b"), ("3", "c")]


@pytest.mark.parametrize("most", [1, 500])
def test_first_file_of_a_key_decides_whatever_a_batch_holds(spark, tmp_path, most):
    folder, layout, schema = tmp_path / "in", Layout(str(tmp_path / "lake")), text_schema(["id", "v"])
    for number, (name, lines) in enumerate([("b.csv", ["1,m", "1,n"]), ("a.csv", ["1,z", "2,y"])]):
        put(folder, name, "id,v", *lines)
        os.utime(folder / name, (1_700_000_000 + number, 1_700_000_000 + number))
    target = CleansedTable(spark, layout, "things", schema)
    stream = stream_files(spark, str(folder), schema, stamp=DAY, max_files=most)
    stream_upsert(stream, target, ["id"], layout.checkpoint("silver", "main")).awaitTermination()
    assert rows(target.read()) == [("1", "n"), ("2", "y")]
    with pytest.raises(ValueError, match="arrival"):
        stream_upsert(stream.select("id", "v"), target, ["id"], layout.checkpoint("silver", "other"))


def test_alerts_of_a_stream_come_at_once_and_count_late_rows(spark, tmp_path):
    base = dt.datetime(2024, 1, 1, 10)
    schema = "end_time timestamp, status string, v double"
    path = str(tmp_path / "runs")

    def alerts_after(name, windows_of, over, *data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(path)
        windows = windows_of(spark.readStream.schema(schema).parquet(path))
        write_windows(windows, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")).awaitTermination()
        found = read_alerts(spark, str(tmp_path / name), windows.schema, over).collect()
        return sorted((r.window_start.strftime("%H:%M"), r.measure) for r in found)

    failed = lambda rows: stream_failed_runs(rows, "end_time")
    last = (base + dt.timedelta(minutes=7), "FAILED", 90.0)
    assert alerts_after("failed", failed, 0, last, (base, "SUCCESS", 1.0)) == [("09:55", 1), ("10:00", 1), ("10:05", 1)]
    day_later, late = (base + dt.timedelta(days=1), "SUCCESS", 0.0), (base + dt.timedelta(minutes=8), "FAILED", 0.0)
    assert alerts_after("failed", failed, 0, day_later) == [("09:55", 1), ("10:00", 1), ("10:05", 1)]
    assert alerts_after("failed", failed, 0, late) == [("09:55", 2), ("10:00", 2), ("10:05", 2)]
    metric = lambda rows: stream_metric(rows, "end_time", "v")
    assert alerts_after("metric", metric, 44, (base + dt.timedelta(days=2), "SUCCESS", 0.0)) == [("10:05", 45.0)]


def test_windows_of_many_micro_batches_are_folded_and_late_ones_still_count(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(alerts, "FOLD", 4)
    schema = T.StructType([T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()), T.StructField("measure", T.LongType())])
    path = str(tmp_path / "windows")
    start = dt.datetime(2024, 1, 1)
    expected = {}
    for batch_id in range(19):
        touched = [batch_id, 0] if batch_id % 3 == 0 else [batch_id]  # window 0 gets late rows all the time
        expected |= {w: batch_id + 1 for w in touched}
        data = [(start + dt.timedelta(minutes=5 * w), start + dt.timedelta(minutes=5 * w + 15), batch_id + 1) for w in set(touched)]
        alerts.write_rows(spark.createDataFrame(data, schema).coalesce(1), f"{path}/batch_id={batch_id}")
        if batch_id % alerts.FOLD == alerts.FOLD - 1:
            alerts.fold_windows(spark, path, schema, batch_id)
            alerts.fold_windows(spark, path, schema, batch_id)  # the batch is run again
        found = read_alerts(spark, path, schema, 0)
        assert {int((r.window_start - start).total_seconds()) // 300: r.measure for r in found.collect()} == expected
    assert len(os.listdir(path)) <= 2 * alerts.FOLD + 2
    (tmp_path / "windows" / "folded=99").mkdir()  # a fold that died
    assert read_alerts(spark, path, schema, 0).count() == len(expected)


def test_columns_of_a_changing_stream_keep_their_order_after_a_restart(spark, tmp_path):
    folder, path, checkpoint = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    headers = [("a.csv", "id,v"), ("b.csv", "w,id"), ("c.csv", "x,V,id")]
    for number, (name, header) in enumerate(headers):
        put(folder, name, header, ",".join(f"{number}{c}" for c in header.split(",")))
        stream_evolving(spark, str(folder), path, checkpoint).awaitTermination()
    last = spark.read.parquet(f"{path}/batch_id=2")
    assert last.columns == ["id", "v", "_ingest_file", "_ingest_timestamp", "w", "x"]
    assert rows(last, "id", "v", "w", "x") == [("2id", "2V", None, "2x")]
    assert rows(read_raw(spark, path), "id", "v", "w", "x") == [("0id", "0v", None, None), ("1id", None, "1w", None), ("2id", "2V", None, "2x")]


def test_rows_read_for_a_micro_batch_do_not_grow_with_the_table(spark, tmp_path):
    schema = text_schema(["id", "v"])
    target = CleansedTable(spark, Layout(str(tmp_path)), "things", schema)
    target.table = replace(target.table, keys_per_bucket=100)
    things = lambda a, b: spark.range(a, b).selectExpr("cast(id AS string) AS id", "'x' AS v")
    few = things(0, 5).unionAll(things(10**6, 10**6 + 5))
    read = []
    for n in (2_000, 20_000):
        target.append_new(things(0, n), ["id"], [])
        last = target.table.marker()
        near = target.table.key_index(["id"]).near(last.key_runs, few)
        read.append((scanned_files(near), near.count()))
    assert all(files <= 20 and found == 5 for files, found in read), read
    assert target.append_new(few, ["id"], []) == 5 and target.append_new(few, ["id"], []) == 0
    assert target.read().count() == 20_005
