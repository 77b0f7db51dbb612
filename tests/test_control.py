import datetime as dt

import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from starloom.operators import calendar, control

TIMES = "source_system string, object_name string, last_watermark_value timestamp, updated_date timestamp"


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_watermark_defaults_then_follows_what_was_set(spark):
    marks = spark.createDataFrame([], TIMES)
    assert control.get_watermark(marks, "S", "orders") == control.NEVER
    for value in ("2024-01-05", "2024-01-02"):
        update = spark.createDataFrame([("S", "orders", ts(value))], "source_system string, object_name string, last_watermark_value timestamp")
        marks = control.set_watermarks(marks, update, at("2024-02-01"))
        assert control.get_watermark(marks, "S", "orders") == ts(value)
    assert marks.count() == 1 and rows(marks, "updated_date") == [(ts("2024-02-01 06:00:00"),)]


def test_watermark_filter_is_strict_and_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(10).selectExpr("id", "timestamp_seconds(1704067200 + id) AS t").write.parquet(path)
    mark = ts("2024-01-01 00:00:04")
    newer = control.above_watermark(spark.read.parquet(path), "t", mark)
    assert rows(newer, "id") == [(5,), (6,), (7,), (8,), (9,)]
    assert "GreaterThan(t," in newer._jdf.queryExecution().executedPlan().toString()


def test_run_log_records_success_and_failure():
    log = []
    with control.run_log(log.append, "load") as run:
        run.rows_inserted = 3
    with pytest.raises(RuntimeError):
        with control.run_log(log.append, "load"):
            raise RuntimeError("broken file")
    assert [(r["status"], r.get("rows_inserted"), r.get("error_message")) for r in log] == [
        ("SUCCESS", 3, None),
        ("FAILED", None, "broken file"),
    ]
    assert all(r["start_time"] <= r["end_time"] for r in log)


def test_purge_keeps_the_cutoff_itself(spark):
    log = spark.createDataFrame([(ts("2024-01-01 11:59:59"),), (ts("2024-01-01 12:00:00"),)], "start_time timestamp")
    kept = control.purge_logs(log, "start_time", ts("2024-03-31 12:00:00"))
    assert rows(kept) == [(ts("2024-01-01 12:00:00"),)]


def test_load_plan_runs_active_objects_in_order_by_their_type(spark):
    data = [("S", "b", 20, "FULL", True), ("S", "a", 20, "INCREMENTAL", True), ("S", "c", 10, "FULL", True), ("S", "d", 1, "FULL", False)]
    metadata = spark.createDataFrame(data, "source_system string, object_name string, load_priority int, load_type string, is_active boolean")
    ran = []
    control.run_load_plan(metadata, lambda r: ran.append(("full", r.object_name)), lambda r: ran.append(("inc", r.object_name)))
    assert ran == [("full", "c"), ("inc", "a"), ("full", "b")]


def test_alert_windows(spark):
    runs = spark.createDataFrame(
        [(ts("2024-01-01 10:07:00"), "FAILED"), (ts("2024-01-01 10:08:00"), "SUCCESS")], "end_time timestamp, status string"
    )
    starts = sorted(r[0].strftime("%H:%M") for r in rows(control.failed_run_alerts(runs)))
    assert starts == ["09:55", "10:00", "10:05"]
    load = spark.createDataFrame([(ts("2024-01-01 10:07:00"), 90.0), (ts("2024-01-01 10:14:00"), 70.0)], "t timestamp, v double")
    over = {r[0].strftime("%H:%M"): r[2] for r in rows(control.metric_alerts(load, "t", "v"))}
    assert over == {"09:55": 90.0}


def test_calendar(spark):
    days = calendar.dim_date(spark)
    assert days.count() == 7670
    row = days.where("date_key = 20160101").first()
    assert (row.week_of_year, row.day_name, row.day_of_week, row.is_weekend, row.fiscal_year) == (53, "Friday", 6, False, None)
    assert [r[0] for r in days.where("date_key BETWEEN 20240106 AND 20240108").orderBy("date_key").select("is_weekend").collect()] == [True, True, False]
    assert calendar.dim_date(spark, existing=days.where("year_number < 2035")).count() == 365
    assert days.where("is_holiday").isEmpty() and days.agg(F.count_distinct("full_date")).first()[0] == 7670
