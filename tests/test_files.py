import datetime as dt
import os

import pytest
from helpers import at, rows

import catalog
from starloom.operators.control import NEVER
from starloom.session import children
from starloom.sources import files

DAY = at("2024-01-01")


def put(folder, name, *lines, mtime=None):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    if mtime:
        stamp = dt.datetime.fromisoformat(mtime + "+00:00").timestamp()
        os.utime(path, (stamp, stamp))
    return str(path)


def test_csv_is_read_as_text_with_quotes_and_escapes(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "id,name", '007,"Smith, \\"Jo\\""', "8,")
    assert rows(files.read_csv(spark, str(tmp_path / "in"))) == [("007", 'Smith, "Jo"'), ("8", None)]


def test_wrong_header_is_an_error_when_columns_are_given(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "name,id", "x,1")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path / "in"), ["id", "name"]).collect()


def test_inferred_types(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "id,v,d", "1,2.5,x")
    assert [f.dataType.simpleString() for f in files.read_inferred(spark, str(tmp_path / "in")).schema] == ["int", "double", "string"]


def test_lineage_and_stamps(spark, tmp_path):
    path = put(tmp_path / "in", "a.csv", "id", "1")
    row = files.with_lineage(files.read_csv(spark, path), DAY).first()
    assert row["_ingest_file"].endswith("/in/a.csv") and str(row["_ingest_timestamp"]) == "2024-01-01 06:00:00"
    stamped = files.stage_stamp(files.read_csv(spark, path), "S", 4, DAY).first()
    assert (stamped.source_system, stamped.staging_batch_id, str(stamped.staging_loaded_date)) == ("S", 4, "2024-01-01 06:00:00")


def test_gate_takes_only_newer_files(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.csv", "id", "1", mtime="2024-01-01 00:00:00")
    got, mark = files.incremental_gate(spark, str(folder), ["id"], NEVER)
    assert rows(got) == [("1",)] and mark == dt.datetime(2024, 1, 1)
    assert files.incremental_gate(spark, str(folder), ["id"], mark) is None
    put(folder, "b.csv", "id", "2", mtime="2024-01-02 00:00:00")
    got, later = files.incremental_gate(spark, str(folder), ["id"], mark)
    put(folder, "c.csv", "id", "3", mtime="2024-01-03 00:00:00")
    assert rows(got) == [("2",)]
    got, _ = files.incremental_gate(spark, str(folder), ["id"], later)
    assert rows(got) == [("3",)]


def test_columns_are_matched_by_name_when_one_appears_in_the_middle(spark, tmp_path):
    one = put(tmp_path / "in", "a.csv", "id,v", "1,x")
    two = put(tmp_path / "in", "b.csv", "id,mid,v", "2,m,y")
    both = files.read_evolving(spark, [one, two])
    assert rows(both, "id", "v", "mid") == [("1", "x", None), ("2", "y", "m")]


def test_staging_replaced_or_accumulated(spark, text, tmp_path):
    path = str(tmp_path / "full")
    for n in "12":
        files.sink_full(text("id", (n,)), path)
    assert rows(spark.read.parquet(path)) == [("2",)]
    path = str(tmp_path / "append")
    for n in (1, 2):
        files.sink_append(files.stage_stamp(text("id", (str(n),)), "S", n, DAY), path)
    assert spark.read.parquet(path).count() == 2
    assert rows(files.current_batch(spark.read.parquet(path), 2), "id") == [("2",)]


def test_headers_are_what_spark_reads(spark, tmp_path):
    headers = ["id,name", 'id,"a, b",c', " id , name", "a,,b", "a,a,A", '"x ""y""",z', "a\\,b", '"open', "\ufeffid,v", "été,straße", "a;b", "\tx,y", 'a"b,c', "one"]
    for k, header in enumerate(headers):
        path = put(tmp_path / "in", f"{k}.csv", header, "1,2,3")
        assert files.header_of(spark, path) == tuple(spark.read.options(**files.CSV).csv(path).columns), header
    (tmp_path / "in" / "empty.csv").write_text("")
    assert files.header_of(spark, str(tmp_path / "in" / "empty.csv")) == ()


def test_headers_of_many_files_start_no_job(spark, tmp_path):
    paths = [put(tmp_path / "in", f"{k}.csv", *(("id,v", f"{k},x") if k % 2 else ("w,id", f"y,{k}"))) for k in range(200)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        read = files.read_evolving(spark, paths)
        assert len(tracker.getJobIdsForGroup("headers")) <= 2  # listings of the two layouts' files
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(read, "id", "v", "w") == sorted(((str(k), "x", None) if k % 2 else (str(k), None, "y") for k in range(200)), key=repr)


def test_delivered_files_and_staging_tables_are_written_compressed(spark, tmp_path, monkeypatch):
    class Seen(Exception):
        pass

    def stop(house, domain, root, *rest):
        raise Seen([name for file in children(spark, f"{root}/core") for name in children(spark, f"{root}/core/{file}") if name.startswith("part-")])

    monkeypatch.setattr(catalog.deliveries, "load_delivery", stop)
    with pytest.raises(Seen) as seen:
        catalog.queries()["generic_delivery"](spark, "/root/testdata/sf0.001")
    names = seen.value.args[0]
    assert names and all(name.endswith(".csv.gz") for name in names)
    table = str(tmp_path / "staged")
    files.sink_full(spark.range(3), table)
    assert all(name.endswith(".zstd.parquet") for name in os.listdir(table) if name.startswith("part-"))
    assert rows(spark.read.parquet(table)) == [(0,), (1,), (2,)]
