import datetime as dt
import os
import time
from dataclasses import replace
from decimal import Decimal

import pytest
from helpers import at, day, rows, scanned_files
from pyspark.sql import functions as F
from test_scd import PERSON, person

from starloom.operators import control, facts
from starloom.operators.clean import REJECT
from starloom.operators.facts import batch_months
from starloom.plans import generic, loads
from starloom.plans.loads import Warehouse
from starloom.plans.shared_tables import STAMPS, stage
from starloom.session import SPLIT, SPLIT_BYTES, children, materialize, small_splits
from starloom.sources import maintenance
from starloom.sources.tables import Table, write_rows
from starloom.spec import HIGH_DATE

SF = "/root/testdata/sf0.001"
DAY1, DAY2, DAY3 = at("2024-01-01"), at("2024-01-10"), at("2024-01-20")


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path))


def segments(house):
    return rows(house.dim(PERSON).read(), "person_key", "person_id", "segment", "is_current", "effective_date", "expiry_date")


def test_versions_of_a_dimension_over_three_loads(house, text):
    assert house.dim(PERSON).read().isEmpty()
    first = house.load_dim(person(text, {"person_id": "1"}, {"person_id": "2"}), PERSON, DAY1)
    second = house.load_dim(person(text, {"person_id": "1", "segment": "B"}), PERSON, DAY2)
    third = house.load_dim(person(text, {"person_id": "1", "segment": "C"}, {"person_id": "3"}), PERSON, DAY3)
    assert [first, second, third] == [
        {"rows_inserted": 2, "rows_updated": 0, "rows_rejected": 0},
        {"rows_inserted": 1, "rows_updated": 1, "rows_rejected": 0},
        {"rows_inserted": 2, "rows_updated": 1, "rows_rejected": 0},
    ]
    assert segments(house) == [
        (1, "1", "A", False, day("2024-01-01"), day("2024-01-09")),
        (2, "2", "A", True, day("2024-01-01"), HIGH_DATE),
        (3, "1", "B", False, day("2024-01-10"), day("2024-01-19")),
        (4, "1", "C", True, day("2024-01-20"), HIGH_DATE),
        (5, "3", "A", True, day("2024-01-20"), HIGH_DATE),
    ]
    log = rows(house.runs(), "procedure_name", "status", "rows_inserted", "rows_updated")
    assert log == [("load_dim_person", "SUCCESS", 1, 1), ("load_dim_person", "SUCCESS", 2, 0), ("load_dim_person", "SUCCESS", 2, 1)]


def test_large_batch_is_read_by_many_tasks(spark, monkeypatch):
    lines = spark.range(0, 20_000, 1, 1).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    monkeypatch.setattr("starloom.session.SPLIT_BYTES", 50_000)
    batch, own = materialize(lines, "batch", 25_000), spark.conf.get(SPLIT)
    with small_splits(spark):
        assert batch.select(F.spark_partition_id()).distinct().count() > 8
    assert spark.conf.get(SPLIT) == own and rows(batch) == rows(lines)


def test_splits_a_session_made_smaller_stay(spark, monkeypatch):
    own = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "1m")
    try:
        with pytest.raises(ValueError), small_splits(spark):
            assert spark.conf.get(SPLIT) == "1m"
            raise ValueError
        assert spark.conf.get(SPLIT) == "1m"
    finally:
        spark.conf.set(SPLIT, own)


def test_fact_load_sorts_small_splits_by_the_id_first(house, text, spark, sale_dims, monkeypatch):
    seen, write = [], loads.write_fact_rows

    def spy(resolved, *rest):
        plan = resolved._jdf.queryExecution().optimizedPlan().toString()
        seen.append((int(spark.conf.get(SPLIT)), "windowspecdefinition(sale_id" in plan))
        write(resolved, *rest)

    monkeypatch.setattr(loads, "write_fact_rows", spy)
    own = spark.conf.get(SPLIT)
    house.load_fact(sale_lines(text, 0, 5), generic.SALES, DAY1, sale_dims)
    assert seen == [(SPLIT_BYTES, True)] and spark.conf.get(SPLIT) == own


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}


def test_shuffle_files_go_with_the_write_that_made_them(spark):
    before = shuffle_files(spark)
    for _ in range(3):
        materialize(spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 7).alias("k")).count(), "grouped")
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_fact_load_in_slices_gives_the_rows_keys_and_counts_of_one(spark, tmp_path, text, sale_dims, monkeypatch):
    wrote, write = [], loads.write_fact_rows
    monkeypatch.setattr(loads, "write_fact_rows", lambda *a: (wrote.append(a[4]), write(*a)))
    odd = text(" ".join(sale_lines(text, 0, 1).columns), *[
        ("S", "3", "2024-02-01", "C1", "P1", None, None, "EUR", "1", "2", "0", "0", "9"),
        ("S", "4", "?", "C1", "P1", None, None, "EUR", "1", "2", "0", "0", "2"),
        ("S", None, "2024-01-31", "C1", "P1", None, None, "EUR", "1", "2", "0", "0", "2"),
        (None, "5", "2024-01-31", "C1", "P1", None, None, "EUR", "1", "2", "0", "0", "2"),
        ("S", "90", "2024-01-31", "C9", None, None, None, "EUR", "1", "2", "0", "0", "2"),
    ])
    batches = [sale_lines(text, 0, 12).unionAll(odd).coalesce(1), sale_lines(text, 8, 25).unionAll(odd).coalesce(1)]
    seen = []
    for name, most in (("whole", 1000), ("sliced", 8)):
        monkeypatch.setattr(facts, "SLICE_ROWS", most)
        house = Warehouse(spark, str(tmp_path / name))
        counts = [house.load_checked_fact(b, generic.SALES, s, sale_dims) for b, s in zip(batches, (DAY1, DAY2))]
        table = house.fact(generic.SALES)
        checks = rows(house.checks().drop("check_key"))
        seen.append((counts, rows(table.read()), rows(table.rejects().select(sorted(table.rejects().columns))), checks, table.marker().key_runs))
    assert seen[0] == seen[1] and seen[0][0][0] == {"rows_inserted": 12, "rows_rejected": 3, "rows_set_aside": 2}
    assert wrote[:2] == [False] * 2 and wrote[2:5] == [False, True, True]


def test_compaction_some_months_at_a_time_keeps_every_row(house, text, spark, sale_dims, monkeypatch):
    for stamp, month in ((DAY1, "01"), (DAY2, "02"), (DAY3, "03")):
        lines = sale_lines(text, 100 * int(month), 100 * int(month) + 40).withColumn("sale_date", F.lit(f"2024-{month}-15"))
        house.load_fact(lines, generic.SALES, stamp, sale_dims)
    table, wrote, write = house.fact(generic.SALES), [], maintenance.write_rows
    monkeypatch.setattr(maintenance, "write_rows", lambda *a, **k: (wrote.append(k.get("append")), write(*a, **k)))
    before = rows(table.read())
    for column, most, appended in ((None, 1, [False, True, True]), (["date_key", "sale_key"], 80, [False, True])):
        monkeypatch.setattr(maintenance, "SPAN_ROWS", most)
        wrote.clear()
        maintenance.compact_cluster(table, ["sale_id"], DAY3.load_ts, column=column)
        assert rows(table.read()) == before and wrote == appended


def test_load_that_died_before_its_marker_is_invisible_and_its_retry_replaces_it(house, text, spark):
    house.load_dim(person(text, {"person_id": "1"}), PERSON, DAY1)
    before, table = segments(house), house.dim(PERSON)
    leftover = table.read().selectExpr("*", "'keep' AS merge_action")
    write_rows(leftover.unionAll(leftover), table.rows_path(2), "merge_action")
    assert segments(house) == before
    house.load_dim(person(text, {"person_id": "1", "segment": "B"}), PERSON, DAY2)
    assert [r[2:4] for r in segments(house)] == [("A", False), ("B", True)]


def test_failed_load_is_logged_and_changes_nothing(house, text):
    house.load_dim(person(text, {"person_id": "1"}), PERSON, DAY1)
    with pytest.raises(Exception):
        house.load_dim(text("person_id", ("1",)), PERSON, DAY2)
    assert house.runs().where("status = 'FAILED' AND error_message IS NOT NULL").count() == 1
    assert len(segments(house)) == 1


def load_sales(house, spark, staged=None, stamp=STAMPS[1], spec=generic.SALES, **options):
    dims = {}
    for name, dim in (("currency", generic.CURRENCY), ("location", generic.LOCATION), ("customer", generic.CUSTOMER),
                       ("product", generic.PRODUCT), ("employee", generic.EMPLOYEE)):
        if house.dim(dim).marker() is None:
            house.load_dim(stage(spark, SF, name), dim, STAMPS[1], dims)
        dims[dim.name] = house.dim(dim).current()
    staged = stage(spark, SF, "sales") if staged is None else staged
    return house.load_fact(staged, spec, stamp, dims, **options)


def file_count(spark, table):
    return table.current().selectExpr("_metadata.file_path AS f").distinct().count()


def test_fact_loads_rejects_compaction_and_expiry(house, spark):
    sales = stage(spark, SF, "sales")
    table = house.fact(generic.SALES)
    natural = ["source_system", "sale_id"]
    keyed = sales.dropDuplicates(natural).count()
    first = load_sales(house, spark, sales.where("currency_code = 'EUR'"))
    second = load_sales(house, spark, sales.where("currency_code IS DISTINCT FROM 'EUR'"), STAMPS[2])
    assert table.read().count() == first["rows_inserted"] + second["rows_inserted"]
    assert table.read().select(*natural).distinct().count() == table.read().count()
    assert table.read().select("sale_key").distinct().count() == table.read().count()

    again = load_sales(house, spark, sales, STAMPS[2])
    assert again["rows_inserted"] == 0
    reasons = {r[REJECT] for r in table.rejects().select(REJECT).distinct().collect()}
    assert {"bad_date", "bad_quantity", "unknown_dim_customer", "unknown_dim_product"} <= reasons
    late = table.rejects().where("load_id = 3")
    assert table.read().count() + late.count() == keyed
    assert late.where("customer_id IS NULL").isEmpty()

    before, files = rows(table.read()), file_count(spark, table)
    now = dt.datetime(2024, 3, 1)
    assert maintenance.compact_cluster(table, ["sale_id"], now) == 4
    assert rows(table.read()) == before and file_count(spark, table) < files
    assert not [p for p in maintenance.expire_versions(table, now + dt.timedelta(hours=100)) if "/rows/" in p]
    gone = maintenance.expire_versions(table, now + dt.timedelta(hours=200))
    assert {p.split("load_id=")[1] for p in gone if "/rows/" in p} >= {"1/status=accepted", "2/status=accepted"}
    assert rows(table.read()) == before and table.rejects().count() > 0
    with pytest.raises(ValueError):
        maintenance.expire_versions(table, now, 24)


def test_strict_load_refuses_rejects_and_publishes_nothing(house, spark):
    with pytest.raises(ValueError, match="rejected"):
        load_sales(house, spark, strict=True)
    assert house.fact(generic.SALES).marker() is None


def test_facts_of_other_months_are_not_opened_when_dates_are_fixed(house, spark):
    monthly = replace(generic.SALES, fixed_date=True)
    sales = stage(spark, SF, "sales").where("sale_date <> 'pending'")
    assert load_sales(house, spark, sales, spec=monthly)["rows_inserted"] > 0
    assert load_sales(house, spark, sales, STAMPS[2], spec=monthly)["rows_inserted"] == 0
    january = sales.where("sale_date LIKE '1997-01-%'")
    assert batch_months(january, monthly) == [199701]
    plan = house.fact(monthly).current(months=[199701])._jdf.queryExecution().executedPlan().toString()
    assert "date_month" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_month_filter_prunes_partitions(house, spark):
    load_sales(house, spark)
    rows_read = spark.read.parquet(house.fact(generic.SALES).path + "/rows")
    plan = rows_read.where("date_month = 199701")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in plan


def test_expired_dimension_loads_keep_the_history(house, text):
    for stamp, segment in ((DAY1, "A"), (DAY2, "B"), (DAY3, "C")):
        house.load_dim(person(text, {"person_id": "1", "segment": segment}), PERSON, stamp)
    before = segments(house)
    gone = maintenance.expire_versions(house.dim(PERSON), dt.datetime(2024, 6, 1))
    assert gone and not any("expire" in p.split("load_id=")[1] or "load_id=3" in p for p in gone)
    assert segments(house) == before


KEYS = ["source_system", "sale_id"]


def sale_lines(text, first, last):
    columns = "source_system sale_id sale_date customer_id product_id employee_id location_id currency_code quantity unit_price discount_amount tax_amount net_amount"
    return text(columns, *[("S", str(i), "2024-01-31", "C1", "P1", None, None, "EUR", "1", "2", "0", "0", "2") for i in range(first, last)])


@pytest.fixture
def sale_dims(spark):
    def dim(entity):
        return spark.createDataFrame([(f"{entity[0].upper()}1", "S", 1, True)], f"{entity}_id string, source_system string, {entity}_key bigint, is_current boolean")

    return {f"dim_{e}": dim(e) for e in ("customer", "product", "employee", "location")} | {
        "dim_currency": spark.createDataFrame([("EUR", 5)], "currency_code string, currency_key bigint")}


def test_a_small_batch_opens_only_the_buckets_of_its_keys(spark, tmp_path, text, sale_dims):
    house = Warehouse(spark, str(tmp_path), keys_per_bucket=50)
    load = lambda staged, stamp=DAY1: house.load_fact(staged, generic.SALES, stamp, sale_dims)
    assert load(sale_lines(text, 0, 3000))["rows_inserted"] == 3000
    table = house.fact(generic.SALES)
    last = table.marker()
    assert [tuple(r) for r in last.key_runs] == [(1, 1, 3000, 64)]
    ten = sale_lines(text, 2995, 3005)
    near = table.key_index(KEYS).near(last.key_runs, ten)
    assert scanned_files(near) <= 10 and scanned_files(table.current()) >= 1
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "EqualTo(key_hash" in plan
    assert {r.sale_id for r in near.collect()} == {str(i) for i in range(2995, 3000)}  # hashes tell the keys apart
    assert load(ten, DAY2) == {"rows_inserted": 5, "rows_rejected": 0, "rows_set_aside": 5}
    many = load(sale_lines(text, 2000, 4000), DAY2)  # too many to be asked for one by one
    assert many == {"rows_inserted": 995, "rows_rejected": 0, "rows_set_aside": 1005}
    assert table.read().select(*KEYS).distinct().count() == table.read().count() == 4000


def test_the_index_takes_up_small_runs_and_is_rebuilt_on_request(spark, tmp_path, text, sale_dims):
    house = Warehouse(spark, str(tmp_path), keys_per_bucket=100)
    load = lambda a, b: house.load_fact(sale_lines(text, a, b), generic.SALES, DAY1, sale_dims)["rows_inserted"]
    table = house.fact(generic.SALES)
    assert [load(0, 1000), load(1000, 1010), load(1010, 1020), load(1020, 1020), load(1020, 1021)] == [1000, 10, 10, 0, 1]
    assert [tuple(r) for r in table.marker().key_runs] == [(1, 1, 1000, 16), (2, 3, 20, 1), (5, 5, 1, 1)]
    assert load(0, 1100) == 79  # of the runs only one is left beside the large one
    house.rebuild_keys(generic.SALES, DAY2)
    assert [tuple(r) for r in table.marker().key_runs] == [(0, 7, 1100, 16)]
    assert load(0, 1101) == 1 and table.read().count() == 1101
    maintenance.compact_cluster(table, ["sale_id"], DAY2.load_ts)
    assert load(0, 1102) == 1 and table.read().count() == 1102
    without = table.marker().asDict()
    table.publish(without["load_id"] + 1, DAY2.load_ts, table.marker(), key_runs=[])  # as a table of an earlier version
    assert load(0, 1103) == 1 and table.read().count() == 1103


def test_a_load_takes_hot_keys_and_its_checks_from_what_it_writes(house, spark, text, sale_dims, monkeypatch):
    seen = {}
    resolve = loads.resolve_typed

    def spying(*args, **options):
        seen.update(options["hot"])
        resolved = resolve(*args, **options)
        seen["plan"] = resolved._jdf.queryExecution().analyzed().toString()
        return resolved

    monkeypatch.setattr(loads, "resolve_typed", spying)
    parents = {"customer_key": (sale_dims["dim_customer"], "customer_key"), "product_key": (sale_dims["dim_product"].where("false"), "product_key")}
    staged = sale_lines(text, 0, 300)
    assert house.load_checked_fact(staged, generic.SALES, DAY1, sale_dims, parents) == {"rows_inserted": 300, "rows_rejected": 0, "rows_set_aside": 0}
    assert len(seen["customer_key"]) == 1 and len(seen["product_key"]) == 1, "every line has the same customer and product"
    assert "_salt" in seen["plan"]
    checks = {r.check_name: (r.check_result, r.expected_value, r.actual_value) for r in house.checks().collect()}
    assert checks["staging_vs_fact_row_count"] == ("PASS", "300", "300")
    assert checks["required_dimension_keys_not_null"] == ("PASS", "0", "0")
    assert checks["orphaned_customer_key"] == ("PASS", "0", "0") and checks["orphaned_product_key"] == ("FAIL", "0", "300")
    assert all(result == "PASS" for name, (result, _, _) in checks.items() if name.startswith("not_null_"))
    assert house.load_checked_fact(staged.limit(0), generic.SALES, DAY2, sale_dims) == {"rows_inserted": 0, "rows_rejected": 0, "rows_set_aside": 0}


def test_fact_keys_do_not_change_when_tasks_are_run_again_and_leave_few_gaps(house, spark, text, sale_dims):
    staged = sale_lines(text, 0, 500).unionAll(sale_lines(text, 0, 100)).repartition(6, F.rand())  # other rows in each task each time
    first = house.load_fact(staged, generic.SALES, DAY1, sale_dims)
    assert first == {"rows_inserted": 500, "rows_rejected": 0, "rows_set_aside": 100}
    table = house.fact(generic.SALES)
    keys = [r.sale_key for r in table.read().select("sale_key").collect()]
    assert len(set(keys)) == 500 and max(keys) <= 600 == table.marker().last_key
    house.load_fact(sale_lines(text, 500, 510), generic.SALES, DAY2, sale_dims)
    assert table.marker().last_key == 610 and table.read().agg(F.max("sale_key")).first()[0] == 610


def test_ten_changed_keys_rewrite_at_most_ten_buckets(spark, tmp_path, text):
    house = Warehouse(spark, str(tmp_path), rows_per_bucket=40)
    people = lambda **of: [{"person_id": str(i), "segment": of.get(f"p{i}", "A")} for i in range(2000)]
    house.load_dim(person(text, *people()), PERSON, DAY1)
    table = house.dim(PERSON)
    first = table.marker()
    assert first.buckets == 64 and set(first.bucket_loads.values()) == {1}
    changed = {f"p{i}": "B" for i in range(0, 2000, 200)}
    assert house.load_dim(person(text, *people(**changed)), PERSON, DAY2) == {"rows_inserted": 10, "rows_updated": 10, "rows_rejected": 0}
    last = table.marker()
    assert 1 <= sum(load == 2 for load in last.bucket_loads.values()) <= 10 and last.rows_current == 2000
    assert table.current().count() == 2000 and table.history().count() == 10 and table.current().select("person_key").distinct().count() == 2000
    # A source of a few keys reads and writes their buckets only.
    assert scanned_files(table.current(last, buckets=[3])) == 1
    house.load_dim(person(text, {"person_id": "5", "segment": "C"}), PERSON, DAY3)
    assert sum(load == 3 for load in table.marker().bucket_loads.values()) == 1 and table.current().count() == 2000
    # A load that changes nothing writes nothing.
    house.load_dim(person(text, {"person_id": "5", "segment": "C"}), PERSON, DAY3)
    assert table.marker().bucket_loads != {} and 4 not in table.marker().bucket_loads.values()


def test_a_load_that_dies_between_buckets_shows_the_old_state(spark, tmp_path, text, monkeypatch):
    house = Warehouse(spark, str(tmp_path), rows_per_bucket=10)
    house.load_dim(person(text, *[{"person_id": str(i)} for i in range(100)]), PERSON, DAY1)
    before = segments(house)
    with monkeypatch.context() as patch:
        patch.setattr("starloom.sources.tables.Table.publish", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            house.load_dim(person(text, *[{"person_id": str(i), "segment": "B"} for i in range(0, 120, 3)]), PERSON, DAY2)
    assert segments(house) == before
    house.load_dim(person(text, *[{"person_id": str(i), "segment": "C"} for i in range(0, 100, 5)]), PERSON, DAY2)
    after = segments(house)
    assert len(after) == 120 and sum(r[2] == "C" for r in after) == 20 and not any(r[2] == "B" for r in after)


def test_a_dimension_that_grows_is_dealt_into_more_buckets(spark, tmp_path, text):
    house = Warehouse(spark, str(tmp_path), rows_per_bucket=10)
    people = lambda n: person(text, *[{"person_id": str(i)} for i in range(n)])
    table = house.dim(PERSON)
    for n, stamp, buckets in ((10, DAY1, 1), (12, DAY2, 2), (200, DAY3, 32)):
        house.load_dim(people(n), PERSON, stamp)
        assert table.marker().buckets == buckets and table.current().count() == n
    assert sorted(r.person_key for r in table.current().collect()) == list(range(1, 201))


def test_dimension_rows_without_a_key_are_kept_with_the_reason(house, text):
    staged = person(text, {"person_id": "1"}, {"person_id": None}, {"person_id": None})
    assert house.load_dim(staged, PERSON, DAY1) == {"rows_inserted": 1, "rows_updated": 0, "rows_rejected": 2}
    assert [r[REJECT] for r in house.dim_rejects(PERSON).collect()] == ["missing_key"] * 2


def test_the_last_of_ten_thousand_loads_is_found_by_two_listings(house, spark, tmp_path, text, monkeypatch):
    table = house.dim(PERSON)
    house.load_dim(person(text, {"person_id": "1"}), PERSON, DAY1)
    first = table.marker()
    for load_id in range(2, 10_001):  # as if published; only the last ones have a row
        os.makedirs(table.marker_path(load_id))
    table.publish(9_998, DAY2.load_ts, first)
    listed = []
    monkeypatch.setattr("starloom.sources.tables.children", lambda s, p: listed.append(p) or children(s, p))
    assert table.marker().load_id == 9_998 and len(listed) == 3  # an epoch whose only folder has no row, then the one before
    assert segments(house) == [(1, "1", "A", True, day("2024-01-01"), HIGH_DATE)]
    gone = maintenance.expire_versions(table, dt.datetime(2024, 6, 1))
    assert f"{table.path}/published/epoch=0" in gone and len(children(spark, f"{table.path}/published")) == 2
    assert table.marker().load_id == 9_998


def test_a_curve_lets_filters_on_either_column_pass_over_files(spark, tmp_path):
    schema = "day date, customer string, amount decimal(9,2), note string"
    made = spark.range(20_000).selectExpr(
        "date_add(DATE '2024-01-01', cast(pmod(hash(id, 1), 365) AS int)) AS day", "format_string('CUST%06d', pmod(hash(id, 2), 5000)) AS customer",
        "cast(pmod(hash(id), 1000) / 7 AS decimal(9,2)) AS amount", "if(id % 50 = 0, NULL, cast(id AS string)) AS note",
    )
    table = Table(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, "rows")
    table.append(made, DAY1.load_ts)
    table.append(spark.createDataFrame([(None, None, None, None)] * 10, schema), DAY2.load_ts)
    before = rows(table.read())
    maintenance.compact_cluster(table, ["note"], DAY3.load_ts, files=32, column=["day", "customer"])
    assert rows(table.read()) == before
    limits = {"day": (day("2024-03-01"), day("2024-03-10")), "customer": ("CUST001000", "CUST001100"), "amount": (Decimal("3.00"), Decimal("4.00"))}
    files = scanned_files(table.current())
    assert 24 <= files <= 32
    asked = {c: table.current(where={c: limit}) for c, limit in limits.items()}
    want = {c: rows(made.where(F.col(c).between(*limit))) for c, limit in limits.items()}
    assert {c: rows(df) == want[c] for c, df in asked.items()} == dict.fromkeys(limits, True)
    assert {c: scanned_files(df) for c, df in asked.items()} == dict.fromkeys(limits, files)  # not analysed yet
    assert maintenance.analyze_files(table, ["day", "customer"]) == files and maintenance.analyze_files(table, ["day", "customer"]) == 0
    asked = {c: table.current(where={c: limit}) for c, limit in limits.items()}
    assert all(rows(asked[c]) == want[c] for c in limits)
    opened = {c: scanned_files(df) for c, df in asked.items()}
    assert opened["day"] <= 12 and opened["customer"] <= 12 and opened["amount"] == files, opened
    both = table.current(where={"day": limits["day"], "customer": limits["customer"]})
    assert scanned_files(both) <= 4 and rows(both) == rows(made.where(F.col("day").between(*limits["day"]) & F.col("customer").between(*limits["customer"])))
    assert table.current(where={"day": (day("1999-01-01"), day("1999-01-02"))}).count() == 0
    table.append(made.limit(5).withColumn("day", F.lit(day("1999-01-01"))), DAY3.load_ts)  # a load without statistics is read whole
    assert table.current(where={"day": (day("1999-01-01"), day("1999-01-02"))}).count() == 5
    shown = maintenance.table_statistics(table, ["day", "customer"]).collect()
    assert [tuple(r) for r in shown] == [("day", 20_010, 10, "2024-01-01", "2024-12-30"), ("customer", 20_010, 10, "CUST000000", "CUST004999")]


def test_a_purge_that_dies_loses_no_log_row(house, text, monkeypatch):
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run = {"procedure_name": "p", "status": "SUCCESS"}
    for key, age in ((1, 100), (2, 10), (3, 1)):
        house.append_run(run | {"run_key": key, "start_time": now - dt.timedelta(days=age)})
    kept = lambda: [r[0] for r in rows(house.runs(), "run_key")]
    with monkeypatch.context() as patch:
        patch.setattr("starloom.plans.loads.purge_logs", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            house.purge_logs(now)
    assert kept() == [1, 2, 3]
    os.makedirs(house._generation_path("log_etl_run", 1) + "/_temporary")  # of a purge that did not finish
    assert kept() == [1, 2, 3]
    with monkeypatch.context() as patch:
        patch.setattr("starloom.plans.loads.delete", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            house.purge_logs(now)
    assert kept() == [2, 3]
    house.append_run(run | {"run_key": 4, "start_time": now})
    house.purge_logs(now + dt.timedelta(days=85))
    assert kept() == [3, 4] and len(os.listdir(house.layout.path("audit", "log_etl_run"))) == 1


def test_rows_logged_during_a_purge_are_taken_over(house, monkeypatch):
    now = dt.datetime(2024, 5, 1)
    house.append_run({"run_key": 1, "start_time": now, "procedure_name": "p", "status": "SUCCESS"})
    plain = control.purge_logs

    def late(log, *args):
        house.append_run({"run_key": 2, "start_time": now, "procedure_name": "q", "status": "SUCCESS"})
        return plain(log, *args)

    monkeypatch.setattr("starloom.plans.loads.purge_logs", late)
    house.purge_logs(now)
    assert [r[0] for r in rows(house.runs(), "run_key")] == [1, 2]


def test_statistics(spark):
    spark.sql("CREATE TABLE stats_probe USING parquet AS SELECT id AS k FROM range(10)")
    try:
        maintenance.analyze_table(spark, "stats_probe")
        described = spark.sql("DESCRIBE EXTENDED stats_probe k").collect()
        assert any(r[0] == "distinct_count" and r[1] == "10" for r in described)
    finally:
        spark.sql("DROP TABLE stats_probe")
