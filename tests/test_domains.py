"""Whole deliveries: every staged row is loaded, nothing is orphaned, a repeat changes nothing."""

import csv
import datetime as dt
import os

import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from starloom.functions import changed
from starloom.operators import scd
from starloom.operators.clean import REJECT
from starloom.operators.control import PIPELINE_METADATA
from starloom.plans import banking, generic, healthcare, retail
from starloom.plans.deliveries import BANKING, GENERIC, HEALTHCARE, RETAIL, check_fact, load_delivery, metadata_rows, seed
from starloom.plans.loads import Warehouse
from starloom.session import exists, materialize, scratch_scope
from starloom.sources.files import read_csv, stage_stamp

DAY1, DAY2 = at("2024-01-01"), at("2024-02-01")

# Values of the generated files by column; the rest is made from the column name and the row number.
IDS = {"customer": "CUST", "account": "ACCT", "loan": "LOAN", "transaction": "TXN", "patient": "PAT", "provider": "PROV",
       "claim": "CLM", "prescription": "RX", "product": "PROD", "order": "ORD", "inventory": "INV"}
NUMBERS = {"quantity": "3", "unit_price": "19.99", "discount_pct": "15", "term_months": "360", "days_supply": "30",
           "quantity_on_hand": "7", "reorder_level": "2", "currency_code": "EUR"}
AMOUNTS = {"balance", "amount", "running_balance", "principal_amount", "interest_rate", "claim_amount", "cost", "unit_cost"}
ROWS = {"customers": 20, "accounts": 28, "loans": 6, "transactions": 240, "patients": 20, "providers": 5, "claims": 60,
        "pharmacy": 40, "products": 8, "orders": 80, "inventory": 16}


def value(column, row, file):
    if column.endswith("_id"):
        entity = column.removesuffix("_id")
        parents = {"customer": 20, "account": 28, "patient": 20, "provider": 5, "product": 8}
        own = file.startswith(entity) or entity in ("prescription", "inventory")
        return f"{IDS[entity]}{100000 + (row if own else row % parents.get(entity, 1))}"
    if column in NUMBERS:
        return NUMBERS[column]
    if column in AMOUNTS:
        return f"{row + 1}.25"
    if "date" in column:
        return f"2024-01-{row % 28 + 1:02d}"
    return f" {column}, {row} "


def write_delivery(root, domain, changed=()):
    folder = root / domain.folder
    folder.mkdir(parents=True)
    for name, _, file in domain.plan:
        columns = domain.objects[name].columns
        with open(folder / file, "w", newline="") as out:
            writer = csv.writer(out, escapechar="\\")
            writer.writerow(columns)
            for n in range(ROWS[file.removesuffix(".csv")]):
                line = {c: value(c, n, file) for c in columns}
                line.update({c: "changed" for c in changed if c in line and n == 0})
                writer.writerow(line.values())
    return str(root)


def staged(house, domain, root, name):
    file = next(f for n, _, f in domain.plan if n == name)
    return stage_stamp(read_csv(house.spark, f"{root}/{domain.folder}/{file}"), domain.source, 1, DAY1)


@pytest.mark.parametrize(
    "domain, facts, dims",
    [
        (BANKING, {"banking_transaction": banking.BANK_TRANSACTIONS}, {"customer": 20, "account": 28, "loan": 6}),
        (
            HEALTHCARE,
            {"healthcare_claim": healthcare.CLAIMS, "healthcare_pharmacy": healthcare.PHARMACY},
            {"patient": 20, "provider": 5},
        ),
        (RETAIL, {"retail_order": retail.RETAIL_ORDERS, "retail_inventory": retail.INVENTORY}, {"customer": 20, "product": 8}),
    ],
    ids=["banking", "healthcare", "retail"],
)
def test_delivery(spark, tmp_path, domain, facts, dims):
    house = Warehouse(spark, str(tmp_path / "house"))
    root = write_delivery(tmp_path / "in", domain)
    counts = load_delivery(house, domain, root, DAY1, 1)
    assert {n.split("_")[1]: c["rows_inserted"] for n, c in counts.items() if n.split("_")[1] in dims} == dims
    for name, spec in facts.items():
        loaded = staged(house, domain, root, name)
        assert counts[name] == {"rows_inserted": loaded.count(), "rows_rejected": 0, "rows_set_aside": 0}
        assert {r.check_result for r in check_fact(house, loaded, spec).collect()} == {"PASS"}
    again = load_delivery(house, domain, root, DAY2, 2)
    assert all(n == 0 for c in again.values() for k, n in c.items() if k != "rows_set_aside")
    assert all(again[name]["rows_set_aside"] == counts[name]["rows_inserted"] for name in facts)
    assert {r.object_name for r in house.checks().collect()} == {spec.name for spec in facts.values()}


def test_incremental_objects_load_newer_files_once_and_a_failed_load_leaves_the_mark(spark, tmp_path, monkeypatch):
    house, root = Warehouse(spark, str(tmp_path / "house")), write_delivery(tmp_path / "in", RETAIL)
    plan = metadata_rows(spark, RETAIL).where("object_name = 'retail_product'").withColumn("load_type", F.lit("INCREMENTAL"))
    file = tmp_path / "in" / RETAIL.folder / "products.csv"
    load = lambda stamp, batch: load_delivery(house, RETAIL, root, stamp, batch, plan)["retail_product"]
    assert load(DAY1, 1) == {"rows_inserted": 8, "rows_updated": 0, "rows_rejected": 0}
    mark = house.watermark(RETAIL.source, "retail_product")
    assert load(DAY1, 2) == {} and house.watermark(RETAIL.source, "retail_product") == mark
    os.utime(file, (file.stat().st_mtime + 60,) * 2)
    with monkeypatch.context() as broken:
        broken.setattr(house, "load_dim", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(DAY2, 3)
    assert house.watermark(RETAIL.source, "retail_product") == mark
    assert load(DAY2, 3) == {"rows_inserted": 0, "rows_updated": 0, "rows_rejected": 0}
    assert house.watermark(RETAIL.source, "retail_product") > mark
    house.purge_logs(dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=1))
    assert house.runs().count() == 2
    house.purge_logs(dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=91))
    assert house.runs().isEmpty()


def test_the_load_plan_is_seeded_once_and_read_from_its_table(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    root = write_delivery(tmp_path / "in", RETAIL)
    load_delivery(house, RETAIL, root, DAY1, 1)
    plan, systems = house.dim(PIPELINE_METADATA), house.dim(generic.SOURCE_SYSTEM)
    assert plan.current().count() == 4 and [r[0] for r in rows(systems.current(), "source_system_code")] == [RETAIL.source]
    seed(house, RETAIL, DAY2)  # known rows are written again, the source system stays
    assert {r[0] for r in rows(plan.current(), "updated_by")} == {"tester"} and rows(systems.current(), "updated_by") == [(None,)]
    other = Warehouse(spark, str(tmp_path / "other"))
    some = metadata_rows(spark, RETAIL).withColumn("is_active", F.col("object_name") == "retail_product")
    seed(other, RETAIL, DAY1, some)
    seed(other, RETAIL, DAY2)  # what is switched off stays so
    assert list(load_delivery(other, RETAIL, root, DAY2, 1)) == ["retail_product"]


def test_accounts_have_a_currency_once_currencies_are_delivered(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    (tmp_path / "core" / GENERIC.folder).mkdir(parents=True)
    (tmp_path / "core" / GENERIC.folder / "currency.csv").write_text("currency_code,currency_name,symbol\nEUR,Euro,E\n")
    only = metadata_rows(spark, GENERIC).where("object_name = 'currency'")
    load_delivery(house, GENERIC, str(tmp_path / "core"), DAY1, 1, only)
    load_delivery(house, BANKING, write_delivery(tmp_path / "in", BANKING), DAY1, 1)
    assert {r[0] for r in rows(house.dim(banking.ACCOUNT).current(), "currency_key")} == {1}
    assert {r[0] for r in rows(house.fact(banking.BANK_TRANSACTIONS).read(), "currency_key")} == {1}


def test_changed_delivery_cascades_from_customer_to_account(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    load_delivery(house, BANKING, write_delivery(tmp_path / "one", BANKING), DAY1, 1)
    second = load_delivery(house, BANKING, write_delivery(tmp_path / "two", BANKING, ["email", "city"]), DAY2, 2)
    assert second["banking_customer"] == {
        "locations_inserted": 0, "locations_updated": 1, "locations_rejected": 0, "rows_inserted": 1, "rows_updated": 1, "rows_rejected": 0,
    }
    assert second["banking_account"] == {"rows_inserted": 2, "rows_updated": 2, "rows_rejected": 0}
    assert second["banking_loan"] == {"rows_inserted": 0, "rows_updated": 0, "rows_rejected": 0}


def test_rows_without_their_mandatory_parent_are_kept_with_the_reason(spark, tmp_path, text):
    house = Warehouse(spark, str(tmp_path / "house"))
    people = spark.createDataFrame([("C1", "S", 1, True)], "customer_id string, source_system string, customer_key bigint, is_current boolean")
    currency = spark.createDataFrame([], "currency_code string, currency_key bigint")
    staged = text("source_system account_id customer_id account_type account_status open_date currency_code",
                  ("S", "A1", "C1", "x", "y", "2024-01-01", "EUR"), ("S", "A2", "C9", "x", "y", "2024-01-01", "EUR"))
    with scratch_scope(spark):
        counts = house.load_dim(staged, banking.ACCOUNT, DAY1, {"dim_customer": people, "dim_currency": currency})
    assert counts == {"rows_inserted": 1, "rows_updated": 0, "rows_rejected": 1}
    assert rows(house.dim_rejects(banking.ACCOUNT), "account_id", "customer_id", REJECT) == [("A2", "C9", "unknown_dim_customer")]


def test_null_can_equal_the_default_of_every_type(spark):
    one = "named_struct('b', CAST(NULL AS BOOLEAN), 't', CAST(NULL AS TIMESTAMP), 'n', CAST(NULL AS INT))"
    two = "named_struct('b', false, 't', TIMESTAMP '1900-01-01', 'n', -1)"
    test = changed("one", "two", "btn", {"b": "boolean", "t": "timestamp", "n": "int"}, null_as_default=True)
    assert not spark.sql(f"SELECT {one} AS one, {two} AS two").selectExpr(f"{test} AS c").first().c


def test_scratch_tables_go_with_their_scope(spark):
    before = materialize(spark.range(1), "outside")
    with scratch_scope(spark):
        inside = materialize(spark.range(2), "inside")
        assert inside.count() == 2
    assert before.count() == 1 and not exists(spark, inside.inputFiles()[0])


def test_bank_and_shop_share_the_customer_table_without_touching_each_other(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    load_delivery(house, BANKING, write_delivery(tmp_path / "bank", BANKING), DAY1, 1)
    load_delivery(house, RETAIL, write_delivery(tmp_path / "shop", RETAIL), DAY2, 2)
    people = house.dim(generic.CUSTOMER).read()
    assert people.where("not is_current").isEmpty()
    assert rows(people.groupBy("source_system").count()) == [("BANKING_CORE", 20), ("RETAIL_CORE", 20)]
    assert people.where("customer_id = 'CUST100000'").count() == 2


def test_load_plan_rows_can_be_seeded_twice(spark):
    plan = scd.scd1_merge(None, metadata_rows(spark, BANKING), PIPELINE_METADATA, DAY1)
    both = metadata_rows(spark, BANKING).unionAll(metadata_rows(spark, RETAIL))
    plan = scd.scd1_merge(plan, both, PIPELINE_METADATA, DAY2)
    assert plan.count() == 8 and plan.where("updated_date IS NOT NULL").count() == 4
