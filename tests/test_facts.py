from decimal import Decimal

import pytest
from helpers import at, rows

from starloom.operators import facts
from starloom.operators.clean import REJECT
from starloom.plans import generic, retail

STAMP = at("2024-03-01")


@pytest.fixture
def dims(spark):
    def dim(entity, *ids):
        data = [(i, "S", n, True) for n, i in enumerate(ids, 1)]
        schema = f"{entity}_id string, source_system string, {entity}_key bigint, is_current boolean"
        return spark.createDataFrame(data, schema)

    currency = spark.createDataFrame([("EUR", 5)], "currency_code string, currency_key bigint")
    return {
        "dim_customer": dim("customer", "C1", "C2"),
        "dim_product": dim("product", "P1"),
        "dim_employee": dim("employee", "E1"),
        "dim_location": dim("location", "L1"),
        "dim_currency": currency,
    }


COLUMNS = (
    "source_system sale_id sale_date customer_id product_id employee_id location_id currency_code quantity unit_price "
    "discount_amount tax_amount net_amount"
)


def sales(text, *lines):
    base = dict(zip(COLUMNS.split(), ("S", "1", "2024-01-31", "C1", "P1", "E1", "L1", "EUR", "2", "3.5", "1", "0", "6")))
    return text(COLUMNS, *[tuple((base | line).values()) for line in lines])


def test_keys_measures_and_defaults(text, dims):
    staged = sales(text, {}, {"sale_id": "2", "employee_id": None, "location_id": "?", "currency_code": "XXX",
                              "discount_amount": None, "tax_amount": "?"})
    loaded = facts.load_facts(staged, generic.SALES, dims, STAMP)
    columns = ("sale_id", "date_key", "customer_key", "product_key", "employee_key", "location_key", "currency_key")
    assert rows(loaded, *columns) == [("1", 20240131, 1, 1, 1, 1, 5), ("2", 20240131, 1, 1, None, None, None)]
    assert rows(loaded.where("sale_id = '2'"), "discount_amount", "tax_amount") == [(Decimal("0.0000"),) * 2]


def test_rejects_carry_a_reason_and_nothing_is_lost(text, dims):
    staged = sales(
        text, {}, {"sale_id": "2", "sale_date": "31/01/2024"}, {"sale_id": "3", "net_amount": "?"},
        {"sale_id": "4", "customer_id": "C9"}, {"sale_id": "5", "product_id": None},
    )
    resolved = facts.resolve_facts(staged, generic.SALES, dims, STAMP)
    assert rows(facts.rejected(resolved), "sale_id", REJECT) == [
        ("2", "bad_date"),
        ("3", "bad_net_amount"),
        ("4", "unknown_dim_customer"),
        ("5", "unknown_dim_product"),
    ]
    assert facts.accepted(resolved, generic.SALES).count() + facts.rejected(resolved).count() == staged.count()


def test_second_run_adds_only_what_is_new_and_never_updates(text, dims):
    first = facts.load_facts(sales(text, {}), generic.SALES, dims, STAMP)
    again = facts.load_facts(sales(text, {"net_amount": "99"}, {"sale_id": "2"}), generic.SALES, dims, STAMP, first)
    assert rows(again, "sale_id") == [("2",)]
    assert facts.load_facts(sales(text, {}), generic.SALES, dims, STAMP, first).isEmpty()


def test_repeated_key_in_a_batch(text, dims):
    staged = sales(text, {"sale_date": "2024-01-01", "net_amount": "9"}, {"sale_date": "2024-01-02", "net_amount": "1"})
    assert rows(facts.load_facts(staged, generic.SALES, dims, STAMP), "net_amount") == [(Decimal("1.0000"),)]
    with pytest.raises(ValueError):
        facts.load_facts(staged, generic.SALES, dims, STAMP, on_dup="error")


def test_a_readable_row_wins_over_an_unreadable_one_of_its_key(text, dims):
    staged = sales(
        text, {"sale_date": "pending", "net_amount": "9"}, {"sale_date": "2024-01-05", "net_amount": "1"},
        {"sale_date": "2024-01-09", "net_amount": "?"}, {"sale_id": "2", "sale_date": "pending"},
    )
    resolved = facts.resolve_facts(staged, generic.SALES, dims, STAMP)
    assert rows(resolved, "sale_id", "date_key", REJECT) == [("1", 20240105, None), ("2", None, "bad_date")]
    assert rows(facts.batch_outcomes(staged, resolved)) == [("accepted", 1), ("bad_date", 1), ("set_aside", 2)]


def test_rows_without_a_readable_key_are_rejected_each(text, dims):
    staged = sales(text, {"sale_id": None}, {"sale_id": None}, {"source_system": None}, {})
    resolved = facts.resolve_facts(staged, generic.SALES, dims, STAMP)
    assert rows(facts.batch_outcomes(staged, resolved)) == [("accepted", 1), ("missing_key", 3), ("set_aside", 0)]
    line = text("source_system order_id order_line_number order_date order_status " + " ".join(COLUMNS.split()[3:]),
                ("S", "1", "x1", "2024-01-01", "paid", "C1", "P1", None, None, None, "2", "3.5", "1", "0", "6"))
    resolved = facts.resolve_facts(line, generic.ORDERS, dims, STAMP)
    assert rows(resolved, "order_id", "_order_line_number_text", REJECT) == [("1", "x1", "bad_order_line_number")]


def test_order_amounts(text, dims):
    staged = text(
        "source_system order_id order_date order_status customer_id product_id quantity unit_price discount_pct",
        ("S", "1", "2024-01-01", "paid", "C1", "P1", "3", "19.99", "15"),
        ("S", "2", "2024-01-01", "paid", "C1", "P1", "3", "19.99", None),
        ("S", "3", "2024-01-01", "paid", "C1", "P1", "many", "19.99", "5"),
        ("S", "4", "2024-01-01", "paid", "C1", "P1", "9" * 14, "9" * 14, "99999"),
    )
    priced = facts.order_amounts(staged)
    loaded = facts.load_facts(priced, retail.RETAIL_ORDERS, dims, STAMP)
    got = rows(loaded, "order_id", "order_line_number", "discount_amount", "tax_amount", "net_amount", "employee_key")
    assert got == [
        ("1", 1, Decimal("8.9955"), Decimal("0.0000"), Decimal("50.9745"), None),
        ("2", 1, Decimal("0.0000"), Decimal("0.0000"), Decimal("59.9700"), None),
    ]
    refused = facts.rejected(facts.resolve_facts(priced, retail.RETAIL_ORDERS, dims, STAMP))
    assert rows(refused, "order_id", REJECT) == [("3", "bad_quantity"), ("4", "bad_net_amount")]


def test_inventory_is_keyed_by_the_load_date_and_a_later_snapshot_adds_nothing(text, dims):
    columns = "source_system inventory_id product_id warehouse quantity_on_hand reorder_level last_restock_date"
    first = facts.load_facts(text(columns, ("S", "I1", "P1", "w", "5", "1", "2024-01-01")), retail.INVENTORY, dims, STAMP)
    assert rows(first, "snapshot_date_key", "quantity_on_hand") == [(20240301, 5)]
    later = text(columns, ("S", "I1", "P1", "w", "9", "1", "2024-04-01"))
    assert facts.load_facts(later, retail.INVENTORY, dims, at("2024-04-01"), first).isEmpty()


def test_facts_of_large_files_are_resolved_slice_by_slice(spark, tmp_path, text, dims, monkeypatch):
    lines = [{"sale_id": str(n % 9), "net_amount": str(n), "customer_id": "C9" if n == 15 else "C1"} for n in range(16)]
    sales(text, *lines, {"sale_id": None}, {"sale_id": "4", "sale_date": "?"}).write.parquet(str(tmp_path / "sales"))
    staged = spark.read.parquet(str(tmp_path / "sales"))
    first = facts.load_facts(sales(text, {"sale_id": "2"}), generic.SALES, dims, STAMP)
    once, calls, resolve = rows(facts.load_facts(staged, generic.SALES, dims, STAMP, first)), [], facts.resolve_typed
    monkeypatch.setattr(facts, "LARGE_INPUT", 0)
    monkeypatch.setattr(facts, "SLICE_ROWS", 6)
    monkeypatch.setattr(facts, "resolve_typed", lambda *a, **k: (calls.append(1), resolve(*a, **k))[1])
    found = facts.load_facts(staged, generic.SALES, dims, STAMP, first)
    assert rows(found) == once and len(calls) == 3 and len(once) == 7
    assert found.columns == list(generic.SALES.output_columns)
    needed = ["date_key", "net_amount"]
    assert rows(facts.load_facts(staged, generic.SALES, dims, STAMP, first, columns=needed)) == rows(found, *needed)
