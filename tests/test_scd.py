from dataclasses import replace

import pytest
from helpers import at, day, rows

from starloom.operators import scd
from starloom.plans import banking, generic, healthcare
from starloom.spec import HIGH_DATE, DimSpec

PERSON = DimSpec(
    name="dim_person",
    key="person_key",
    natural_key=("person_id", "source_system"),
    columns={"name": "string", "segment": "string", "gender": "string", "born": "date", "score": "int"},
    compare=("name", "segment", "born", "score"),
)
DAY1, DAY2, DAY3 = at("2024-01-01"), at("2024-01-10"), at("2024-01-20")
COLUMNS = "person_id source_system name segment gender born score"


def person(text, *people):
    """(id, segment, other columns ...) with defaults."""
    full = []
    for p in people:
        base = {"source_system": "S", "name": "n", "segment": "A", "gender": "F", "born": "1970-01-01", "score": "1"}
        full.append(tuple((base | p)[c] for c in COLUMNS.split()))
    return text(COLUMNS, *full)


def load(target, staged, stamp, spec=PERSON, **options):
    return scd.scd2_merge(target, scd.dim_source(staged, spec, **options), spec, stamp)


def versions(dim, *extra):
    return rows(dim, "person_id", *extra, "is_current", "effective_date", "expiry_date")


def test_unchanged_rows_make_no_version(text):
    first = load(None, person(text, {"person_id": "1"}), DAY1)
    again = load(first, person(text, {"person_id": "1"}), DAY2)
    assert rows(again) == rows(first)
    assert first.collect()[0].created_by == "tester"


def test_changed_row_expires_the_day_before_and_a_new_version_is_current(text):
    first = load(None, person(text, {"person_id": "1"}), DAY1)
    second = load(first, person(text, {"person_id": "1", "segment": "B"}), DAY2)
    assert versions(second, "person_key", "segment") == [
        ("1", 1, "A", False, day("2024-01-01"), day("2024-01-09")),
        ("1", 2, "B", True, day("2024-01-10"), HIGH_DATE),
    ]
    old, new = (second.where(f"person_key = {k}").first() for k in (1, 2))
    assert (str(old.updated_date), old.updated_by) == ("2024-01-10 06:00:00", "tester")
    assert new.updated_date is None and str(new.created_date) == "2024-01-10 06:00:00"


def test_new_key_has_exactly_one_version_and_missing_key_stays_current(text):
    first = load(None, person(text, {"person_id": "1"}), DAY1)
    second = load(first, person(text, {"person_id": "2"}), DAY2)
    assert versions(second) == [
        ("1", True, day("2024-01-01"), HIGH_DATE),
        ("2", True, day("2024-01-10"), HIGH_DATE),
    ]


@pytest.mark.parametrize(
    "column, before, after, changes",
    [
        ("segment", "A", None, True),
        ("segment", None, "A", True),
        ("segment", None, None, False),
        ("segment", None, "", True),
        ("score", None, "-1", True),
        ("born", None, "1900-01-01", True),
        ("born", "1970-01-01", None, True),
    ],
)
def test_null_is_a_value_of_its_own(text, column, before, after, changes):
    first = load(None, person(text, {"person_id": "1", column: before}), DAY1)
    second = load(first, person(text, {"person_id": "1", column: after}), DAY2)
    assert second.count() == (2 if changes else 1)


@pytest.mark.parametrize("column, blank", [("segment", ""), ("score", "-1"), ("born", "1900-01-01")])
def test_null_can_be_made_to_equal_the_default(text, column, blank):
    spec = replace(PERSON, null_as_default=True)
    first = load(None, person(text, {"person_id": "1", column: None}), DAY1, spec)
    assert load(first, person(text, {"person_id": "1", column: blank}), DAY2, spec).count() == 1
    assert load(first, person(text, {"person_id": "1", "name": "m"}), DAY2, spec).count() == 2


def test_carried_column_is_kept_in_new_versions_and_makes_none(text):
    first = load(None, person(text, {"person_id": "1"}), DAY1)
    same = load(first, person(text, {"person_id": "1", "gender": "M"}), DAY2)
    assert rows(same, "gender") == [("F",)]
    moved = load(first, person(text, {"person_id": "1", "gender": "M", "segment": "B"}), DAY2)
    assert rows(moved, "gender", "is_current") == [("F", False), ("M", True)]


def test_same_id_of_two_sources_is_two_keys(text):
    staged = person(text, {"person_id": "1"}, {"person_id": "1", "source_system": "T", "segment": "B"})
    assert load(None, staged, DAY1).where("is_current").count() == 2


def test_two_rows_of_a_key_in_one_batch(text):
    staged = person(text, {"person_id": "1", "segment": "A"}, {"person_id": "1", "segment": "B"})
    assert rows(load(None, staged, DAY1), "segment") == [("B",)]
    with pytest.raises(ValueError):
        load(None, staged, DAY1, on_dup="error")


def test_second_change_on_a_day_closes_the_version_before_it_began(text):
    dim = None
    for segment in "AB":
        dim = load(dim, person(text, {"person_id": "1", "segment": segment}), DAY1)
    old = dim.where("not is_current").first()
    assert old.expiry_date < old.effective_date


def test_three_loads_leave_one_current_version_and_no_gap(text):
    dim = None
    for stamp, segments in ((DAY1, "AAA"), (DAY2, "ABA"), (DAY3, "BCA")):
        dim = load(dim, person(text, *[{"person_id": str(i), "segment": s} for i, s in enumerate(segments)]), stamp)
    assert dim.where("is_current").groupBy("person_id").count().where("count <> 1").isEmpty()
    history = sorted(dim.collect(), key=lambda r: (r.person_id, r.effective_date))
    for a, b in zip(history, history[1:]):
        if a.person_id == b.person_id:
            assert (b.effective_date - a.expiry_date).days == 1
    assert sorted(r.person_key for r in history) == list(range(1, len(history) + 1))


def test_counts(text):
    first = load(None, person(text, {"person_id": "1"}, {"person_id": "2"}), DAY1)
    source = scd.dim_source(person(text, {"person_id": "1", "segment": "B"}, {"person_id": "3"}), PERSON)
    changes = scd.scd2_changes(first.where("is_current"), source, PERSON, DAY2)
    assert rows(scd.merge_counts(changes)) == [(2, 1)]


LOCATION_COLUMNS = (
    "location_id source_system address_line1 address_line2 city region postal_code country latitude longitude"
)


def place(text, **values):
    base = dict.fromkeys(LOCATION_COLUMNS.split()) | {"location_id": "L", "source_system": "S", "city": "c"}
    return text(LOCATION_COLUMNS, tuple((base | values).values()))


def merge_place(target, staged, stamp):
    return scd.scd1_merge(target, scd.dim_source(staged, generic.LOCATION), generic.LOCATION, stamp)


def test_in_place_update_ignores_a_coordinate_alone_but_writes_it_along(text):
    first = merge_place(None, place(text, latitude="1.5"), DAY1)
    same = merge_place(first, place(text, latitude="2.5"), DAY2)
    assert rows(same) == rows(first)
    moved = merge_place(first, place(text, latitude="2.5", city="d"), DAY2)
    row = moved.first()
    assert (row.city, str(row.latitude), row.location_key) == ("d", "2.500000", 1)
    assert str(row.created_date) < str(row.updated_date)


def test_in_place_update_sees_changes_from_and_to_null(text):
    first = merge_place(None, place(text, region=None), DAY1)
    second = merge_place(first, place(text, region="r"), DAY2)
    third = merge_place(second, place(text, region=None), DAY3)
    assert rows(second, "region") == [("r",)] and rows(third, "region") == [(None,)]


def test_account_follows_its_customers_new_key_and_loan_does_not(spark, text):
    def customers(segment, before=None, stamp=DAY1):
        staged = text(
            "customer_id source_system first_name last_name email phone customer_segment",
            ("C1", "B", "f", "l", "e", "p", segment),
        )
        spec = replace(generic.CUSTOMER, lookups=(), absent=("location_key",))
        return scd.scd2_merge(before, scd.dim_source(staged, spec), spec, stamp)

    currency = spark.createDataFrame([(7, "EUR")], "currency_key bigint, currency_code string")
    first = customers("A")
    second = customers("B", first, DAY2)
    accounts = text(
        "account_id source_system customer_id account_type account_status open_date currency_code",
        ("A1", "B", "C1", "t", "s", "2020-01-01", "EUR"),
        ("A2", "B", "C9", "t", "s", "2020-01-01", "EUR"),
    )
    loans = text(
        "loan_id source_system customer_id loan_type principal_amount interest_rate term_months origination_date status",
        ("L1", "B", "C1", "t", "100", "1.5", "12", "2020-01-01", "open"),
    )

    def twice(staged, spec):
        dim = None
        for dim_customer, stamp in ((first, DAY1), (second, DAY2)):
            dims = {"dim_customer": dim_customer, "dim_currency": currency}
            dim = scd.scd2_merge(dim, scd.dim_source(staged, spec, dims), spec, stamp)
        return dim

    assert rows(twice(accounts, banking.ACCOUNT), "account_id", "customer_key", "is_current") == [
        ("A1", 1, False),
        ("A1", 2, True),
    ]
    assert rows(twice(loans, banking.LOAN), "loan_id", "customer_key", "is_current") == [("L1", 1, True)]


def test_location_of_an_entity_has_its_id(text):
    staged = text(
        "patient_id source_system address_line1 city region postal_code country", ("P1", "H", "a", "c", "r", "z", "k")
    )
    place_rows = scd.location_from_entity(staged, "patient_id")
    source = scd.dim_source(place_rows, generic.LOCATION)
    assert rows(source, "location_id", "city", "latitude") == [("P1", "c", None)]
    assert set(healthcare.PATIENT.compare).isdisjoint({"gender", "date_of_birth", "blood_type"})
