import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions import MONEY, date_key
from starloom.operators import clean
from starloom.sources.files import text_schema


def test_trim_strips_spaces_of_every_string_column_only(spark):
    df = spark.createDataFrame([(" a ", 1, "\tb ")], "x string, n int, y string")
    assert rows(clean.conform_trim(df)) == [("a", 1, "\tb")]


def test_rows_missing_any_key_column_are_dropped(text):
    df = text("a b v", ("1", "x", "p"), (None, "x", "q"), ("1", None, "r"))
    assert rows(clean.drop_null_key(df, ["a", "b"])) == [("1", "x", "p")]


def test_latest_row_per_key_wins_and_ties_go_to_the_remaining_columns(text):
    df = text("id ts v", ("1", "2024-01-01", "b"), ("1", "2024-01-02", "a"), ("2", "2024-01-01", "a"), ("2", "2024-01-01", "b"))
    assert rows(clean.dedup_latest(df, ["id"], ["ts"])) == [("1", "2024-01-02", "a"), ("2", "2024-01-01", "b")]


def test_dedup_of_key_columns_alone(text):
    assert rows(clean.dedup_latest(text("id", ("1",), ("1",), ("2",)), ["id"])) == [("1",), ("2",)]


def test_repeated_key_is_an_error_on_request(text):
    df = text("id v", ("1", "a"), ("1", "b"))
    with pytest.raises(ValueError, match="repeats the key"):
        clean.one_per_key(df, ["id"], on_dup="error")
    assert rows(clean.one_per_key(text("id v", ("1", "a"), ("1", "a")), ["id"], on_dup="error")) == [("1", "a")]


def test_dedup_sends_one_row_per_key_and_task_through_the_shuffle(spark):
    df = spark.range(0, 30000, numPartitions=6).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    deduped = clean.dedup_latest(df, ["k"], ["v"])
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("Exchange") == 1
    assert deduped.where("k = 0").collect()[0].v == 29997
    assert deduped.count() == 20001


def test_unreadable_values_become_null_or_zero(text):
    df = text("a b c d", ("12.34567", "x", "2024-01-15", "7"), (" 5 ", None, "15/01/2024", "7.5"))
    typed = clean.typed_project(df, {"a": MONEY, "b": MONEY, "c": "date", "d": "int"}, zero=["b"])
    got = [[None if v is None else str(v) for v in r] for r in typed.collect()]
    assert got == [["12.3457", "0.0000", "2024-01-15", "7"], ["5.0000", "0.0000", None, None]]


def test_date_key(text):
    df = text("d", ("2016-01-01",), ("2024-12-31",), ("no date",), (None,))
    assert [r[0] for r in df.select(date_key("d")).collect()] == [20160101, 20241231, None, None]


values = st.lists(st.tuples(st.sampled_from(["1", "x", None]), st.sampled_from(["2024-01-01", "?", None])), max_size=12)


@given(values)
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_accepted_and_rejected_are_exactly_the_input(spark, data):
    df = spark.createDataFrame(data, text_schema(["n", "d"]))
    rules = {
        "bad_n": F.col("n").try_cast("int").isNull(),
        "bad_d": F.col("d").try_cast("date").isNull(),
    }
    good, bad = clean.split_rejects(df, rules)
    assert rows(good.unionAll(bad.drop(clean.REJECT))) == sorted(data, key=repr)
    assert rows(good) == sorted([r for r in data if r == ("1", "2024-01-01")], key=repr)
    reasons = {(r.n, r.d): r[clean.REJECT] for r in bad.collect()}
    assert all(why == ("bad_n" if n != "1" else "bad_d") for (n, _), why in reasons.items())
