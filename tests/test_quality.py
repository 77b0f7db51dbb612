import datetime as dt

from helpers import rows
from pyspark.sql import Observation

from starloom.operators import marts, quality


def results(df):
    return rows(df, "check_name", "check_result", "expected_value", "actual_value")


def test_counts(spark):
    staged = spark.createDataFrame([("1",), ("2",), (None,)], "id string")
    fact = spark.range(2)
    assert results(quality.dq_row_count(staged, fact, "id", "f")) == [("staging_vs_fact_row_count", "PASS", "2", "2")]
    assert results(quality.dq_row_count(staged, fact.limit(1), "id", "f"))[0][1:] == ("FAIL", "2", "1")
    assert results(quality.dq_count_reconcile(staged, fact, "f"))[0][1:] == ("FAIL", "3", "2")
    empty = spark.range(0)
    assert results(quality.dq_count_reconcile(empty, empty, "f"))[0][1:] == ("PASS", "0", "0")


def test_keys_and_columns(spark):
    fact = spark.createDataFrame([(1, None, "a"), (1, 2, None)], "a int, b int, c string")
    assert results(quality.dq_required_keys(fact, ["a", "b"], "f"))[0][1:] == ("FAIL", "0", "1")
    assert results(quality.dq_required_keys(fact, ["a"], "f"))[0][1:] == ("PASS", "0", "0")
    assert results(quality.dq_not_null(fact, ["a", "c"], "f")) == [("not_null_a", "PASS", "0", "0"), ("not_null_c", "FAIL", "0", "1")]
    assert results(quality.dq_unique_natural(fact, ["a"], "f"))[0][1:] == ("FAIL", "0", "1")
    assert results(quality.dq_unique_natural(fact, ["a", "b"], "f"))[0][1:] == ("PASS", "0", "0")


def test_current_versions_and_orphans(spark):
    dim = spark.createDataFrame([("1", 1, False), ("1", 2, True), ("2", 3, True), ("2", 4, True)], "id string, k int, is_current boolean")
    assert results(quality.dq_current_unique(dim, ["id"], "d"))[0][1:] == ("FAIL", "0", "1")
    fact = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    assert results(quality.dq_orphans(fact, dim, "k", "f")) == [("orphaned_k", "FAIL", "0", "2")]


def test_orphans_of_several_keys_in_one_pass(spark):
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    other = spark.createDataFrame([(5,)], "own bigint")
    fact = spark.createDataFrame([(1, 5), (9, 6), (9, 5), (None, None)], "k int, o bigint")
    found = quality.dq_orphans_of(fact, {"k": (dim, "k"), "o": (other, "own")}, "f")
    assert results(found) == [("orphaned_k", "FAIL", "0", "2"), ("orphaned_o", "FAIL", "0", "1")]
    assert {r[1] for r in results(quality.dq_orphans_of(fact.limit(0), {"k": (dim, "k")}, "f"))} == {"PASS"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1


def test_observed_checks_equal_those_of_a_scan(spark):
    fact = spark.createDataFrame([(1, None, "a"), (None, 2, None), (3, 4, None), (5, None, "b")], "a int, b int, c string")
    bad = quality.F.col("a") == 5
    seen, staged = Observation(), Observation()
    counted = fact.observe(staged, *quality.staged_metrics(quality.F.col("a")))
    counted.observe(seen, *quality.written_metrics(quality.F.coalesce(bad, quality.F.lit(False)), ["a", "b"], ["c"])).collect()
    metrics = {**staged.get, **seen.get}
    assert (metrics[quality.ROWS_ACCEPTED], metrics[quality.ROWS_REJECTED], metrics[quality.STAGED]) == (3, 1, 4)
    kept = fact.where("a IS NULL OR a <> 5")
    scanned = quality.dq_row_count(fact, kept, "a", "f").unionByName(quality.dq_required_keys(kept, ["a", "b"], "f"))
    scanned = scanned.unionByName(quality.dq_not_null(kept, ["c"], "f"))
    assert results(quality.observed_checks(spark, metrics, 3, "f")) == results(scanned)
    assert results(quality.observed_checks(spark, {}, 0, "f"))[0][1] == "PASS"


def test_log_shape(spark):
    check = quality.dq_unique_natural(spark.range(1), ["id"], "f")
    log = quality.as_log(check, dt.datetime(2024, 1, 1), 7)
    assert [f.name for f in log.schema] == quality.LOG_SCHEMA.names
    assert log.first()["check_key"] == 7


def test_segment_report_counts_facts_of_current_versions_only(spark):
    dim = spark.createDataFrame([(1, "A", False), (2, "B", True)], "customer_key bigint, customer_segment string, is_current boolean")
    fact = spark.createDataFrame([(1, 5), (2, 3), (2, 4)], "customer_key bigint, n int").selectExpr("customer_key", "cast(n AS decimal(18,4)) AS net_amount")
    report = marts.sales_by_segment(fact, dim)
    assert [(r[0], float(r[1]), r[2]) for r in report.collect()] == [("B", 7.0, 2)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = marts.sales_by_segment(fact, dim)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(customer_key") == 2, "the join must reuse the aggregate's partitioning"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_monthly_report_sums_once_and_counts_every_row(spark):
    fact = spark.createDataFrame(
        [(20240101, 1, 1, "1"), (20240102, 2, 1, "2"), (20240101, 1, 2, "4"), (20240201, 3, 1, "8"), (20250101, 1, 1, "16"), (20240101, None, 1, "32")],
        "date_key int, product_key bigint, customer_key bigint, q string",
    ).selectExpr("date_key", "product_key", "customer_key", "cast(q as decimal(18,4)) quantity", "cast(q as decimal(18,4)) net_amount")
    days = spark.createDataFrame(
        [(d, 2024, d // 100 % 100, str(d // 100 % 100)) for d in (20240101, 20240102, 20240201)], "date_key int, year_number int, month_number int, month_name string"
    )
    products = spark.createDataFrame([(1, "c", "p"), (2, "c", "p"), (3, "c", None)], "product_key bigint, category string, product_name string")
    customers = spark.createDataFrame([(1, "A"), (2, "B")], "customer_key bigint, customer_segment string")
    report = marts.monthly_summary(fact, days, products, customers)
    found = {(r.month_number, r.product_name, r.customer_segment): float(r.total_net_amount) for r in report.collect()}
    assert found == {(1, "p", "A"): 3.0, (1, "p", "B"): 4.0, (2, None, "A"): 8.0} and dict(report.dtypes)["total_quantity"] == marts.TOTAL
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
