from helpers import rows
from pyspark.sql import functions as F

from starloom.operators import lookups
from starloom.plans.generic import TO_CUSTOMER, TO_EMPLOYEE
from starloom.spec import Lookup


def customers(spark):
    data = [("1", "S", 10, False), ("1", "S", 11, True), ("2", "S", 20, True), ("1", "T", 30, True)]
    return spark.createDataFrame(data, "customer_id string, source_system string, customer_key bigint, is_current boolean")


def test_required_lookup_finds_the_current_version_of_the_same_source(spark, text):
    staged = text("customer_id source_system n", ("1", "S", "a"), ("1", "T", "b"), ("9", "S", "c"), (None, "S", "d"))
    found = lookups.lookup_key(staged, customers(spark), TO_CUSTOMER)
    assert rows(found, "n", "customer_key") == [("a", 11), ("b", 30)]
    kept = lookups.lookup_key(staged, customers(spark), TO_CUSTOMER, keep_unmatched=True)
    assert rows(kept, "n", "customer_key") == [("a", 11), ("b", 30), ("c", None), ("d", None)]


def test_optional_lookup_keeps_every_row(spark, text):
    staff = spark.createDataFrame(
        [("7", "S", 70, True)], "employee_id string, source_system string, employee_key bigint, is_current boolean"
    )
    staged = text("employee_id source_system n", ("7", "S", "a"), ("8", "S", "b"))
    assert rows(lookups.lookup_key(staged, staff, TO_EMPLOYEE), "n", "employee_key") == [("a", 70), ("b", None)]


def test_salted_lookup_equals_the_plain_one_with_a_hot_key_and_hot_nulls(spark):
    facts = spark.range(3000, numPartitions=4).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id % 50) END AS code"
    )
    dim = spark.range(40).selectExpr("concat('k', id) AS code", "id AS code_key").unionAll(
        spark.createDataFrame([("hot", 99)], "code string, code_key bigint")
    )
    for required in (True, False):
        by_code = Lookup("d", ("code",), ("code",), "code_key", required=required, current_only=False)
        plain = lookups.lookup_key(facts, dim, by_code)
        salted = lookups.salted_lookup(facts, dim, by_code, ["id"], share=0.05, salts=8)
        assert rows(salted.select(*plain.columns)) == rows(plain)


def test_salting_spreads_a_hot_key_over_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = spark.range(4000, numPartitions=4).selectExpr("id", "'hot' AS code")
        dim = spark.createDataFrame([("hot", 1)], "code string, code_key bigint")
        by_code = Lookup("d", ("code",), ("code",), "code_key", current_only=False)
        salted = lookups.salted_lookup(facts, dim, by_code, ["id"], salts=16)
        used = salted.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(used) > 1 and sum(r["count"] for r in used) == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_values_from_a_sketch_are_spread_and_change_no_row(spark):
    facts = spark.range(3000, numPartitions=4).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id % 50) END AS code"
    )
    dim = spark.range(40).selectExpr("concat('k', id) AS code", "id AS code_key").unionAll(
        spark.createDataFrame([("hot", 99)], "code string, code_key bigint")
    )
    for required in (True, False):
        by_code = Lookup("d", ("code",), ("code",), "code_key", required=required, current_only=False, salts=8)
        hot = lookups.hot_hashes(facts.agg(lookups.hot_sketch(by_code)).first()[0], 3000)
        assert len(hot) == 2, "the hot value and NULL"
        plain = lookups.lookup_key(facts, dim, by_code)
        spread = lookups.lookup_key(facts, dim, by_code, hot=hot, spread_by=["id"])
        assert "_salt" in spread._jdf.queryExecution().analyzed().toString()
        assert rows(spread.select(*plain.columns)) == rows(plain)
    numbers = dim.selectExpr("code_key AS code", "code_key")
    by_number = Lookup("d", ("code",), ("code",), "code_key", current_only=False, salts=8)
    ids = facts.selectExpr("id", "cast(id % 4 AS int) AS code")
    other = lookups.lookup_key(ids, numbers, by_number, hot=[1, 2], spread_by=["id"])
    assert "_salt" not in other._jdf.queryExecution().analyzed().toString(), "types differ, so do hashes"
    assert lookups.hot_hashes([], 0) == [] and lookups.hot_hashes([(7, 1)], 1) == []


def test_hot_values_are_bounded_by_their_share(spark):
    facts = spark.range(1000).selectExpr("if(id < 400, 'a', cast(id AS string)) AS k")
    assert rows(lookups.hot_values(facts, ["k"], 0.1)) == [("a",)]


def test_rename_prefix(text):
    assert lookups.rename_prefix(text("a b", ("1", "2")), "cur_").columns == ["cur_a", "cur_b"]
