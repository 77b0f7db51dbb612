from helpers import rows
from pyspark.sql import functions as F

from starloom.operators.keys import last_key, numbered, placed, surrogate_keys, task_counts
from starloom.session import materialize


def test_keys_follow_the_order_and_continue_after_the_last(spark):
    shuffled = spark.range(1000, numPartitions=7).select(F.format_string("%05d", "id").alias("k")).orderBy(F.rand(1))
    keyed = surrogate_keys(shuffled, "sk", ["k"], start=50)
    assert [r.sk for r in keyed.orderBy("k").collect()] == list(range(51, 1051))
    assert last_key(keyed, "sk") == 1050 and last_key(keyed.limit(0), "sk") == 0


def test_keys_are_dense_when_one_prefix_holds_most_rows(spark):
    data = spark.range(3000, numPartitions=5).selectExpr("if(id % 3 = 0, 'a', 'z') AS s", "cast(id AS string) AS k")
    keyed = surrogate_keys(data, "sk", ["s", "k"])
    assert keyed.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first() == (1, 3000, 3000)


def test_keys_read_twice_are_the_same(spark):
    keyed = surrogate_keys(spark.range(200).selectExpr("uuid() AS k"), "sk", ["k"])
    assert rows(keyed) == rows(keyed)


def test_no_rows(spark):
    assert surrogate_keys(spark.range(0).selectExpr("cast(id AS string) AS k"), "sk", ["k"]).count() == 0


def test_written_rows_are_numbered_without_gaps_and_alike_whenever_they_are_read(spark):
    made = spark.range(100, numPartitions=4).selectExpr("uuid() AS k")  # other rows each time the plan is run
    written = materialize(placed(made), "placed")
    keyed = numbered(written, "sk", 10)
    assert keyed.columns == ["k", "sk"] and sorted(r.sk for r in keyed.collect()) == list(range(11, 111))
    assert rows(keyed) == rows(keyed.repartition(3)) == rows(numbered(written, "sk", 10, task_counts(written)))


def test_some_rows_of_each_task_are_numbered(spark):
    ordered = spark.range(1000).selectExpr("id", "id % 3 = 0 AS new").repartitionByRange(5, "new").sortWithinPartitions(F.desc("new"), "id")
    written = materialize(placed(ordered), "placed")
    new = numbered(written.where("new"), "sk", 7, task_counts(written, "new"))
    assert sorted(r.sk for r in new.collect()) == list(range(8, 8 + 334))
