"""Data-quality checks, each giving rows in the shape of the quality log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import pass_fail
from starloom.functions.columns import utc_time
from starloom.operators.clean import duplicate_keys
from starloom.spec import struct_of

LOG_SCHEMA = struct_of(
    {
        "check_key": "bigint",
        "check_date": "timestamp",
        "check_name": "string",
        "object_name": "string",
        "check_result": "string",
        "expected_value": "string",
        "actual_value": "string",
    }
)


# The names of the checks below are fixed values.


def dq_row_count(staged: DataFrame, fact: DataFrame, key: str, name: str) -> DataFrame:
    """PASS when the fact holds at least as many rows as were staged with a key."""
    both = _counts(staged.where(F.col(key).isNotNull()), fact)
    return _check(both, "staging_vs_fact_row_count", name, F.col("actual") >= F.col("expected"))


def dq_count_reconcile(staged: DataFrame, loaded: DataFrame, name: str) -> DataFrame:
    """PASS when exactly as many rows were loaded as staged."""
    return _check(_counts(staged, loaded), "staged_equals_loaded", name, F.col("actual") == F.col("expected"))


def dq_required_keys(fact: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """PASS when no row lacks a mandatory dimension key."""
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return _none(fact.agg(F.count_if(missing).alias("actual")), "required_dimension_keys_not_null", name)


def dq_not_null(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """A check per column, all counted in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    per_column = counted.unpivot([], list(columns), "column_name", "actual")
    check = F.concat(F.lit("not_null_"), F.col("column_name"))
    return _none(per_column, check, name)


def dq_unique_natural(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return _none(_count(duplicate_keys(df, keys)), "natural_key_unique", name)


def dq_current_unique(dim: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return _none(_count(duplicate_keys(dim.where("is_current"), keys)), "one_current_row_per_key", name)


def dq_orphans(fact: DataFrame, dim: DataFrame, key: str, name: str, dim_key: str | None = None) -> DataFrame:
    """PASS when every non-NULL key of the fact is in the dimension.

    Facts are counted per key before the join, so a hot key is one row in it.
    """
    used = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    known = dim.select(F.col(dim_key or key).alias(key))
    orphans = used.join(known, key, "left_anti")
    return _none(orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("actual")), f"orphaned_{key}", name)


def validate_fact(
    staged: DataFrame, fact: DataFrame, key: str, required: Sequence[str], name: str
) -> DataFrame:
    """The two checks run after every fact load."""
    return dq_row_count(staged, fact, key, name).unionByName(dq_required_keys(fact, required, name))


def validate_facts(loads: Mapping[str, tuple[DataFrame, DataFrame, str, Sequence[str]]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [validate_fact(*load, name) for name, load in loads.items()])


def dq_orphans_of(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]], name: str) -> DataFrame:
    """``dq_orphans`` of several keys, given as fact column: (dimension, its key), in one pass over the fact."""
    keys = list(dims)
    each = fact.select(*[F.col(k).cast("bigint") for k in keys]).unpivot([], keys, "key_name", "key").where("key IS NOT NULL")
    used = each.groupBy("key_name", "key").agg(F.count("*").alias("rows"))
    known = reduce(DataFrame.unionAll, [dim.select(F.lit(k).alias("key_name"), F.col(own).cast("bigint").alias("key")) for k, (dim, own) in dims.items()])
    orphans = used.join(known, ["key_name", "key"], "left_anti").groupBy("key_name").agg(F.sum("rows").alias("actual"))
    every = fact.sparkSession.createDataFrame([(k,) for k in keys], "key_name string")
    counted = every.join(F.broadcast(orphans), "key_name", "left").na.fill(0, ["actual"])  # a row a key
    return _none(counted, F.concat(F.lit("orphaned_"), F.col("key_name")), name)


# What a load counts of the rows it writes, while it writes them, and the checks this gives.

STAGED, KEYED = "staged", "keyed"
ROWS_ACCEPTED, ROWS_REJECTED = "accepted", "rejected"
_WITHOUT, _NULLS = "without_key", "null_"


def staged_metrics(key: Column) -> list[Column]:
    return [F.count("*").alias(STAGED), F.count_if(key.isNotNull()).alias(KEYED)]


def written_metrics(is_rejected: Column, keys: Sequence[str], columns: Sequence[str]) -> list[Column]:
    """Accepted and rejected rows, accepted rows that lack one of the keys, and NULLs of each column among the accepted ones."""
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return [
        F.count_if(~is_rejected).alias(ROWS_ACCEPTED),
        F.count_if(is_rejected).alias(ROWS_REJECTED),
        F.count_if(~is_rejected & missing).alias(_WITHOUT),
        *[F.count_if(~is_rejected & F.col(c).isNull()).alias(_NULLS + c) for c in columns],
    ]


def observed_checks(spark: SparkSession, metrics: Mapping[str, int], rows_current: int, name: str) -> DataFrame:
    """The checks of a fact load from what it observed and the rows the fact holds after it; reads no table.

    Rows of earlier loads are not changed by a load, and were checked by theirs.
    """
    nulls = [(f"not_null_{c.removeprefix(_NULLS)}", 0, n) for c, n in metrics.items() if c.startswith(_NULLS)]
    counted = [
        ("staging_vs_fact_row_count", metrics.get(KEYED, 0), rows_current),
        ("required_dimension_keys_not_null", 0, metrics.get(_WITHOUT, 0)),
        *nulls,
    ]
    rows = spark.createDataFrame(counted, "check_name string, expected bigint, actual bigint")
    at_least = F.col("check_name") == "staging_vs_fact_row_count"
    return _check(rows, F.col("check_name"), name, F.when(at_least, F.col("actual") >= F.col("expected")).otherwise(F.col("actual") == F.col("expected")))


def as_log(checks: DataFrame, checked_at: dt.datetime, first_key: int = 1) -> DataFrame:
    """Checks as rows of the quality log."""
    key = F.monotonically_increasing_id() + F.lit(first_key)
    return checks.withColumns({"check_key": key, "check_date": utc_time(checked_at)}).select(*LOG_SCHEMA.names)


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("actual"))


def _counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Both counts in one row, from one aggregate over the two tagged inputs."""
    tagged = expected.select(F.lit(1).alias("e"), F.lit(0).alias("a")).unionAll(
        actual.select(F.lit(0).alias("e"), F.lit(1).alias("a"))
    )
    total = tagged.agg(F.sum("e").alias("expected"), F.sum("a").alias("actual"))
    return total.na.fill(0)


def _none(counted: DataFrame, check: str | Column, name: str) -> DataFrame:
    return _check(counted.withColumn("expected", F.lit(0)), check, name, F.col("actual") == 0)


def _check(counted: DataFrame, check: str | Column, name: str, passed: Column) -> DataFrame:
    return counted.select(
        (F.lit(check) if isinstance(check, str) else check).alias("check_name"),
        F.lit(name).alias("object_name"),
        pass_fail(passed).alias("check_result"),
        F.col("expected").cast("string").alias("expected_value"),
        F.col("actual").cast("string").alias("actual_value"),
    )
