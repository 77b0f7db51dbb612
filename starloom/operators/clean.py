"""Conforming staged rows: trim, key check, latest row per key, typing, rejects."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import default_zero, try_as

REJECT = "reject_reason"


def conform_trim(df: DataFrame) -> DataFrame:
    """Trim every string column, whichever they are."""
    return df.select(
        *[
            F.trim(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def drop_null_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys))


def dedup_latest(
    df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = (), first_by: Sequence[str] = ()
) -> DataFrame:
    """Keep one row per key: the first by ``first_by``, then the latest, ties settled by all other columns.

    Spark limits each key to one row per task before the shuffle, so a key that
    holds a large share of the rows sends one row per task and no more.
    """
    rest = [c for c in df.columns if c not in (*keys, *latest_by, *first_by)]
    order = [F.col(c).asc_nulls_last() for c in first_by] + [F.col(c).desc_nulls_last() for c in (*latest_by, *rest)]
    if not order:
        return df.dropDuplicates(list(keys))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.select("*", rank.alias("_rank")).where("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def one_per_key(
    df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = (), on_dup: str = "latest"
) -> DataFrame:
    """``dedup_latest``, or with ``on_dup="error"`` a refusal of batches that repeat a key."""
    if on_dup == "latest":
        return dedup_latest(df, keys, latest_by)
    if on_dup != "error":
        raise ValueError(f"on_dup must be 'latest' or 'error', not {on_dup!r}")
    if not duplicate_keys(df.dropDuplicates(), keys).isEmpty():
        raise ValueError(f"batch repeats the key ({', '.join(keys)})")
    return df.dropDuplicates()


def distinct_source(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def typed_project(
    df: DataFrame, types: Mapping[str, str], sources: Mapping[str, str] | None = None, zero: Iterable[str] = ()
) -> DataFrame:
    """Project and cast staged strings; an unreadable value becomes NULL, or 0 if in ``zero``."""
    sources = sources or {}
    zero = set(zero)

    def cast(name: str, type_name: str) -> Column:
        source = sources.get(name, name)
        if name in zero:
            return default_zero(source, type_name)
        return F.col(source) if type_name == "string" else try_as(source, type_name)

    return df.select(*[cast(name, type_name).alias(name) for name, type_name in types.items()])


def flag_rejects(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the reason of the first rule a row breaks; NULL for rows that break none."""
    reason = F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules.items()], F.lit(None).cast("string"))
    return df.withColumn(REJECT, reason)


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows; together they are exactly the input."""
    flagged = flag_rejects(df, rules)
    return flagged.where(F.col(REJECT).isNull()).drop(REJECT), flagged.where(F.col(REJECT).isNotNull())


def conform(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()) -> DataFrame:
    """The cleansed layer: trimmed, keyed, one row per natural key."""
    return dedup_latest(drop_null_key(conform_trim(df), keys), keys, latest_by)
