"""Dimension lookups: natural key in the source to surrogate key in the dimension.

No side is hinted: Spark broadcasts the dimension's key columns when their
measured size is under its threshold and shuffles both sides otherwise, and
adaptive execution splits a shuffle partition made large by a hot key.
``salted_lookup`` does the same without relying on adaptive execution. A load takes hot values
from a sketch made while its batch is written (``hot_sketch``) and spreads them in ``lookup_key``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.spec import Lookup

HOT_SHARE = 0.02  # share of the rows that makes a key value hot
HOT_SKETCH = 10_000  # key values that a sketch tracks at a time
_HASHED = (T.StringType, T.IntegerType, T.LongType)


def current_filter(dim: DataFrame) -> DataFrame:
    return dim.where("is_current")


def pick_keys(dim: DataFrame, lookup: Lookup) -> DataFrame:
    """Only the join and fetched columns of the dimension, under names that cannot collide."""
    rows = current_filter(dim) if lookup.current_only else dim
    return rows.select(
        *[F.col(c).alias(f"_on_{c}") for c in lookup.target],
        F.col(lookup.key).alias(lookup.output),
    )


def rename_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    lookup: Lookup,
    keep_unmatched: bool = False,
    hot: Sequence[int] = (),
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Fetch the key; unmatched rows go when the lookup is required, else get a NULL key.

    Key values whose hashes are ``hot`` (``hot_hashes``) are dealt to ``lookup.salts`` places by ``spread_by``, NULL too, and only
    their dimension rows are repeated. That needs the same types on both sides, so that equal values have equal hashes; where
    they differ nothing is spread. The rows are the same either way.
    """
    keys = pick_keys(dim, lookup)
    how = "inner" if lookup.required and not keep_unmatched else "left"
    targets = [f"_on_{c}" for c in lookup.target]
    kinds = [df.schema[c].dataType for c in lookup.source]
    if not hot or lookup.salts < 2 or kinds != [keys.schema[c].dataType for c in targets] or not all(isinstance(k, _HASHED) for k in kinds):
        return df.join(keys, _on(df, keys, lookup), how).drop(*_joined(lookup))

    def is_hot(columns: Sequence[str]) -> Column:
        return F.xxhash64(*columns).isin(list(hot))

    salt = F.when(is_hot(lookup.source), F.pmod(F.xxhash64(*spread_by), F.lit(lookup.salts)).cast("int")).otherwise(0)
    places = F.when(is_hot(targets), F.sequence(F.lit(0), F.lit(lookup.salts - 1))).otherwise(F.array(F.lit(0)))
    rows, keys = df.withColumn("_salt", salt), keys.withColumn("_on_salt", F.explode(places))
    on = [*_on(rows, keys, lookup), rows["_salt"] == keys["_on_salt"]]
    return rows.join(keys, on, how).drop("_salt", "_on_salt", *_joined(lookup))


def lookup_all(
    df: DataFrame,
    lookups: Iterable[Lookup],
    dims: Mapping[str, DataFrame],
    keep_unmatched: bool = False,
    hot: Mapping[str, Sequence[int]] | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    for lookup in lookups:
        df = lookup_key(df, dims[lookup.dim], lookup, keep_unmatched, (hot or {}).get(lookup.output, ()), spread_by)
    return df


def hot_sketch(lookup: Lookup) -> Column:
    """An aggregate, to be observed or selected, of the lookup's most frequent key hashes: HOT_SKETCH of them are tracked, however many there are."""
    columns = ", ".join(f"`{c}`" for c in lookup.source)
    return F.expr(f"approx_top_k(xxhash64({columns}), {math.ceil(1 / HOT_SHARE)}, {HOT_SKETCH})")


def hot_hashes(sketch: Iterable[tuple[int, int]] | None, rows: int) -> list[int]:
    """Hashes that hold HOT_SHARE of the rows by their sketch, at most ``1 / HOT_SHARE`` of them."""
    return [item for item, count in sketch or () if count >= max(2, rows * HOT_SHARE)]


def hot_values(df: DataFrame, columns: Sequence[str], share: float) -> DataFrame:
    """Key values holding at least ``share`` of all rows: at most ``1 / share`` of them."""
    counts = df.groupBy(*columns).agg(F.count("*").alias("_rows"))
    least = max(1, math.ceil(df.count() * share))
    return counts.where(F.col("_rows") >= least).drop("_rows")


def salted_lookup(
    df: DataFrame, dim: DataFrame, lookup: Lookup, spread_by: Sequence[str], share: float = 0.01, salts: int = 64
) -> DataFrame:
    """``lookup_key`` with each hot key value spread over ``salts`` shuffle partitions.

    Only the dimension rows of hot values are repeated, once per salt. Which
    values are hot comes from a pre-aggregated count of the key columns alone;
    there are at most ``1 / share`` of them, which bounds the broadcast.
    """
    hot = hot_values(df.select(*lookup.source), lookup.source, share)
    hot = hot.select(*[F.col(c).alias(f"_hot_{c}") for c in lookup.source], F.lit(True).alias("_hot"))

    def mark(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        same = [rows[c].eqNullSafe(hot[f"_hot_{s}"]) for c, s in zip(columns, lookup.source)]
        return rows.join(F.broadcast(hot), same, "left").drop(*[f"_hot_{s}" for s in lookup.source])

    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(F.lit(0))
    facts = mark(df, lookup.source).withColumn("_salt", salt.cast("int")).drop("_hot")
    all_salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    keys = pick_keys(dim, lookup)
    keys = mark(keys, [f"_on_{c}" for c in lookup.target]).withColumn("_on_salt", F.explode(all_salts)).drop("_hot")
    on = [*_on(facts, keys, lookup), facts["_salt"] == keys["_on_salt"]]
    how = "inner" if lookup.required else "left"
    return facts.join(keys, on, how).drop("_salt", "_on_salt", *_joined(lookup))


def _on(df: DataFrame, keys: DataFrame, lookup: Lookup) -> list[Column]:
    return [df[s] == keys[f"_on_{t}"] for s, t in zip(lookup.source, lookup.target)]


def _joined(lookup: Lookup) -> list[str]:
    return [f"_on_{c}" for c in lookup.target]
