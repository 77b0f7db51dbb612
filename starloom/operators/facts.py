"""Fact loads: type, one row per key, skip what is loaded, fetch keys, split rejects."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starloom.functions import MONEY, RATE, date_key, order_discount, snapshot_key, try_as
from starloom.operators.clean import REJECT, drop_null_key, flag_rejects, one_per_key, typed_project
from starloom.operators.lookups import lookup_all
from starloom.session import SPLIT_BYTES, input_bytes, materialize, scratch_path, scratch_scope, small_splits
from starloom.spec import FactSpec, LoadStamp

SLICE_ROWS = 40_000_000  # staged rows that go through the shuffles of a load at a time
LARGE_INPUT = 512 * 1024 * 1024  # bytes of files from which facts are written slice by slice
_DATE_TEXT = "_date_text"
_DAY, _SOUND = "_day", "_sound"
SET_ASIDE = "set_aside"


def not_loaded(
    rows: DataFrame, loaded: DataFrame | None, keys: Sequence[str], batch: DataFrame | None = None
) -> DataFrame:
    """Rows whose natural key is not among the loaded facts.

    The loaded facts are far larger than the batch. They are first cut to the
    batch's own keys, which Spark does with a broadcast of these keys while they
    are few, so a small batch moves no loaded fact. ``batch`` gives the rows to
    take the keys from, where those are cheaper to compute than ``rows``.
    """
    if loaded is None:
        return rows
    wanted = (rows if batch is None else batch).select(*keys).distinct()
    seen = loaded.select(*keys).join(wanted, list(keys), "left_semi")
    return rows.join(seen, list(keys), "left_anti")


def fact_append(
    loaded: DataFrame | None, rows: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = (), on_dup: str = "latest"
) -> DataFrame:
    """The rows to append: one per natural key, none already loaded."""
    return not_loaded(one_per_key(rows, keys, latest_by, on_dup), loaded, keys, batch=rows)


def typed_batch(staged: DataFrame, spec: FactSpec) -> DataFrame:
    """The staged rows that ``resolve_typed`` needs, cast, and whether each can be read. All rows stay."""
    kept = [c for c in _ordered_by(spec) if c not in spec.columns]
    types = {**spec.columns, **dict.fromkeys([*_parents(spec), *kept], "string")}
    sources = dict(spec.sources)
    if spec.date_source:
        types[_DATE_TEXT] = "string"
        sources[_DATE_TEXT] = spec.date_source
    for name in _typed_keys(spec):
        types[_text(name)] = "string"
        sources[_text(name)] = spec.sources.get(name, name)
    typed = typed_project(staged, types, sources, spec.zero)
    if spec.date_source:
        typed = typed.withColumn(_DAY, try_as(_DATE_TEXT, "date"))
    return typed.withColumn(_SOUND, ~F.greatest(*_unreadable(spec).values(), F.lit(False)))


def resolve_typed(
    typed: DataFrame,
    spec: FactSpec,
    dims: Mapping[str, DataFrame],
    stamp: LoadStamp,
    loaded: DataFrame | None = None,
    on_dup: str = "latest",
    hot: Mapping[str, Sequence[int]] | None = None,
) -> DataFrame:
    """``resolve_facts`` of rows that are typed already; a key they have is kept. ``hot`` has the hashes of hot key values by lookup."""
    rows = drop_null_key(typed, spec.natural_key)
    unkeyed = typed.where(F.greatest(*[F.col(c).isNull() for c in spec.natural_key], F.lit(False)))
    day = [_DAY] if spec.date_source else []
    # The id comes before the source system, which is the same in most rows: what is sorted is compared by its first column.
    rows = fact_append(loaded, rows, spec.natural_key[::-1], [_SOUND, *day, *_ordered_by(spec)], on_dup)
    rows = lookup_all(rows, spec.lookups, dims, keep_unmatched=True, hot=hot, spread_by=spec.natural_key)
    unkeyed = unkeyed.withColumns({lk.output: F.lit(None).cast(rows.schema[lk.output].dataType) for lk in spec.lookups})
    rows = rows.unionByName(unkeyed.select(*rows.columns))
    key = date_key(_DATE_TEXT) if spec.date_source else snapshot_key(stamp.load_date)
    rows = rows.withColumn(spec.date_key, key)
    rows = rows.withColumns({c: F.lit(None).cast("bigint") for c in spec.null_keys})
    own = [spec.key] if spec.key in typed.columns else []
    return flag_rejects(rows, reject_rules(spec)).select(*own, *spec.output_columns, *_evidence(spec), REJECT)


def resolve_facts(
    staged: DataFrame,
    spec: FactSpec,
    dims: Mapping[str, DataFrame],
    stamp: LoadStamp,
    loaded: DataFrame | None = None,
    on_dup: str = "latest",
) -> DataFrame:
    """New facts with their keys and the reason a row cannot be loaded, if there is one.

    Deduplication and the check against loaded facts share one shuffle on the
    natural key and come before the lookups, which then see new rows only. Of the
    rows of a key one that can be read wins over one that cannot, then the latest
    by its typed date. Rows without a readable natural key are all rejected: they
    take no part in the shuffle, and no lookup is made for them.
    """
    return resolve_typed(typed_batch(staged, spec), spec, dims, stamp, loaded, on_dup)


def given_key(spec: FactSpec) -> Column:
    """The natural key's id, as it came, in the rows of ``typed_batch``."""
    name = spec.natural_key[1]
    return F.col(_text(name) if name in _typed_keys(spec) else name)


def _parents(spec: FactSpec) -> list[str]:
    return [c for lk in spec.lookups for c in lk.source if c not in spec.columns]


def _ordered_by(spec: FactSpec) -> list[str]:
    return [c for c in spec.latest_by if c != spec.date_source]


def batch_outcomes(staged: DataFrame, resolved: DataFrame) -> DataFrame:
    """How many staged rows were accepted, rejected for each reason, and set aside: rows of a key whose other
    row was taken, or that is loaded already. The numbers add up to the staged rows."""
    outcome = F.coalesce(F.col(REJECT), F.lit("accepted")).alias("outcome")
    taken = resolved.groupBy(outcome).agg(F.count("*").alias("n"))
    parts = staged.agg(F.count("*").alias("n")).unionAll(resolved.agg((-F.count("*")).alias("n")))
    return taken.unionByName(parts.agg(F.sum("n").alias("n")).select(F.lit(SET_ASIDE).alias("outcome"), "n"))


def slices(rows: int) -> int:
    """In how many slices a batch is put through a load's shuffles, so that what these keep on disk follows from SLICE_ROWS, not from the batch."""
    return max(1, math.ceil(rows / SLICE_ROWS))


def in_slice(df: DataFrame, keys: Sequence[str], number: int, of: int) -> DataFrame:
    """The rows of one slice: all of a key are in the same one, and every row is in one. The name in the hash keeps it apart from those
    that deal rows to buckets and salts."""
    return df if of == 1 else df.where(F.pmod(F.xxhash64(*keys, F.lit("slice")), F.lit(of)) == number)


def batch_months(staged: DataFrame, spec: FactSpec) -> list[int]:
    """The months of a batch as yyyyMM: as many as the calendar has, at most."""
    month = F.floor(date_key(spec.date_source) / 100).cast("int").alias("month")
    return sorted(r.month for r in staged.select(month).where("month IS NOT NULL").distinct().collect())


def load_facts(
    staged: DataFrame,
    spec: FactSpec,
    dims: Mapping[str, DataFrame],
    stamp: LoadStamp,
    loaded: DataFrame | None = None,
    on_dup: str = "latest",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The facts to append, without the rejected rows; all their columns or those asked for.

    Facts of large files are written to a scratch table. The staged rows are typed and written once, and resolved slice by slice:
    in one plan the shuffles for staging, deduplication and every lookup would lie on disk at the same time.
    """
    columns = columns or spec.output_columns
    if input_bytes(staged) <= LARGE_INPUT:
        return accepted(resolve_facts(staged, spec, dims, stamp, loaded, on_dup), spec).select(*columns)
    spark, natural = staged.sparkSession, spec.natural_key
    path = scratch_path(spark, f"facts-{spec.name}")
    with scratch_scope(spark), small_splits(spark):
        came = Observation()
        batch = materialize(typed_batch(staged, spec).observe(came, F.count("*").alias("rows")), f"batch-{spec.name}", SPLIT_BYTES // 2)
        of = slices(came.get.get("rows", 0))
        for number in range(of):
            known = None if loaded is None else in_slice(loaded, natural, number, of)
            found = accepted(resolve_typed(in_slice(batch, natural, number, of), spec, dims, stamp, known, on_dup), spec).select(*columns)
            found.write.mode("append").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def accepted(resolved: DataFrame, spec: FactSpec) -> DataFrame:
    return resolved.where(F.col(REJECT).isNull()).select(*spec.output_columns)


def rejected(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col(REJECT).isNotNull())


def reject_rules(spec: FactSpec) -> dict[str, Column]:
    """Why a row cannot be loaded, the first reason that holds: no key, an unreadable one, a bad value, an unknown parent."""
    typed = _typed_keys(spec)
    given = [F.col(_text(c) if c in typed else c) for c in spec.natural_key]
    rules = {"missing_key": F.greatest(*[c.isNull() for c in given], F.lit(False))}
    rules |= {f"bad_{c}": F.col(c).isNull() for c in typed}
    rules |= _unreadable(spec)
    rules |= {f"unknown_{lk.dim}": F.col(lk.output).isNull() for lk in spec.lookups if lk.required}
    return rules


def _unreadable(spec: FactSpec) -> dict[str, Column]:
    """The rules that a row can be judged by alone."""
    rules = {"bad_date": F.col(_DAY).isNull()} if spec.date_source else {}
    return rules | {f"bad_{c}": F.col(c).isNull() for c in spec.required}


def _typed_keys(spec: FactSpec) -> list[str]:
    """Columns of the natural key that may be unreadable."""
    return [c for c in spec.natural_key if spec.columns[c] != "string"]


def _text(name: str) -> str:
    return f"_{name}_text"


def _evidence(spec: FactSpec) -> list[str]:
    """Staged values that explain a reject: the ids looked up, the date and typed keys as they came."""
    ids = [c for lk in spec.lookups for c in lk.source if c not in spec.columns]
    dates = [_DATE_TEXT] if spec.date_source else []
    return list(dict.fromkeys([*ids, *dates, *map(_text, _typed_keys(spec))]))


def order_amounts(orders: DataFrame) -> DataFrame:
    """Discount, tax and net amount of order lines that carry only a discount percentage; NULL where too large for the column."""
    typed = orders.withColumns(
        {
            "quantity": try_as("quantity", MONEY),
            "unit_price": try_as("unit_price", MONEY),
            "discount_pct": try_as("discount_pct", RATE),
        }
    )
    priced = typed.withColumn("discount_amount", order_discount(F.col("quantity"), F.col("unit_price"), F.col("discount_pct")))
    net = F.col("quantity") * F.col("unit_price") - F.col("discount_amount")
    return priced.withColumns(
        {"net_amount": net.try_cast(MONEY), "tax_amount": F.lit(0).cast(MONEY), "order_line_number": F.lit(1)}
    )
