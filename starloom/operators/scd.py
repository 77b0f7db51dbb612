"""Slowly-changing dimensions on immutable tables.

Natural keys are unique on both sides of the compare join, so no join key is
hot, and one full outer join yields every outcome for a key in a single pass.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import changed
from starloom.operators.clean import REJECT, drop_null_key, flag_rejects, one_per_key, typed_project
from starloom.operators.keys import last_key, surrogate_keys
from starloom.operators.lookups import lookup_all
from starloom.session import materialize
from starloom.spec import HIGH_DATE, DimSpec, LoadStamp

ACTION = "merge_action"
INSERT, UPDATE, EXPIRE, KEEP = "insert", "update", "expire", "keep"


def empty_dim(spark, spec: DimSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema())


def dim_source(
    staged: DataFrame,
    spec: DimSpec,
    dims: Mapping[str, DataFrame] | None = None,
    latest_by: tuple[str, ...] = (),
    on_dup: str = "latest",
) -> DataFrame:
    """Staged rows as rows of the dimension: keyed, one per key, cast, parent keys fetched.

    Rows without a mandatory parent are left out; ``dim_rejects`` gives them.
    """
    return dim_accepted(flagged_source(staged, spec, dims, latest_by, on_dup), spec)


def dim_rejects(
    staged: DataFrame, spec: DimSpec, dims: Mapping[str, DataFrame] | None = None, latest_by: tuple[str, ...] = ()
) -> DataFrame:
    """Staged rows left out: those without a natural key, all of them, and those whose mandatory parent is unknown. Natural key,
    parent ids and the reason."""
    flagged = flagged_source(staged, spec, dims, latest_by)
    return dim_refused(flagged, spec).unionByName(keyless(staged, spec))


def dim_accepted(flagged: DataFrame, spec: DimSpec) -> DataFrame:
    rows = flagged.where(F.col(REJECT).isNull())
    rows = rows.withColumns({c: F.lit(None).cast(spec.columns[c]) for c in spec.absent})
    return rows.select(*spec.natural_key, *spec.attributes)


def dim_refused(flagged: DataFrame, spec: DimSpec) -> DataFrame:
    return flagged.where(F.col(REJECT).isNotNull()).select(*_reject_columns(spec), REJECT)


def keyless(staged: DataFrame, spec: DimSpec) -> DataFrame:
    """Staged rows that lack a part of the natural key, as rejects."""
    rows = staged.where(F.greatest(*[F.col(c).isNull() for c in spec.natural_key], F.lit(False)))
    return rows.select(*_reject_columns(spec), F.lit("missing_key").alias(REJECT))


def _reject_columns(spec: DimSpec) -> list[str]:
    fetched = {lk.output for lk in spec.lookups}
    return list(dict.fromkeys([*spec.natural_key, *[c for lk in spec.lookups for c in lk.source if c not in fetched]]))


def needed_columns(staged: DataFrame, spec: DimSpec, latest_by: tuple[str, ...] = ()) -> DataFrame:
    """The staged columns that a dimension's load looks at; every row stays."""
    types = _types(spec)
    return staged.select(*types, *[c for c in latest_by if c not in types])


def flagged_source(
    staged: DataFrame, spec: DimSpec, dims: Mapping[str, DataFrame] | None, latest_by: tuple[str, ...] = (), on_dup: str = "latest"
) -> DataFrame:
    """Staged rows as rows of the dimension, one per key, with the reason a row cannot be taken, if there is one."""
    rows = needed_columns(drop_null_key(staged, spec.natural_key), spec, latest_by)
    rows = one_per_key(rows, spec.natural_key, latest_by, on_dup)
    rows = lookup_all(typed_project(rows, _types(spec)), spec.lookups, dims or {}, keep_unmatched=True)
    return flag_rejects(rows, {f"unknown_{lk.dim}": F.col(lk.output).isNull() for lk in spec.lookups if lk.required})


def _types(spec: DimSpec) -> dict[str, str]:
    own = spec.typed_columns()
    parents = [c for lk in spec.lookups for c in lk.source if c not in own]
    return own | dict.fromkeys(dict.fromkeys(parents), "string")


def scd1_changes(target: DataFrame, source: DataFrame, spec: DimSpec, stamp: LoadStamp) -> DataFrame:
    """Every row of the merged dimension with what happened to it; inserted rows lack a key."""
    differs = "true" if spec.always_update else _differs(spec)
    action = f"CASE WHEN old IS NULL THEN '{INSERT}' WHEN new IS NOT NULL AND {differs} THEN '{UPDATE}' ELSE '{KEEP}' END"
    joined = _pair(target, source, spec, stamp).withColumn(ACTION, F.expr(action))

    def attribute(name: str) -> str:
        taken = f"'{INSERT}', '{UPDATE}'" if name in spec.written else f"'{INSERT}'"
        return f"CASE WHEN {ACTION} IN ({taken}) THEN new.`{name}` ELSE old.`{name}` END AS `{name}`"

    def stamped(name: str, action: str, value: str) -> str:
        return f"CASE WHEN {ACTION} = '{action}' THEN {value} ELSE old.{name} END AS {name}"

    return joined.selectExpr(
        f"old.`{spec.key}` AS `{spec.key}`",
        *spec.natural_key,
        *[attribute(c) for c in spec.attributes],
        stamped("created_date", INSERT, "load_ts"),
        stamped("created_by", INSERT, "load_user"),
        stamped("updated_date", UPDATE, "load_ts"),
        stamped("updated_by", UPDATE, "load_user"),
        ACTION,
    )


def scd1_merge(
    target: DataFrame | None, source: DataFrame, spec: DimSpec, stamp: LoadStamp, last: int | None = None
) -> DataFrame:
    """The dimension after overwriting changed rows in place and adding new ones."""
    target = empty_dim(source.sparkSession, spec) if target is None else target
    last = last_key(target, spec.key) if last is None else last
    return number_inserts(scd1_changes(target, source, spec, stamp), spec, last).drop(ACTION)


def scd2_changes(current: DataFrame, source: DataFrame, spec: DimSpec, stamp: LoadStamp) -> DataFrame:
    """Current versions after the load, with what happened to each.

    A key absent from the source or unchanged keeps its row. A changed key yields
    its old version, closed the day before the load, and a new one; a new key
    yields one version. New versions lack a key until they are numbered.
    """
    keep = _struct({c: f"old.`{c}`" for c in spec.schema().names}, KEEP)
    expire = _struct(
        {
            **{c: f"old.`{c}`" for c in spec.schema().names},
            "is_current": "false",
            "expiry_date": "date_sub(load_date, 1)",
            "updated_date": "load_ts",
            "updated_by": "load_user",
        },
        EXPIRE,
    )
    insert = _struct(
        {
            spec.key: "CAST(NULL AS BIGINT)",
            **{c: f"new.`{c}`" for c in (*spec.natural_key, *spec.attributes)},
            "is_current": "true",
            "effective_date": "load_date",
            "expiry_date": f"DATE '{HIGH_DATE}'",
            "created_date": "load_ts",
            "created_by": "load_user",
            "updated_date": "CAST(NULL AS TIMESTAMP)",
            "updated_by": "CAST(NULL AS STRING)",
        },
        INSERT,
    )
    rows = f"""inline(CASE WHEN new IS NULL THEN array({keep})
                           WHEN old IS NULL THEN array({insert})
                           WHEN {_differs(spec)} THEN array({expire}, {insert})
                           ELSE array({keep}) END)"""
    return _pair(current, source, spec, stamp).selectExpr(rows)


def scd2_merge(
    target: DataFrame | None, source: DataFrame, spec: DimSpec, stamp: LoadStamp, last: int | None = None
) -> DataFrame:
    """The whole dimension, history included, after expiring changed rows and adding new versions."""
    target = empty_dim(source.sparkSession, spec) if target is None else target
    last = last_key(target, spec.key) if last is None else last
    changes = scd2_changes(target.where("is_current"), source, spec, stamp)
    numbered = number_inserts(changes, spec, last).drop(ACTION)
    return target.where("not is_current").unionByName(numbered)


def merge_dim(
    target: DataFrame | None, source: DataFrame, spec: DimSpec, stamp: LoadStamp, last: int | None = None
) -> DataFrame:
    merge = scd1_merge if spec.scd == 1 else scd2_merge
    return merge(target, source, spec, stamp, last)


def number_inserts(changes: DataFrame, spec: DimSpec, last: int) -> DataFrame:
    """The merged rows, inserted ones numbered. They are written once, so the merge runs once."""
    changes = materialize(changes, spec.name)
    inserted = surrogate_keys(changes.where(F.col(ACTION) == INSERT), spec.key, spec.natural_key, last)
    return changes.where(F.col(ACTION) != INSERT).unionByName(inserted)


def merge_counts(changes: DataFrame) -> DataFrame:
    """One row: how many rows were inserted and how many updated or expired."""
    return changes.agg(
        F.count_if(F.col(ACTION) == INSERT).alias("rows_inserted"),
        F.count_if(F.col(ACTION).isin(UPDATE, EXPIRE)).alias("rows_updated"),
    )


def new_or_changed(current: DataFrame, source: DataFrame, spec: DimSpec) -> DataFrame:
    """Source rows that have no current version, or one that differs."""
    joined = _pair(current, source, spec, how="right")
    return joined.where(f"old IS NULL OR {_differs(spec)}").select("new.*")


def location_from_entity(staged: DataFrame, entity_id: str) -> DataFrame:
    """The address embedded in an entity as a staged location with the entity's own id."""
    address = ("address_line1", "city", "region", "postal_code", "country")
    missing = ("address_line2", "latitude", "longitude")
    return staged.where(F.col(entity_id).isNotNull()).select(
        "source_system",
        F.col(entity_id).alias("location_id"),
        *address,
        *[F.lit(None).cast("string").alias(c) for c in missing],
    )


def _pair(
    target: DataFrame, source: DataFrame, spec: DimSpec, stamp: LoadStamp | None = None, how: str = "full_outer"
) -> DataFrame:
    """Target and source row of each natural key, as structs ``old`` and ``new``."""
    keys = list(spec.natural_key)
    old = target.select(*keys, F.struct(*target.columns).alias("old"))
    new = source.select(*keys, F.struct(*source.columns).alias("new"))
    joined = old.join(new, keys, how)
    if stamp is None:
        return joined
    return joined.select(
        "*",
        F.lit(str(stamp.load_ts)).cast("timestamp").alias("load_ts"),
        F.lit(stamp.load_date).alias("load_date"),
        F.lit(stamp.load_user).alias("load_user"),
    )


def _differs(spec: DimSpec) -> str:
    return changed("old", "new", spec.compare, spec.columns, spec.null_as_default)


def _struct(values: Mapping[str, str], action: str) -> str:
    fields = [f"{value} AS `{name}`" for name, value in values.items()]
    return f"struct({', '.join(fields)}, '{action}' AS {ACTION})"
