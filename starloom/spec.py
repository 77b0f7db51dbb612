"""Declarative descriptions of dimensions and facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

HIGH_DATE = dt.date(9999, 12, 31)

AUDIT_COLUMNS = {
    "created_date": "timestamp",
    "created_by": "string",
    "updated_date": "timestamp",
    "updated_by": "string",
}
VERSION_COLUMNS = {"is_current": "boolean", "effective_date": "date", "expiry_date": "date"}


@dataclass(frozen=True)
class LoadStamp:
    """When and by whom a load is run; given by the caller, so a re-run repeats it."""

    load_ts: dt.datetime
    load_user: str = "loader"

    @property
    def load_date(self) -> dt.date:
        return self.load_ts.date()


@dataclass(frozen=True)
class Lookup:
    """Equi-join from source columns to a dimension, fetching its key. With ``salts`` over 1 a load looks for hot key values."""

    dim: str
    source: tuple[str, ...]
    target: tuple[str, ...]
    key: str
    alias: str | None = None
    required: bool = False
    current_only: bool = True
    salts: int = 1  # partitions that a load spreads each hot key value over

    @property
    def output(self) -> str:
        return self.alias or self.key


@dataclass(frozen=True)
class DimSpec:
    """A dimension: its natural key, attributes with types, and what makes a change.

    ``columns`` lists every attribute in table order, keys fetched by ``lookups``
    included. ``compare`` names those whose change is acted upon, ``write`` those
    an in-place update replaces (all, unless given), ``absent`` those this source
    does not deliver, which stay NULL.
    """

    name: str
    key: str
    natural_key: tuple[str, ...]
    columns: Mapping[str, str]
    compare: tuple[str, ...]
    scd: int = 2
    lookups: tuple[Lookup, ...] = ()
    write: tuple[str, ...] | None = None
    absent: tuple[str, ...] = ()
    null_as_default: bool = False
    always_update: bool = False

    def __post_init__(self) -> None:
        unknown = set(self.compare) - set(self.columns)
        if unknown:
            raise ValueError(f"{self.name}: compared columns not in the table: {sorted(unknown)}")

    @property
    def attributes(self) -> tuple[str, ...]:
        return tuple(self.columns)

    @property
    def written(self) -> tuple[str, ...]:
        return self.attributes if self.write is None else self.write

    def typed_columns(self) -> dict[str, str]:
        """Staged columns to cast: natural key and the attributes it delivers itself."""
        fetched = {lk.output for lk in self.lookups} | set(self.absent)
        own = {c: t for c, t in self.columns.items() if c not in fetched}
        return {**dict.fromkeys(self.natural_key, "string"), **own}

    def schema(self) -> T.StructType:
        columns = {self.key: "bigint", **dict.fromkeys(self.natural_key, "string"), **self.columns}
        if self.scd == 2:
            columns |= VERSION_COLUMNS
        return struct_of(columns | AUDIT_COLUMNS)


@dataclass(frozen=True)
class FactSpec:
    """A fact: its natural key, date, dimension lookups and measures.

    ``columns`` maps each output column to its type; ``sources`` gives the staged
    name where it differs. ``zero`` columns turn NULL into 0, ``required`` columns
    reject the row when NULL, ``null_keys`` are dimension keys this source lacks.
    A fact with no ``date_source`` is keyed by the load date. ``fixed_date`` states
    that a natural key never comes again with another date, so that a batch is
    compared with the loaded facts of its own months only.
    """

    name: str
    key: str
    natural_key: tuple[str, ...]
    columns: Mapping[str, str]
    lookups: tuple[Lookup, ...]
    date_key: str = "date_key"
    date_source: str | None = None
    sources: Mapping[str, str] = field(default_factory=dict)
    zero: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    null_keys: tuple[str, ...] = ()
    latest_by: tuple[str, ...] = ()
    fixed_date: bool = False

    @property
    def key_columns(self) -> tuple[str, ...]:
        return (self.date_key, *[lk.output for lk in self.lookups], *self.null_keys)

    @property
    def output_columns(self) -> tuple[str, ...]:
        return (*self.key_columns, *self.columns)

    def schema(self) -> T.StructType:
        columns = {self.key: "bigint", self.date_key: "int"}
        columns |= dict.fromkeys(self.key_columns[1:], "bigint")
        return struct_of({**columns, **self.columns, "created_date": "timestamp"})


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def struct_of(columns: Mapping[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, type_of(type_name)) for name, type_name in columns.items()])


def type_of(name: str) -> T.DataType:
    if name.startswith("decimal"):
        precision, scale = name.removeprefix("decimal(").rstrip(")").split(",")
        return T.DecimalType(int(precision), int(scale))
    return _TYPES[name]
