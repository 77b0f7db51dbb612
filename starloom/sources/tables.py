"""Published tables: plain parquet, one directory per load, visible once its marker is written.

A load writes directories of its own and then a one-row marker. A marker holds the whole state: which loads' rows count,
which load each bucket of a dimension was last written by, and the runs of the key index. So the last marker alone is
read. Markers lie in epochs of EPOCH loads, so finding the last one lists the epochs and one of them, however
many loads there were. A load that died is never seen and its retry overwrites only its own directories. One writer per table.

The current rows of a dimension lie in buckets by a hash of the natural key. A load writes the buckets it changes anew,
whole, in its own directory; the marker goes on naming the older directories of the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.columns import utc_text
from starloom.operators.clean import REJECT
from starloom.session import children, codec
from starloom.sources.keyindex import KEYS_PER_BUCKET, RUN_TYPE, KeyIndex
from starloom.spec import struct_of

MARKER = struct_of(
    {
        "load_id": "bigint",
        "base_load_id": "bigint",
        "last_key": "bigint",
        "rows_inserted": "bigint",
        "rows_updated": "bigint",
        "rows_rejected": "bigint",
        "published_at": "timestamp",
        "rows_current": "bigint",
        "buckets": "int",
    }
)
MARKER.add("bucket_loads", T.MapType(T.IntegerType(), T.LongType())).add("key_runs", T.ArrayType(RUN_TYPE))
NOTHING = Row(load_id=0, base_load_id=0, last_key=0, rows_current=0, buckets=0, bucket_loads={}, key_runs=[])
CARRIED = ("base_load_id", "last_key", "rows_current", "buckets", "bucket_loads", "key_runs")
EPOCH = 100  # loads whose markers lie in one folder
BUCKET = "bucket"
FILE, FILE_ROWS = "file", "file_rows"
ACCEPTED, REJECTED = "accepted", "rejected"


@dataclass(frozen=True)
class Layout:
    """Paths of the warehouse: one folder per layer, one per entity in it."""

    root: str

    def path(self, layer: str, entity: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{entity}"

    def checkpoint(self, layer: str, entity: str) -> str:
        return self.path("_checkpoints", f"{layer}/{entity}")


@dataclass(frozen=True)
class Table:
    """A published table. ``kind`` is ``dim1``, ``dim2``, ``fact``, or ``rows`` for plain appended rows."""

    spark: SparkSession
    path: str
    schema: T.StructType
    kind: str
    clustered_by: str | None = None
    keys_per_bucket: int = KEYS_PER_BUCKET

    def rows_path(self, load_id: int) -> str:
        return f"{self.path}/rows/load_id={load_id}"

    def history_path(self, load_id: int) -> str:
        return f"{self.path}/history/load_id={load_id}"

    def stats_path(self, load_id: int) -> str:
        return f"{self.path}/stats/load_id={load_id}"

    def marker_path(self, load_id: int) -> str:
        return f"{self.path}/published/epoch={load_id // EPOCH}/load_id={load_id}"

    def marker(self) -> Row | None:
        """The last marker. Folders of a marker that was not finished hold no row and are passed over."""
        for epoch in self.epochs():
            for load_id in numbered_children(self.spark, f"{self.path}/published/epoch={epoch}", "load_id"):
                found = read_or_none(self.spark, self.marker_path(load_id), MARKER)
                if found is not None and (row := found.withColumn("load_id", F.lit(load_id).cast("bigint")).first()):
                    return row
        return None

    def epochs(self) -> list[int]:
        """Epochs that have markers, the last first."""
        return numbered_children(self.spark, f"{self.path}/published", "epoch")

    def publish(self, load_id: int, published_at: dt.datetime, before: Row | None = None, **state) -> None:
        """Make a load visible. What ``state`` does not give is as ``before``."""
        row = {name: getattr(before or NOTHING, name) for name in CARRIED} | state | {"published_at": published_at}
        marker = one_row(self.spark, row, T.StructType([f for f in MARKER.fields if f.name != "load_id"]))
        marker.write.mode("overwrite").parquet(self.marker_path(load_id))

    def key_index(self, keys: Sequence[str]) -> KeyIndex:
        return KeyIndex(self.spark, f"{self.path}/keys", T.StructType([self.schema[k] for k in keys]), self.keys_per_bucket)

    def append(self, rows: DataFrame, published_at: dt.datetime, keys: Sequence[str] = ()) -> int:
        """Add plain rows as one load; gives how many were added. Without any, nothing is published. ``keys`` go to the key index."""
        last = self.marker()
        load_id = (last or NOTHING).load_id + 1
        written = self._write(rows, load_id)
        if written or last is None:
            runs = (last or NOTHING).key_runs or []
            if keys and not runs and last is not None and written:  # rows that came without keys
                runs = self.key_index(keys).rebuilt(last.load_id, self.current(last))
            if keys and written:
                added = self.spark.read.schema(rows.schema).parquet(self.rows_path(load_id))
                runs = self.key_index(keys).added(runs, load_id, added, written)
            self.publish(load_id, published_at, last, rows_inserted=written, key_runs=runs)
        return written

    def replace(self, rows: DataFrame, published_at: dt.datetime) -> int:
        """Plain rows in place of all earlier ones; readers see the old rows until the new are published."""
        last = self.marker()
        load_id = (last or NOTHING).load_id + 1
        written = self._write(rows, load_id)
        self.publish(load_id, published_at, last, base_load_id=load_id, rows_inserted=written, key_runs=[])
        return written

    def _write(self, rows: DataFrame, load_id: int) -> int:
        write_rows(rows, self.rows_path(load_id))
        return self.spark.read.schema(rows.schema).parquet(self.rows_path(load_id)).count()

    def read(self) -> DataFrame:
        """The whole table; of a versioned dimension, history included."""
        last = self.marker()
        rows = self.current(last) if last else self.empty()
        return rows.unionByName(self.history(last)) if last and self.kind == "dim2" else rows

    def current(
        self, last: Row | None = None, months: list[int] | None = None, buckets: Sequence[int] | None = None, where: Mapping[str, tuple] | None = None
    ) -> DataFrame:
        """Facts and in-place dimensions: all rows; versioned dimensions: current versions.

        As of the last load, or of the load whose marker is given. Facts can be limited to some months, dimensions to some
        buckets; the others' files are then not opened. ``where`` keeps rows whose columns lie between two values, both included,
        and passes over files that can have none by their statistics, where they have been analysed.
        """
        last = last or self.marker()
        if last is None:
            return self.empty()
        if self.kind.startswith("dim"):
            return self._bucket_rows(last, buckets)
        rows = self.rows_with_parts(self._paths_of(last, where) if where else None)
        if rows is None:
            return self.empty()
        visible = F.col("load_id").between(last.base_load_id, last.load_id)
        if self.kind == "fact":
            visible = visible & (F.col("status") == ACCEPTED)
            visible = visible if months is None else visible & F.col("date_month").isin(months)
        for name, (low, high) in (where or {}).items():
            visible = visible & F.col(name).between(F.lit(low), F.lit(high))
        return rows.where(visible).select(*self.schema.names)

    def _paths_of(self, last: Row, where: Mapping[str, tuple]) -> list[str]:
        """Files that can hold rows within the limits, and the folders of loads without statistics. As many paths as Spark would list itself."""
        stats = self.file_statistics(last)
        done = set() if stats is None else set(numbered_children(self.spark, f"{self.path}/stats", "load_id"))
        loads = numbered_children(self.spark, f"{self.path}/rows", "load_id")
        paths = [self.rows_path(n) for n in loads if last.base_load_id <= n <= last.load_id and n not in done]
        if stats is not None:
            fits = F.lit(True)
            for name, (low, high) in where.items():
                if f"{name}_min" in stats.columns:
                    fits = fits & F.coalesce((F.col(f"{name}_min") <= F.lit(high)) & (F.col(f"{name}_max") >= F.lit(low)), F.col(f"{name}_nulls").isNull())
            paths += [r[0] for r in stats.where(fits).select(FILE).toLocalIterator()]
        return paths

    def file_statistics(self, last: Row | None = None) -> DataFrame | None:
        """The statistics of the analysed files in use."""
        last = last or self.marker()
        stats = None if last is None else read_or_none(self.spark, f"{self.path}/stats")
        return None if stats is None else stats.where(F.col("load_id").between(last.base_load_id, last.load_id))

    def _bucket_rows(self, last: Row, buckets: Sequence[int] | None) -> DataFrame:
        """Only the directories that the marker names are listed."""
        paths = [f"{self.rows_path(load)}/{BUCKET}={b}" for b, load in sorted(last.bucket_loads.items()) if buckets is None or b in buckets]
        if not paths:
            return self.empty()
        return self.spark.read.schema(self.schema).parquet(*paths).select(*self.schema.names)

    def history(self, last: Row | None = None) -> DataFrame:
        """Expired versions: each is written once, by the load that expired it."""
        last = last or self.marker()
        rows = read_or_none(self.spark, f"{self.path}/history", T.StructType(self.schema.fields + struct_of({"load_id": "bigint"}).fields))
        if last is None or rows is None:
            return self.empty()
        return rows.where(F.col("load_id") <= last.load_id).select(*self.schema.names)

    def rejects(self) -> DataFrame | None:
        """Rows that facts' loads refused, with the reason and the load. Only their files are listed and read."""
        last = self.marker()
        if last is None:
            return None
        rows = f"{self.path}/rows"
        refused = read_or_none(self.spark, f"{rows}/load_id=*/status={REJECTED}", base=rows)
        return None if refused is None else refused.where(F.col("load_id") <= last.load_id).drop("status", "date_month")

    def empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def rows_with_parts(self, paths: list[str] | None = None) -> DataFrame | None:
        """All rows ever written to a fact or appended table, with the load and, of facts, status and month; or those at some paths."""
        parts = {"load_id": "bigint"}
        if self.kind == "fact":
            parts |= {"status": "string", "date_month": "int"}
        schema, rows = T.StructType(self.schema.fields + struct_of(parts).fields), f"{self.path}/rows"
        if paths is None:
            return read_or_none(self.spark, rows, schema)
        return self.spark.read.schema(schema).option("basePath", rows).parquet(*paths) if paths else None


def numbered_children(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the folders ``name=number`` in a folder, the largest first."""
    names = [c.removeprefix(f"{name}=") for c in children(spark, path) if c.startswith(f"{name}=")]
    return sorted(map(int, names), reverse=True)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_or_none(
    spark: SparkSession, path: str, schema: T.StructType | None = None, base: str | None = None
) -> DataFrame | None:
    """The parquet table, or None when nothing was ever written there."""
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    reader = reader if base is None else reader.option("basePath", base)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def one_row(spark: SparkSession, values: Mapping, schema: T.StructType) -> DataFrame:
    """A single row of literals; columns without a value are NULL."""
    columns = [_literal(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1, numPartitions=1).select(*columns)


def _literal(value) -> Column:
    """Times as text, to be read in the zone of the session."""
    if isinstance(value, dict):
        return F.map_from_arrays(F.array(*map(F.lit, value)), F.array(*map(F.lit, value.values()))) if value else F.create_map()
    if isinstance(value, list):
        return F.array(*[F.struct(*map(F.lit, entry)) for entry in value])
    return F.lit(utc_text(value) if isinstance(value, dt.datetime) else value)


def write_rows(df: DataFrame, path: str, *parts: str, append: bool = False) -> None:
    """Write one directory whole, replacing what an earlier attempt left there, or add a further slice of its rows."""
    writer = df.write.mode("append" if append else "overwrite").option("partitionOverwriteMode", "static").option("compression", codec(df.sparkSession))
    writer.partitionBy(*parts).parquet(path)


def write_fact_rows(
    resolved: DataFrame, table: Table, load_id: int, observed: Callable[[DataFrame, Column], DataFrame] | None = None, append: bool = False
) -> None:
    """Write accepted and rejected facts in one pass, by month; with ``append`` beside those of the load's earlier slices.

    Rebalancing by month gives files of even size: adaptive execution splits a
    month that is large and joins small ones. Rows are sorted by date within
    files, so a date filter skips row groups. Rejected rows have no month; the
    values that explain a reject are kept for them only. ``observed`` may count the rows on the way, after the
    shuffle, so that a task that is run again counts once; it gets them and the test for rejected ones.
    """
    evidence = [c for c in resolved.columns if c not in table.schema.names and c != REJECT]
    is_rejected = F.col(REJECT).isNotNull()
    month = F.expr(f"{table.clustered_by} div 100").cast("int")
    rows = resolved.withColumns(
        {
            **{c: F.when(is_rejected, F.col(c)) for c in evidence},
            "status": F.when(is_rejected, REJECTED).otherwise(ACCEPTED),
            "date_month": F.when(~is_rejected, month),
        }
    )
    rows = rows.hint("rebalance", F.col("status"), F.col("date_month"))
    rows = observed(rows, F.col("status") == REJECTED) if observed else rows
    rows = rows.sortWithinPartitions("status", "date_month", table.clustered_by)
    write_rows(rows, table.rows_path(load_id), "status", "date_month", append=append)
