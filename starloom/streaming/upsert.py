"""Insert-only upsert of a stream into a cleansed table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.operators.clean import conform, conform_trim, dedup_latest, drop_null_key
from starloom.operators.facts import not_loaded
from starloom.session import materialize, scratch_scope
from starloom.sources.files import ARRIVAL, LINEAGE_FILE
from starloom.sources.tables import Layout, Table
from starloom.streaming.bronze import trigger


class CleansedTable:
    """Appended loads of conformed rows, visible up to the last published one."""

    def __init__(self, spark: SparkSession, layout: Layout, entity: str, schema: T.StructType) -> None:
        self.table = Table(spark, layout.path("silver", entity), schema, "rows")

    def read(self) -> DataFrame:
        return self.table.current()

    def replace_with(self, rows: DataFrame, keys: Sequence[str], latest_by: Sequence[str], at: dt.datetime) -> int:
        """The batch form: all raw rows conformed anew, in place of what was there."""
        return self.table.replace(conform(rows, keys, latest_by).select(*self.table.schema.names), at)

    def append_new(
        self, rows: DataFrame, keys: Sequence[str], latest_by: Sequence[str], first_by: Sequence[str] = ()
    ) -> int:
        """Append the rows whose key is not in the table yet, one per key: the first by ``first_by``, then the latest.

        A batch that failed before its marker is invisible and is simply written
        again; one that got through adds nothing the second time.
        """
        before = self.table.marker()
        rows = drop_null_key(conform_trim(rows), keys)
        with scratch_scope(self.table.spark):
            rows = materialize(dedup_latest(rows, keys, latest_by, first_by), "micro-batch")
            fresh = not_loaded(rows, None if before is None else self._loaded(before, rows, keys), keys)
            return self.table.append(fresh.select(*self.table.schema.names), dt.datetime.now(dt.timezone.utc), keys)

    def _loaded(self, before: Row, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The keys the batch must be compared with: what the index has near them. A table written without an index is read whole."""
        if before.key_runs:
            return self.table.key_index(keys).near(before.key_runs, batch)
        return self.table.current(before)


def stream_upsert(
    stream: DataFrame,
    target: CleansedTable,
    keys: Sequence[str],
    checkpoint: str,
    latest_by: Sequence[str] = ("_ingest_timestamp",),
    seconds: int | None = None,
    arrival: Sequence[str] = (ARRIVAL, LINEAGE_FILE),
) -> StreamingQuery:
    """Trim, drop rows without a key, insert the keys not there yet, one row each.

    The table is insert-only, so the first file that brings a key decides, within a micro-batch too: how many files a
    micro-batch holds does not change the result. Within a file the latest row counts. ``arrival`` names the
    columns of the order of arrival, which ``stream_files`` gives.
    """
    missing = set(arrival) - set(stream.columns)
    if missing:
        raise ValueError(f"columns of the order of arrival are missing: {sorted(missing)}")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        target.append_new(batch, keys, [c for c in latest_by if c in batch.columns], arrival)

    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger(seconds)).start()
