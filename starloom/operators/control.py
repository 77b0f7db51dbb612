"""Load plan, high-water marks, run log and the alert rules over it."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from starloom.functions.columns import utc_time
from starloom.operators.scd import scd1_changes
from starloom.spec import DimSpec, LoadStamp, struct_of

# The mark of an object never loaded, days a log row is kept, and the alert windows.
NEVER = dt.datetime(1900, 1, 1)
LOG_RETENTION_DAYS = 90
ALERT_WINDOW, ALERT_EVERY = "15 minutes", "5 minutes"
FAILED_RUNS_OVER, METRIC_OVER = 0, 80

WATERMARK_KEYS = ("source_system", "object_name")
WATERMARK_SCHEMA = struct_of(
    {"source_system": "string", "object_name": "string", "last_watermark_value": "timestamp", "updated_date": "timestamp"}
)
RUN_LOG_SCHEMA = struct_of(
    {
        "run_key": "bigint",
        "procedure_name": "string",
        "start_time": "timestamp",
        "end_time": "timestamp",
        "status": "string",
        "rows_inserted": "bigint",
        "rows_updated": "bigint",
        "error_message": "string",
    }
)

PIPELINE_METADATA = DimSpec(
    name="ctrl_pipeline_metadata",
    key="metadata_key",
    natural_key=("source_system", "object_name"),
    columns={
        "load_priority": "int",
        "load_type": "string",
        "source_container": "string",
        "source_folder_path": "string",
        "source_file_name": "string",
        "watermark_column": "string",
        "sink_schema": "string",
        "sink_table": "string",
        "load_procedure_name": "string",
        "is_active": "boolean",
    },
    compare=(),
    write=(
        "load_priority",
        "load_type",
        "source_container",
        "source_folder_path",
        "source_file_name",
        "sink_schema",
        "sink_table",
        "load_procedure_name",
    ),
    scd=1,
    always_update=True,
)


def active_filter(metadata: DataFrame) -> DataFrame:
    return metadata.where("is_active")


def load_plan(metadata: DataFrame) -> DataFrame:
    """Active objects in the order they are to be loaded."""
    return active_filter(metadata).orderBy("load_priority", "object_name", "source_system")


def route_of(load_type: str) -> Column:
    """Incremental objects take the watermark branch, all others the full one."""
    return F.when(F.col(load_type) == "INCREMENTAL", F.lit("incremental")).otherwise(F.lit("full"))


def run_load_plan(
    metadata: DataFrame, full: Callable[[Row], None], incremental: Callable[[Row], None]
) -> list[tuple[str, str]]:
    """Run the loads of the plan one after another, each by its load type.

    The plan is a control table with a row per loaded object, not data.
    """
    done = []
    branches = {"full": full, "incremental": incremental}
    for entry in load_plan(metadata.withColumn("route", route_of("load_type"))).collect():
        branches[entry.route](entry)
        done.append((entry.source_system, entry.object_name))
    return done


def get_watermarks(requests: DataFrame, marks: DataFrame) -> DataFrame:
    """The mark of each requested (source_system, object_name), 1900-01-01 for those without one."""
    known = marks.select(*WATERMARK_KEYS, "last_watermark_value")
    found = requests.join(known, list(WATERMARK_KEYS), "left")
    mark = F.coalesce("last_watermark_value", F.lit(NEVER.isoformat(sep=" ")).cast("timestamp"))
    return found.withColumn("last_watermark_value", mark)


def get_watermark(marks: DataFrame, source_system: str, object_name: str) -> dt.datetime:
    """The mark of one object in UTC, NEVER if it has none."""
    own = marks.where((F.col("source_system") == source_system) & (F.col("object_name") == object_name))
    mark = own.agg(F.max("last_watermark_value").cast("string")).first()[0]
    return NEVER if mark is None else dt.datetime.fromisoformat(mark)


def set_watermarks(marks: DataFrame, updates: DataFrame, stamp: LoadStamp) -> DataFrame:
    """Marks after the update. The given value is taken even when it is lower."""
    stamped = updates.select(
        *WATERMARK_KEYS,
        "last_watermark_value",
        F.lit(stamp.load_ts.isoformat(sep=" ")).cast("timestamp").alias("updated_date"),
    )
    untouched = marks.join(stamped, list(WATERMARK_KEYS), "left_anti")
    return untouched.select(*stamped.columns).unionByName(stamped)


def above_watermark(rows: DataFrame, column: str, watermark: dt.datetime) -> DataFrame:
    """Rows past a mark, the mark itself excluded; a plain filter, so it reaches the scan."""
    return rows.where(F.col(column) > utc_time(watermark))


def above_watermarks(rows: DataFrame, column: str, marks: DataFrame) -> DataFrame:
    """Rows past the mark of their own (source_system, object_name); rows without a mark are all new."""
    known = marks.select(*WATERMARK_KEYS, "last_watermark_value")
    joined = rows.join(known, list(WATERMARK_KEYS), "left")
    is_new = F.col("last_watermark_value").isNull() | (F.col(column) > F.col("last_watermark_value"))
    return joined.where(is_new).drop("last_watermark_value")


def next_watermarks(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(*WATERMARK_KEYS).agg(F.max(column).alias("last_watermark_value"))


@dataclass
class RunRecord:
    rows_inserted: int = 0
    rows_updated: int = 0


@contextmanager
def run_log(
    append: Callable[[Mapping], None], procedure: str, now: Callable[[], dt.datetime] | None = None
) -> Iterator[RunRecord]:
    """Log one load: when, how many rows, and SUCCESS or FAILED with the error, which is passed on.

    ``append`` gets the finished row, in the shape of ``RUN_LOG_SCHEMA``.
    """
    now = now or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    record, start = RunRecord(), now()
    run = {"run_key": time.time_ns(), "procedure_name": procedure, "start_time": start}
    try:
        yield record
    except BaseException as error:
        append({**run, "end_time": now(), "status": "FAILED", "error_message": str(error)})
        raise
    counts = {"rows_inserted": record.rows_inserted, "rows_updated": record.rows_updated}
    append({**run, "end_time": now(), "status": "SUCCESS", **counts})


def purge_logs(log: DataFrame, time_column: str, as_of: dt.datetime, days: int = LOG_RETENTION_DAYS) -> DataFrame:
    """Log rows to keep: those not older than ``days``."""
    cutoff = as_of - dt.timedelta(days=days)
    return log.where(F.col(time_column) >= utc_time(cutoff))


def window_measures(
    rows: DataFrame, time_column: str, measure: Column, window: str = ALERT_WINDOW, every: str = ALERT_EVERY
) -> DataFrame:
    """An aggregate over overlapping windows; works on streams too."""
    windows = rows.groupBy(F.window(time_column, window, every).alias("w")).agg(measure.alias("measure"))
    return windows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "measure")


def alert_windows(
    rows: DataFrame, time_column: str, measure: Column, over: float, window: str = ALERT_WINDOW, every: str = ALERT_EVERY
) -> DataFrame:
    """Overlapping windows in which an aggregate is over its threshold."""
    return window_measures(rows, time_column, measure, window, every).where(F.col("measure") > over)


def failed_run_alerts(runs: DataFrame, time_column: str = "end_time") -> DataFrame:
    """Windows with failed runs, and how many."""
    return alert_windows(runs.where("status = 'FAILED'"), time_column, F.count("*"), FAILED_RUNS_OVER)


def metric_alerts(metrics: DataFrame, time_column: str, value: str, over: float = METRIC_OVER) -> DataFrame:
    """Windows whose average of ``value`` is over the threshold."""
    return alert_windows(metrics, time_column, F.avg(value), over)


def seed_changes(target: DataFrame, rows: DataFrame, spec: DimSpec, stamp: LoadStamp) -> DataFrame:
    """Seed rows merged into a control table: new ones added, known ones overwritten without comparing."""
    return scd1_changes(target, rows, spec, stamp)
