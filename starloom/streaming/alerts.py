"""The alert rules on a stream.

Every window that a micro-batch touches is written with its new measure, so an alert is there with the failure itself
and late rows still count. Nothing waits for a watermark. The state is one row per window, 288 a day, however many
rows there are. Every FOLD micro-batches the windows written so far are put together into one table, which later ones are read on top
of, so a reader opens the folders of fewer than 2 * FOLD micro-batches however long the stream has run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.operators.control import FAILED_RUNS_OVER, METRIC_OVER, window_measures
from starloom.session import children, delete, exists
from starloom.sources.tables import numbered_children, write_rows
from starloom.streaming.bronze import trigger

FOLD = 50  # micro-batches whose windows are put together
_FOLDED, _CAME_WITH = "folded", "came_with"


def stream_failed_runs(runs: DataFrame, time_column: str = "end_time") -> DataFrame:
    """Failed runs by window."""
    return window_measures(runs.where("status = 'FAILED'"), time_column, F.count("*"))


def stream_metric(metrics: DataFrame, time_column: str, value: str) -> DataFrame:
    """Average of ``value`` by window."""
    return window_measures(metrics, time_column, F.avg(value))


def write_windows(windows: DataFrame, path: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Write the windows of each micro-batch to a directory of its own, which a batch that is run again replaces.

    What is folded together is deleted a fold later, so that a reader that has listed it can still open it.
    """
    spark = windows.sparkSession
    if exists(spark, path) and not exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{path} holds the batches of another checkpoint")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_rows(batch, f"{path}/batch_id={batch_id}")
        if batch_id % FOLD == FOLD - 1:
            fold_windows(spark, path, windows.schema, batch_id)

    writer = windows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger(seconds)).start()


def fold_windows(spark: SparkSession, path: str, schema: T.StructType, upto: int) -> None:
    """Put the windows of the micro-batches up to ``upto`` together, the latest measure of each. A fold that dies is not seen, and
    its batch, run again, writes it anew; one that is there stays."""
    before = _folds(spark, path)
    if not before or before[0] < upto:
        latest = _latest(spark, path, schema)
        if latest is not None:
            write_rows(latest.hint("rebalance"), f"{path}/{_FOLDED}={upto}")
    for fold in before[1:]:
        delete(spark, f"{path}/{_FOLDED}={fold}")
    for batch in numbered_children(spark, path, "batch_id"):
        if before and batch <= before[0]:
            delete(spark, f"{path}/batch_id={batch}")


def read_alerts(spark: SparkSession, path: str, schema: T.StructType, over: float) -> DataFrame:
    """Windows whose latest measure is over the threshold (FAILED_RUNS_OVER, METRIC_OVER)."""
    latest = _latest(spark, path, schema)
    if latest is None:
        return spark.createDataFrame([], schema)
    return latest.select(*schema.names).where(F.col("measure") > over)


def _folds(spark: SparkSession, path: str) -> list[int]:
    """The folds that were written whole, the last one first."""
    return [n for n in numbered_children(spark, path, _FOLDED) if "_SUCCESS" in children(spark, f"{path}/{_FOLDED}={n}")]


def _latest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The latest measure of every window and the micro-batch it came with: the last fold and the micro-batches after it."""
    folds = _folds(spark, path)
    after = [n for n in numbered_children(spark, path, "batch_id") if not folds or n > folds[0]]
    kept = T.StructType([*schema.fields, T.StructField(_CAME_WITH, T.LongType())])
    parts = [spark.read.schema(kept).parquet(f"{path}/{_FOLDED}={folds[0]}")] if folds else []
    if after:
        batches = [f"{path}/batch_id={n}" for n in after]
        numbered = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        parts.append(spark.read.schema(numbered).option("basePath", path).parquet(*batches).withColumnRenamed("batch_id", _CAME_WITH))
    if not parts:
        return None
    every = reduce(DataFrame.unionByName, parts)
    newest = F.max(F.struct(_CAME_WITH, "measure")).alias("newest")
    return every.groupBy("window_start", "window_end").agg(newest).select("window_start", "window_end", "newest.measure", f"newest.{_CAME_WITH}")


__all__ = ["FAILED_RUNS_OVER", "FOLD", "METRIC_OVER", "fold_windows", "read_alerts", "stream_failed_runs", "stream_metric", "write_windows"]
