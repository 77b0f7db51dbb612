"""File streams into the raw layer: each file once, stopping when drained or running on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.session import children, exists
from starloom.sources.files import ARRIVAL, CSV, read_evolving, with_lineage
from starloom.sources.tables import numbered_children, write_rows
from starloom.spec import LoadStamp

_COLUMNS = T.StructType([T.StructField("columns", T.ArrayType(T.StringType()))])
# Fixed value: seconds between micro-batches of a stream that runs on.
TRIGGER_SECONDS = 60
MAX_FILES = 500
FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_format: str = "csv",
    stamp: LoadStamp | None = None,
    pattern: str = "*",
    max_files: int = MAX_FILES,
) -> DataFrame:
    """Files as they arrive, the oldest first, with lineage columns and the file's time (ARRIVAL). A csv file with
    another header fails the stream."""
    reader = spark.readStream.format(file_format).schema(schema)
    if file_format == "csv":
        reader = reader.options(**CSV, enforceSchema="false")
    rows = reader.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files).load(folder)
    return with_lineage(rows.select("*", F.col("_metadata.file_modification_time").alias(ARRIVAL), "_metadata"), stamp).drop("_metadata")


def trigger(seconds: int | None) -> dict:
    """Drain what is there and stop, or run a micro-batch every so many seconds."""
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


def stream_bronze(rows: DataFrame, path: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Append the stream to a raw table; the checkpoint remembers the files already taken."""
    writer = rows.writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger(seconds)).start(path)


def stream_evolving(
    spark: SparkSession,
    folder: str,
    path: str,
    checkpoint: str,
    seconds: int | None = None,
    pattern: str = "*",
    max_files: int = MAX_FILES,
) -> StreamingQuery:
    """Append csv files whose columns may change; unseen columns are added, never shifted.

    The stream carries file paths only, at most ``max_files`` a batch. A batch is
    written to a directory of its own, so a batch that is run again replaces itself;
    a checkpoint that starts anew would number its batches anew, so it needs a new path. The columns seen so far are kept
    beside the checkpoint, an entry for each batch that brings new ones, so that every batch has all of them in the same
    order, also after a restart.
    """
    if exists(spark, path) and not exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{path} holds the batches of another checkpoint")
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
        .select("path")
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(row.path for row in batch.collect())
        if paths:
            rows = with_known(read_evolving(batch.sparkSession, paths), known_columns(spark, checkpoint, batch_id))
            log_columns(spark, checkpoint, batch_id, rows.columns)
            write_rows(rows, f"{path}/batch_id={batch_id}")

    writer = files.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger(seconds)).start()


def known_columns(spark: SparkSession, checkpoint: str, before: int) -> list[str]:
    """The columns that the batches before this one brought, in the order they came."""
    log = _columns_log(checkpoint)
    entries = [n for n in numbered_children(spark, log, "batch_id") if n < before and "_SUCCESS" in children(spark, f"{log}/batch_id={n}")]
    return spark.read.schema(_COLUMNS).parquet(f"{log}/batch_id={entries[0]}").first()[0] if entries else []


def log_columns(spark: SparkSession, checkpoint: str, batch_id: int, columns: list[str]) -> None:
    if columns != known_columns(spark, checkpoint, batch_id):
        row = spark.range(1, numPartitions=1).select(F.array(*map(F.lit, columns)).alias("columns"))
        write_rows(row, f"{_columns_log(checkpoint)}/batch_id={batch_id}")


def with_known(rows: DataFrame, known: list[str]) -> DataFrame:
    """The rows with the known columns first, NULL where the files lack them; names are compared as Spark does, whatever their case."""
    own = {c.lower(): c for c in rows.columns}
    first = [rows[own[c.lower()]].alias(c) if c.lower() in own else F.lit(None).cast("string").alias(c) for c in known]
    seen = {c.lower() for c in known}
    return rows.select(*first, *[rows[c] for c in rows.columns if c.lower() not in seen])


def _columns_log(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-columns"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A raw table with the columns of all its files."""
    return spark.read.option("mergeSchema", "true").parquet(path)
