"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the library counts on. Adaptive execution sizes the shuffle
# partitions, splits skewed join partitions and broadcasts a side only when its
# measured size is under the threshold.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}

SPLIT = "spark.sql.files.maxPartitionBytes"
SPLIT_BYTES = 32 * 1024 * 1024  # of files that a task of a load reads: sorted before a shuffle, they are ten times that in memory
ROW_GROUP = "parquet.block.size"  # files are split between row groups only
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # Spark deletes an execution's shuffle files at its end
CODEC = "zstd"  # of published and staging tables, unless the session names its own

_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def build_session(app: str = "starloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by all executors.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session without that setting has it in its warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/starloom/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str, row_group: int | None = None, files: int | None = None) -> DataFrame:
    """Write ``df`` as a scratch table and read it back. ``row_group`` bounds the bytes of a row group, where not Spark's own bound is to do so;
    ``files`` bounds the files, where a table of few rows would come out of many shuffle partitions.

    What follows starts from files, so a lost executor costs a re-read and
    never a second, possibly different, run of the plan before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df = df.coalesce(files) if files else df
    with free_shuffles(spark):
        (df.write.option(ROW_GROUP, row_group) if row_group else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def codec(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.parquet.compression.codec", CODEC)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a scratch table that lives as long as the scope it is made in."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (scope := _scope.get()) is not None:
        scope.append(path)
    return path


def files_for(spark: SparkSession, rows: int, each: int = 100_000) -> int:
    """How many files a table of ``rows`` rows needs with about ``each`` in a file, and enough for all cores whatever its size."""
    return 2 * spark.sparkContext.defaultParallelism + rows // each


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside once it is left; what is built on them must be written by then. Shuffle files go earlier."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        with free_shuffles(spark):
            yield
    finally:
        _scope.reset(token)
        for path in paths:
            delete(spark, path)


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Let tasks read files in splits of about SPLIT_BYTES, so that what they sort before a shuffle fits into memory. A session's own smaller splits stay."""
    own = spark.conf.get(SPLIT)
    if int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own)) > SPLIT_BYTES:
        spark.conf.set(SPLIT, str(SPLIT_BYTES))
    try:
        yield
    finally:
        spark.conf.set(SPLIT, own)


@contextmanager
def free_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of each write or count once it has ended, so that those of one step do not lie beside the next one's.
    Otherwise they stay until the driver happens to collect its garbage."""
    own = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if own is None else spark.conf.set(FREE_SHUFFLES, own)


def input_bytes(df: DataFrame) -> int:
    """The length of the files that a plan reads; 0 of one that reads none."""
    java, size = df.sparkSession.sparkContext._jvm.java.net, 0
    for name in df.inputFiles():
        target, system = _file_system(df.sparkSession, java.URI(name))
        size += system.getFileStatus(target).getLen()
    return size


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables, once nothing reads from them any more."""
    path = scratch_dir(spark)
    if exists(spark, path):
        delete(spark, path)


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _file_system(spark, path)
    return system.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none of one that is not there."""
    target, system = _file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, read by the driver without a Spark job; None of an empty file."""
    target, system = _file_system(spark, path)
    java = spark.sparkContext._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(system.open(target), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def delete(spark: SparkSession, path: str) -> None:
    target, system = _file_system(spark, path)
    system.delete(target, True)


def _file_system(spark: SparkSession, path):
    """The path and its Hadoop file system, which is where Spark itself keeps the files."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(context._jsc.hadoopConfiguration())
