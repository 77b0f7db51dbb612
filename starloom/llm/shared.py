"""What several of the operators need: whole texts out of Arrow columns, code on the workers, linked groups."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import files_for, materialize

SLICE_BYTES = 1 << 20
BATCH_ROWS = 1000  # texts in an Arrow batch; Spark's own 10,000 are tens of megabytes, held several times over


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library (on a cluster it is installed or sent with --py-files), and
    hand them smaller batches, unless the session sets a batch size of its own."""
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(size) == "10000":
        spark.conf.set(size, str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    given = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in given.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, given) if x)


def texts(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The column's texts as UTF-8 in runs of about ``most`` bytes, one text at least: first row, row after the last,
    the bytes, and where each text ends in them. Null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        stop = max(first + 1, int(np.searchsorted(at, at[first] + most, side="right")) - 1)
        yield first, stop, data[at[first] : at[stop]], at[first + 1 : stop + 1] - at[first]
        first = stop


def strings(column: pa.Array, most: int = 256) -> Iterator[list[str]]:
    """The column's texts as Python strings, some at a time; null counts as empty."""
    for first in range(0, len(column), most):
        yield column.slice(first, most).fill_null("").to_pylist()


def linked_groups(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, root) per node but the roots, root its smallest reachable node.

    Large stars and small stars alternate: every node points its neighbours at the smallest one, until all point
    at roots. The number of edges never grows, and no node's neighbours are gathered in one place. ``edges`` is
    counted first, so it is best a scratch table: the stars have as many files as that many rows need.
    """
    files = files_for(edges.sparkSession, edges.count())
    hold = lambda df: materialize(df.distinct(), "stars", files=files)
    stars = hold(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        both = stars.union(stars.select("b", "a"))
        ends = both.groupBy("a").agg(F.count(F.when(F.col("b") < F.col("a"), 1)).alias("up"), F.max("b").alias("high"))
        if not ends.where("up > 1 or up = 1 and high > a").limit(1).count():  # every node is a root or points at one root only
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # Large star: the larger neighbours of each node point at the smallest of its surroundings.
        large = hold(stars.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("low").alias("b")))
        # Small star: the smaller neighbours of each node and the node itself do so.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = hold(small.union(low.select("a", F.col("low").alias("b"))))
