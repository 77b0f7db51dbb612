"""Surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialize

# monotonically_increasing_id keeps the row number of a task in its low 33 bits.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1
PLACE, _TASK = "_place", "_task"


def last_key(df: DataFrame, key: str) -> int:
    return df.agg(F.max(key)).first()[0] or 0


def surrogate_keys(df: DataFrame, key: str, order_by: Sequence[str], start: int = 0) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` in the order of their unique ``order_by`` key.

    Rows are range-partitioned and sorted by the key and written once with their
    task and place in it. Numbering then needs only the row count of each range:
    as many rows as there are shuffle partitions.
    """
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return numbered(materialize(placed(ordered), key), key, start).select(key, *[c for c in df.columns if c != key])


def placed(df: DataFrame) -> DataFrame:
    """Rows with their task and place in it. They number rows only once they are written: a task that is run again may see others."""
    return df.withColumn(PLACE, F.monotonically_increasing_id())


def task_counts(written: DataFrame, wanted: str = "true") -> DataFrame:
    """How many of the placed rows each task wrote, all and wanted ones: one row a task, which bounds what is broadcast."""
    task = F.expr(f"shiftright({PLACE}, {_ROW_BITS})").alias(_TASK)
    return written.groupBy(task).agg(F.count("*").alias("_rows"), F.count_if(F.expr(wanted)).alias("_wanted"))


def numbered(written: DataFrame, key: str, start: int = 0, counts: DataFrame | None = None) -> DataFrame:
    """Number placed rows from ``start + 1`` without gaps, by task and place. With ``counts`` of wanted rows, these come first in
    each task and they alone are to be numbered."""
    counts = task_counts(written) if counts is None else counts
    before = "sum(_wanted) OVER (ORDER BY _task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = counts.selectExpr(f"{_TASK}", f"coalesce({before}, 0) AS _offset")
    rows = written.withColumn(_TASK, F.expr(f"shiftright({PLACE}, {_ROW_BITS})")).join(F.broadcast(offsets), _TASK)
    number = F.expr(f"CAST({start + 1} + _offset + ({PLACE} & {_ROW_MASK}) AS BIGINT)")
    return rows.withColumn(key, number).drop(_TASK, "_offset", PLACE)
