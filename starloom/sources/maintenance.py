"""Compaction, retention and statistics of published tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starloom.functions.columns import utc_text
from starloom.session import children, delete, exists, free_shuffles, materialize, scratch_scope
from starloom.sources.tables import ACCEPTED, BUCKET, EPOCH, FILE, FILE_ROWS, MARKER, Table, numbered_children, read_or_none, write_rows

# Fixed value: hours a superseded load stays readable, at least.
RETENTION_HOURS = 168
SPAN_ROWS = 40_000_000  # facts that a compaction shuffles at a time
CURVE_BITS = 6  # of the rank in a column that a row is placed by
CURVE_SAMPLE = 20_000  # rows that the ranges of the ranks are taken from


def cluster(
    df: DataFrame, column: str | Sequence[str], spread_by: list[str], files: int | None = None, first: Sequence[str] = (), place: Column | None = None
) -> DataFrame:
    """Rows range-partitioned and sorted by a column, or along a curve through several.

    ``spread_by`` breaks ties, so that one value holding much of the table is cut into several ranges. ``first`` comes before
    all. Without ``files`` Spark sizes the partitions. ``place`` is the curve, where the rows are a part of those it was made of.
    """
    columns = [column] if isinstance(column, str) else list(column)
    by = [*first, columns[0] if len(columns) == 1 else "_curve", *spread_by]
    rows = df if len(columns) == 1 else df.withColumn("_curve", curve(df, columns) if place is None else place)
    ranged = rows.repartitionByRange(*by) if files is None else rows.repartitionByRange(files, *by)
    return ranged.sortWithinPartitions(*by).drop("_curve")


def curve(df: DataFrame, columns: Sequence[str]) -> Column:
    """A row's place on a Z-order curve: the bits of its ranks in the columns, taken in turn.

    A rank is which of 2 ** CURVE_BITS ranges of about equal size a value lies in. The ranges' limits come from a sample of about CURVE_SAMPLE rows;
    they decide where rows lie, not which there are. NULL lies in the first range.
    """
    share = min(1.0, CURVE_SAMPLE / max(1, df.count()))
    sample = df.select(*columns).sample(share, seed=5).collect()
    ranks = []
    for name in columns:
        values = sorted(v for row in sample if (v := row[name]) is not None)
        limits = sorted({values[len(values) * k // 2**CURVE_BITS] for k in range(1, 2**CURVE_BITS)}) if values else []
        kind = df.schema[name].dataType
        ranks.append(_rank(F.col(name), [F.lit(v).cast(kind) for v in limits]))
    place = F.lit(0).cast("long")
    for bit in range(CURVE_BITS):
        for k, rank in enumerate(ranks):
            taken = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(taken, bit * len(columns) + len(columns) - 1 - k))
    return place


def _rank(value: Column, limits: list[Column]) -> Column:
    """How many of the limits a value reaches; none for NULL."""
    reached = F.size(F.filter(F.array(*limits), lambda limit: value >= limit)) if limits else F.lit(0)
    return F.when(value.isNotNull(), reached).otherwise(0)


def compact_cluster(
    table: Table, spread_by: list[str], now: dt.datetime, files: int | None = None, column: str | Sequence[str] | None = None
) -> int:
    """Rewrite a fact or appended table as one load and publish it in place of the earlier ones.

    Facts are clustered by their date unless another column is given; several columns are clustered along a curve, within the months of a fact.
    A large fact is shuffled and written some months at a time, unless ``files`` are given.
    """
    last = table.marker()
    if last is None:
        raise ValueError(f"nothing was published to {table.path}")
    column = column or table.clustered_by
    if table.kind not in ("fact", "rows") or column is None:
        raise ValueError(f"{table.path} is not a fact and names no column to cluster by")
    load_id, parts, first, spans = last.load_id + 1, [], [], [None]
    if table.kind == "fact":
        parts = ["status", "date_month"]
        first = [] if column == table.clustered_by else ["date_month"]
        spans = _month_spans(table, last) if files is None else spans
    place = None if isinstance(column, str) or len(column) == 1 else curve(table.current(last), column)
    with free_shuffles(table.spark):
        for number, months in enumerate(spans):
            rows = table.current(last, months)
            if table.kind == "fact":
                month = F.expr(f"{table.clustered_by} div 100").cast("int")
                rows = rows.withColumns({"status": F.lit(ACCEPTED), "date_month": month})
            write_rows(cluster(rows, column, spread_by, files, first, place), table.rows_path(load_id), *parts, append=number > 0)
    table.publish(load_id, now, last, base_load_id=load_id, rows_inserted=0)
    return load_id


def _month_spans(table: Table, last: Row) -> list[list[int] | None]:
    """Runs of a fact's months with about SPAN_ROWS rows each; None where one run has all."""
    rows = table.rows_with_parts()
    if rows is None:
        return [None]
    visible = F.col("load_id").between(last.base_load_id, last.load_id) & (F.col("status") == ACCEPTED)
    counts = {r.date_month: r["count"] for r in rows.where(visible).groupBy("date_month").count().collect()}  # a row a month
    if None in counts or sum(counts.values()) <= SPAN_ROWS:
        return [None]
    spans, held = [[]], 0
    for month in sorted(counts):
        if spans[-1] and held + counts[month] > SPAN_ROWS:
            spans.append([])
            held = 0
        spans[-1].append(month)
        held += counts[month]
    return spans


def analyze_files(table: Table, columns: Sequence[str]) -> int:
    """Store the rows, and of each column the least and greatest value and the NULLs, of every file of a fact or appended table that has
    no statistics yet; gives how many files they are of. ``Table.current(where=...)`` passes over files by them.

    Files never change, so neither do their statistics. They lie in a folder for each load.
    """
    last, rows = table.marker(), table.rows_with_parts()
    if last is None or rows is None:
        return 0
    done = numbered_children(table.spark, f"{table.path}/stats", "load_id")
    new = [n for n in numbered_children(table.spark, f"{table.path}/rows", "load_id") if last.base_load_id <= n <= last.load_id and n not in done]
    if not new:
        return 0
    visible = F.col("load_id").between(min(new), max(new)) & ~F.col("load_id").isin(done)
    visible = visible & (F.col("status") == ACCEPTED) if table.kind == "fact" else visible
    measures = [F.count("*").alias(FILE_ROWS)]
    for c in columns:
        measures += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.count_if(F.col(c).isNull()).alias(f"{c}_nulls")]
    found = rows.where(visible).groupBy("load_id", F.col("_metadata.file_path").alias(FILE)).agg(*measures)
    with scratch_scope(table.spark):
        found = materialize(found, "file-statistics")
        for load_id in new:
            write_rows(found.where(F.col("load_id") == load_id).drop("load_id"), table.stats_path(load_id))
        return found.count()


def table_statistics(table: Table, columns: Sequence[str]) -> DataFrame:
    """Per column of the analysed files in use: rows, NULLs, least and greatest value as text. No row is read."""
    stats = table.file_statistics()
    if stats is None:
        return table.spark.createDataFrame([], "column_name string, row_count bigint, null_count bigint, least string, greatest string")
    one = stats.agg(
        F.sum(FILE_ROWS).alias(FILE_ROWS),
        *[m.alias(f"{c}{n}") for c in columns for m, n in ((F.min(f"{c}_min"), "_min"), (F.max(f"{c}_max"), "_max"), (F.sum(f"{c}_nulls"), "_nulls"))],
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(FILE_ROWS).alias("row_count"), F.col(f"{c}_nulls").alias("null_count"),
                 F.col(f"{c}_min").cast("string").alias("least"), F.col(f"{c}_max").cast("string").alias("greatest"))
        for c in columns
    ]
    return one.select(F.inline(F.array(*rows)))


def superseded(table: Table, now: dt.datetime, retention_hours: int = RETENTION_HOURS) -> list[str]:
    """Directories no reader needs: superseded by a load that was itself published longer ago than the retention.

    Such readers see the newest load older than the retention, or a later one. What its marker does not name, and is
    not younger, is out of use: a marker holds the whole state, so this one is all that is read. Rejected rows and expired versions are
    part of the table's history and always stay. Older markers go by epochs.
    """
    if retention_hours < RETENTION_HOURS:
        raise ValueError(f"retention must be at least {RETENTION_HOURS} hours")
    oldest = _newest_before(table, now - dt.timedelta(hours=retention_hours))
    if oldest is None:
        return []
    spark, paths = table.spark, []
    for load_id in numbered_children(spark, f"{table.path}/rows", "load_id"):
        path = table.rows_path(load_id)
        if table.kind.startswith("dim"):
            if load_id <= oldest.load_id:
                paths += [f"{path}/{BUCKET}={b}" for b in numbered_children(spark, path, BUCKET) if (oldest.bucket_loads or {}).get(b) != load_id]
        elif load_id < oldest.base_load_id:
            paths += [f"{path}/status={ACCEPTED}" if table.kind == "fact" else path, table.stats_path(load_id)]
    named = {f"run={run.first}-{run.last}" for run in oldest.key_runs or []}
    runs = [name for name in children(spark, f"{table.path}/keys") if name.startswith("run=")]
    paths += [f"{table.path}/keys/{name}" for name in runs if name not in named and int(name.split("-")[1]) <= oldest.load_id]
    paths += [f"{table.path}/published/epoch={epoch}" for epoch in table.epochs() if epoch < oldest.load_id // EPOCH]
    return [p for p in paths if exists(spark, p)]


def _newest_before(table: Table, cutoff: dt.datetime) -> Row | None:
    """The last marker that was published before a time. Epochs are read from the last one back, until one has such a marker."""
    for epoch in table.epochs():
        markers = read_or_none(table.spark, f"{table.path}/published/epoch={epoch}", MARKER)
        past = None if markers is None else markers.where(F.col("published_at") < F.lit(utc_text(cutoff)).cast("timestamp"))
        if past is not None and (row := past.orderBy(F.desc("load_id")).first()):
            return row
    return None


def expire_versions(table: Table, now: dt.datetime, retention_hours: int = RETENTION_HOURS) -> list[str]:
    """Delete the superseded directories; gives the paths deleted."""
    paths = superseded(table, now, retention_hours)
    for path in paths:
        delete(table.spark, path)
    return paths


def analyze_table(spark: SparkSession, table_name: str) -> None:
    """Collect the statistics the cost-based optimizer reads, for a table of the catalog."""
    spark.sql(f"ANALYZE TABLE {table_name} COMPUTE STATISTICS FOR ALL COLUMNS")
