"""A stored index of the natural keys of a table, so that a small batch is compared with few of them.

Keys lie in runs. A run holds the keys of one load or of several that follow each other, in buckets by a hash of the key, sorted by
that hash, with a Bloom filter in every file. A batch opens only the buckets its own keys fall into, and a batch
of a few keys asks for their hashes, which statistics and Bloom filters answer for most of what a bucket holds. A new run takes
up the runs before it that are not much larger, so there are few runs, and a key is written again a few times only. A run's
number of buckets follows from its size. Runs are named by the table's marker, so one that was not published is never seen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import codec

HASH, BUCKET = "key_hash", "bucket"
KEYS_PER_BUCKET = 1_000_000
MOST_BUCKETS = 1 << 14
POINTS = 64  # keys of a batch that are asked for one by one
RUN_TYPE = T.StructType([T.StructField(n, T.LongType()) for n in ("first", "last", "keys")]).add("buckets", T.IntegerType())


def power_of_two(least: float, most: int = MOST_BUCKETS) -> int:
    n = 1
    while n < least and n < most:
        n *= 2
    return n


@dataclass(frozen=True)
class KeyIndex:
    spark: SparkSession
    path: str
    columns: T.StructType
    keys_per_bucket: int = KEYS_PER_BUCKET

    def run_path(self, first: int, last: int) -> str:
        return f"{self.path}/run={first}-{last}"

    def added(self, runs: Sequence[Row], load_id: int, rows: DataFrame, number: int) -> list[tuple[int, int, int, int]]:
        """Write the keys of a load's ``number`` rows; gives the runs for the next marker.

        The run takes up those before it, the last first, while they are at most twice as large as it is by then.
        """
        runs, taken = [tuple(r) for r in runs], []
        if not number:
            return runs
        while runs and runs[-1][2] <= 2 * number:
            taken.append(runs.pop())
            number += taken[-1][2]
        first = taken[-1][0] if taken else load_id
        keys = reduce(DataFrame.unionByName, [self._read(run).select(*self.columns.names) for run in taken], rows.select(*self.columns.names))
        buckets = power_of_two(number / self.keys_per_bucket)
        self._write(keys, first, load_id, buckets, number)
        return [*runs, (first, load_id, number, buckets)]

    def rebuilt(self, load_id: int, rows: DataFrame) -> list[tuple[int, int, int, int]]:
        """All keys of a table written anew as one run, up to a load."""
        number = rows.count()
        buckets = power_of_two(number / self.keys_per_bucket)
        self._write(rows.select(*self.columns.names), 0, load_id, buckets, number)
        return [(0, load_id, number, buckets)]

    def near(self, runs: Sequence[Row], batch: DataFrame) -> DataFrame:
        """Loaded keys that could be among those of ``batch``: all that fall into the same buckets, or that have the same hashes."""
        hashes = batch.select(F.xxhash64(*self.columns.names).alias(HASH)).distinct()
        most = max([run[3] for run in runs], default=1)
        # Buckets are powers of two, so a bucket of the run with the most names those of all others. There are MOST_BUCKETS at most.
        wanted = sorted(r[0] for r in hashes.select(F.pmod(HASH, F.lit(most)).cast("int")).distinct().collect()) if most > 1 else [0]
        some = [r[0] for r in hashes.limit(POINTS + 1).collect()]
        found = []
        for run in runs:
            rows = self._read(tuple(run)).where(F.col(BUCKET).isin(sorted({b % run[3] for b in wanted})))
            if len(some) <= POINTS:
                rows = rows.where(_any([F.col(HASH) == F.lit(h) for h in some]))
            found.append(rows.select(*self.columns.names))
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], self.columns)

    def _read(self, run: tuple) -> DataFrame:
        fields = [T.StructField(HASH, T.LongType()), *self.columns.fields, T.StructField(BUCKET, T.IntegerType())]
        return self.spark.read.schema(T.StructType(fields)).parquet(self.run_path(run[0], run[1]))

    def _write(self, keys: DataFrame, first: int, last: int, buckets: int, number: int) -> None:
        rows = keys.select(F.xxhash64(*self.columns.names).alias(HASH), "*")
        rows = rows.withColumn(BUCKET, F.pmod(HASH, F.lit(buckets)).cast("int"))
        rows = rows.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, HASH)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", codec(self.spark))
        writer = writer.option(f"parquet.bloom.filter.enabled#{HASH}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{HASH}", str(max(1024, min(number, self.keys_per_bucket))))
        writer.partitionBy(BUCKET).parquet(self.run_path(first, last))


def _any(conditions: list):
    """One of the conditions, as a tree of little depth."""
    if not conditions:
        return F.lit(False)
    while len(conditions) > 1:
        conditions = [reduce(lambda a, b: a | b, conditions[i : i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]
