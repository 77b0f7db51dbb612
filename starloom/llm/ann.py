"""Approximate nearest neighbours by adaptive dimension scans.

Vectors are dealt to inverted lists, turned by a random rotation and stored in column blocks of a few dimensions.
A query scans the lists nearest to it block by block. After each block the distances so far are extrapolated to all
dimensions, and a candidate whose distance is beyond the tenth best one found so far, by a hypothesis test on
the random projection, is abandoned. Distances of the survivors are computed anew from the original vectors in double precision.

Centroids, rotation and the share of lists to probe come from a bounded sample; every vector is indexed. A list is
stored in parts of about PART vectors and queries travel in groups, so no list gathers in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.session import materialize

SAMPLE = 20_000  # vectors that the centroids and the probing share are fitted on
LIST_SIZE = 512  # vectors a list should have; there are at most MOST_LISTS
MOST_LISTS = 2048
PART = 512  # vectors in a stored part of a list
GROUP = 64  # queries that travel together to a list
COLUMNS = 8  # dimensions of a column block
DOUBT = 2.4  # standard errors of the test that abandons a candidate
RECALL = 0.97  # recall on the sample that sets the probing share


@dataclass(frozen=True)
class Index:
    """Fitted on a sample: the rotation, the lists' centroids, and how many lists a query probes."""

    rotation: np.ndarray
    centroids: np.ndarray
    probes: int

    @property
    def dimensions(self) -> int:
        return len(self.rotation)

    def nearest_lists(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances of vectors to centroids, less the vectors' own length."""
        return (self.centroids**2).sum(axis=1)[None, :] - 2 * vectors @ self.centroids.T


def _home(index: Index, vectors: np.ndarray) -> np.ndarray:
    """The nearest list of each vector, worked out for some vectors at a time: all distances at once would be hundreds of megabytes."""
    parts = [np.argmin(index.nearest_lists(vectors[at : at + 1024]), axis=1) for at in range(0, len(vectors), 1024)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def fitted(sample: np.ndarray, rows: int, k: int, seed: int = 7) -> Index:
    """Lists for ``rows`` vectors like those in ``sample``; the probing share reaches RECALL on the sample itself."""
    random = np.random.default_rng(seed)
    size = sample.shape[1]
    rotation = np.linalg.qr(random.standard_normal((size, size)))[0]
    lists = int(np.clip(rows // LIST_SIZE, 1, min(MOST_LISTS, max(1, len(sample) // 8))))
    centroids = sample[random.choice(len(sample), lists, replace=False)]
    for _ in range(8):
        home = _home(Index(rotation, centroids, lists), sample)
        counts = np.bincount(home, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, sample)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    index = Index(rotation, centroids, lists)
    if lists == 1:
        return index
    home = _home(index, sample)
    asked = random.choice(len(sample), min(200, len(sample)), replace=False)
    far = (sample**2).sum(axis=1)[None, :] - 2 * sample[asked] @ sample.T
    far[np.arange(len(asked)), asked] = np.inf
    true = np.argpartition(far, min(k, len(sample) - 1) - 1, axis=1)[:, :k]
    order = np.argsort(index.nearest_lists(sample[asked]), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(lists)[None, :], axis=1)
    needed = np.sort(np.take_along_axis(place, home[true], axis=1).ravel())
    probes = int(needed[int(np.ceil(RECALL * len(needed))) - 1]) + 1
    return Index(rotation, centroids, probes)


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vector (array of double): not null, not zero, all components finite, id not null, one row per id and vector."""
    given = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    limit = "double('Infinity')"
    finite = F.expr(f"forall(vector, x -> x is not null and not isnan(x) and abs(x) < {limit})")
    return given.where(F.col("id").isNotNull() & (F.size("vector") > 0) & F.coalesce(finite, F.lit(False)) & F.expr("exists(vector, x -> x <> 0)"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _homes(index: Index):
    schema = pa.schema([("id", pa.int64()), ("vector", pa.list_(pa.float64())), ("list", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                home = np.argmin(index.nearest_lists(_matrix(batch.column(1))), axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(schema.field(1).type), pa.array(home)], schema=schema)

    return run


def _probed(index: Index, sizes: np.ndarray, k: int):
    """The lists of each query: the index's number of probes, and as many more as hold k + 1 vectors together."""
    schema = pa.schema([("id", pa.int64()), ("vector", pa.list_(pa.float64())), ("list", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                order = np.argsort(index.nearest_lists(_matrix(part.column(1))), axis=1, kind="stable")
                held = np.cumsum(sizes[order], axis=1)
                use = (np.arange(order.shape[1])[None, :] < index.probes) | (held - sizes[order] < k + 1)
                row, place = np.nonzero(use & (sizes[order] > 0))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take).cast(schema.field(1).type), pa.array(order[row, place].astype(np.int32))], schema=schema
                )

    return run


def _stored_part(index: Index):
    """One row per part of a list: ids, original vectors, and the rotated vectors in column blocks."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        vectors = _matrix(table["vector"].combine_chunks())
        turned = vectors @ index.rotation
        blocks = [np.ascontiguousarray(turned[:, a : a + COLUMNS].T).tobytes() for a in range(0, index.dimensions, COLUMNS)]
        return pa.table(
            {
                "list": table["list"][:1],
                "part": table["part"][:1],
                "ids": pa.array([table["id"].to_numpy().tobytes()], pa.binary()),
                "vectors": pa.array([vectors.tobytes()], pa.binary()),
                "blocks": pa.array([blocks], pa.list_(pa.binary())),
            }
        )

    return run


def _query_group(table: pa.Table) -> pa.Table:
    table = table.sort_by("id")
    vectors = _matrix(table["vector"].combine_chunks())
    return pa.table({"list": table["list"][:1], "queries": pa.array([table["id"].to_numpy().tobytes()], pa.binary()), "asked": pa.array([vectors.tobytes()], pa.binary())})


def scanned(index: Index, ids: np.ndarray, vectors: np.ndarray, blocks: list[np.ndarray], query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the k nearest vectors of a part that the scan finds; the query's own row takes no part."""
    total = index.dimensions
    turned = query @ index.rotation
    alive = np.flatnonzero(ids != query_id)
    bound, allowed = np.inf, 0.0
    sure = np.zeros(len(ids), dtype=bool)
    if len(alive) > 4 * k:  # the first few vectors, by all dimensions, set the bound
        first = alive[: 4 * k]
        far = ((vectors[first] - query) ** 2).sum(axis=1)
        best = np.lexsort((ids[first], far))[:k]
        sure[first[best]] = True  # they are the answer unless nearer ones are found
        bound = far[best[-1]] * (1 + 1e-9)
        # Rotated vectors and queries are rounded apart, so equal ones differ a little; no vector within the bound is longer than this sum.
        length = np.sqrt((query**2).sum())
        allowed = 1e-9 * (length**2 + (length + np.sqrt(bound)) ** 2)
    partial = np.zeros(len(alive))
    done = 0
    for block in blocks:
        columns = block[:, alive] if len(alive) < block.shape[1] else block
        partial += ((columns - turned[done : done + len(block), None]) ** 2).sum(axis=0)
        done += len(block)
        if done < total and np.isfinite(bound):
            # The distance of a random projection lies within (1 + doubt / sqrt(done)) of the whole one, scaled.
            keep = (partial * (total / done) <= bound * (1 + DOUBT / np.sqrt(done)) ** 2 + allowed) | sure[alive]
            alive, partial = alive[keep], partial[keep]
    if not len(alive):
        return ids[:0], partial
    exact = np.sqrt(np.cumsum((vectors[alive] - query) ** 2, axis=1)[:, -1])
    best = np.lexsort((ids[alive], exact))[:k]
    return ids[alive][best], exact[best]


def _search(index: Index, k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    size = index.dimensions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = {name: batch.column(i)[at] for i, name in enumerate(batch.schema.names)}
                ids = np.frombuffer(row["ids"].as_py(), np.int64)
                vectors = np.frombuffer(row["vectors"].as_py(), np.float64).reshape(-1, size)
                blocks = [np.frombuffer(b, np.float64).reshape(-1, len(ids)) for b in row["blocks"].as_py()]
                queries = np.frombuffer(row["queries"].as_py(), np.int64)
                asked = np.frombuffer(row["asked"].as_py(), np.float64).reshape(-1, size)
                found = [scanned(index, ids, vectors, blocks, q, v, k) for q, v in zip(queries.tolist(), asked, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(queries, [len(f[0]) for f in found])),
                        pa.array(np.concatenate([f[0] for f in found])),
                        pa.array(np.concatenate([f[1] for f in found])),
                    ],
                    schema=schema,
                )

    return run


def neighbours(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows found for each query, nearest first: query_id, rank (from 1), id, score (Euclidean distance).

    Candidates are all rows but those with the query's own id; equal distances go to the smaller id. Null and zero
    vectors, and those with null or non-finite components, take no part on either side; nor do vectors whose length is
    not the most frequent one (the smaller of equals). A row that repeats an id with the same vector counts once; of two vectors of an
    id the nearer counts. Fewer candidates than k are all returned. No usable row: no result.
    """
    spark = rows.sparkSession
    base = usable(rows, id_col, vector_col)
    lengths = base.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    if lengths is None:
        return empty
    base = materialize(base.where(F.size("vector") == lengths.n).dropDuplicates(), "vectors")
    asked = usable(queries, id_col, vector_col).where(F.size("vector") == lengths.n).dropDuplicates()
    # Ids hash evenly, so this is a random sample of about SAMPLE vectors, however many there are; it fits the lists only.
    picked = base.where(F.pmod(F.xxhash64("id"), F.lit(lengths["count"])) < SAMPLE)
    sample = picked.toArrow()
    sample = sample.sort_by("id") if len(sample) else base.limit(SAMPLE).toArrow()
    index = fitted(_matrix(sample["vector"].combine_chunks()), lengths["count"], k)

    shape = "id long, vector array<double>, list int"
    homes = materialize(base.mapInArrow(_homes(index), shape), "homes")
    sizes = np.zeros(len(index.centroids), dtype=np.int64)
    for row in homes.groupBy("list").count().collect():  # one row per list
        sizes[row.list] = row["count"]
    parts = spark.createDataFrame([(i, int(-(-n // PART))) for i, n in enumerate(sizes) if n], "list int, parts int")
    split = homes.join(F.broadcast(parts), "list").withColumn("part", F.expr("cast(pmod(xxhash64(id), parts) as int)"))
    stored = split.select("id", "vector", "list", "part").groupBy("list", "part").applyInArrow(
        _stored_part(index), "list int, part int, ids binary, vectors binary, blocks array<binary>"
    )
    stored = materialize(stored, "parts")

    probed = materialize(asked.mapInArrow(_probed(index, sizes, k), shape), "probed")
    groups = probed.groupBy("list").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    dealt = probed.join(materialize(groups, "group-counts"), "list").withColumn("group", F.expr("cast(pmod(xxhash64(id), groups) as int)"))
    grouped = dealt.select("id", "vector", "list", "group").groupBy("list", "group").applyInArrow(_query_group, "list int, queries binary, asked binary")
    grouped = materialize(grouped, "query-groups")

    # Every part of a list meets the list's groups in a place of its own, so a crowded list is no task's alone.
    sent = grouped.join(F.broadcast(parts), "list").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
    met = stored.join(sent, ["list", "part"]).select("ids", "vectors", "blocks", "queries", "asked")
    found = met.mapInArrow(_search(index, k), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
