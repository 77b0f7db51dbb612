"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With A the centred rows, every step multiplies A by one vector and the result by the transpose of A, in one pass: tasks
add up their rows' share, and the driver sees as many numbers as a vector has entries, and one for each step before. Left
vectors are as long as the table, so none is ever stored: each is A times a short vector, which is kept and corrected instead.
Both sides are made orthogonal to all earlier vectors at every step. As many steps as entries give a square bidiagonal matrix
whose singular values are the deviations of the components, and whose right vectors turn the Lanczos vectors into the components.
Where a product vanishes the subspace is complete, and the search goes on from a new direction orthogonal to it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialize

SCALE, SHIFT = 1024, 100_000  # an entry c becomes the whole number floor(SCALE * c) + SHIFT
LARGEST = 2.0**41  # entries beyond are no vector: their whole numbers would not be exact
VANISHED = 1e-11  # of the largest singular value seen: less is rounding


@dataclass(frozen=True)
class Centre:
    """Number of rows and sum of each dimension, both exact."""

    n: int
    sums: np.ndarray

    def scattered(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact."""
        return self.n * x - self.sums

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.scattered(x) / float(self.n)


@dataclass(frozen=True)
class Components:
    """Unit vectors as columns, by falling variance, the variances, and their total over all dimensions."""

    vectors: np.ndarray
    variances: np.ndarray
    total: float


def whole_numbers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and x, the vectors as whole numbers: not null, not empty, all entries finite, of the most frequent length (the smaller of equals)."""
    given = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("c"))
    sound = F.forall("c", lambda e: F.coalesce(F.abs(e) <= LARGEST, F.lit(False)) & ~F.isnan(e))
    given = given.where((F.size("c") > 0) & F.coalesce(sound, F.lit(False)))
    lengths = given.groupBy(F.size("c").alias("n")).count().orderBy(F.desc("count"), "n").first()
    given = given.where(F.size("c") == (lengths.n if lengths else 0))
    return given.select("id", F.transform("c", lambda e: F.floor(e * SCALE).cast("long") + SHIFT).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1)


def _added(table: DataFrame, share: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all rows of ``share``, which gives one batch's part of a vector of fixed length. Tasks add up before anything is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                part = share(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["place", "part"])

    parts = table.select("x").mapInArrow(run, f"place int, part {kind}")
    summed = parts.groupBy("place").agg(F.sum("part").alias("part")).collect()
    return np.array([row.part for row in sorted(summed, key=lambda row: row.place)])


def centre(table: DataFrame) -> Centre | None:
    n = table.count()
    return Centre(n, _added(table, lambda x: x.sum(axis=0), "long").astype(np.int64)) if n else None


def _orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalised(table: DataFrame, mid: Centre, seed: int = 13) -> Components:
    """All components of the centred rows; products are divided by the number of rows, so variances come out."""
    size, n = len(mid.sums), float(mid.n)
    random = np.random.default_rng(seed)
    right = np.empty((size, 0))  # Lanczos vectors
    short = np.empty((size, 0))  # left vectors, as what A is multiplied by
    back = np.empty((size, 0))  # the transpose of A times the left vectors
    entries: list[tuple[int, int, float]] = []  # of the bidiagonal matrix: left, right, value
    total = _added(table, lambda x: (mid.rows(x) ** 2).sum(axis=0), "double").sum() / n
    largest, coupling, pending = 0.0, 0.0, None
    while right.shape[1] < size:
        if pending is None:  # a first direction, or a new one beside a complete subspace
            fresh = _orthogonal(random.standard_normal(size), right)
            pending, coupling = fresh / np.linalg.norm(fresh), 0.0
        right = np.column_stack([right, pending])
        column = right.shape[1] - 1
        ask = pending - coupling * short[:, -1] if coupling else pending
        if coupling:
            entries.append((short.shape[1] - 1, column, coupling))
        held = np.column_stack([short, ask])

        def products(x: np.ndarray, held: np.ndarray = held) -> np.ndarray:
            a = mid.rows(x)
            left = a @ held
            return np.concatenate([a.T @ left[:, -1], left.T @ left[:, -1]])

        sums = _added(table, products, "double") / n
        turned, inner, square = sums[:size], sums[size:-1], sums[-1]
        ask, turned, square = ask - short @ inner, turned - back @ inner, square - inner @ inner
        alpha = float(np.sqrt(max(square, 0.0)))
        largest = max(largest, alpha, coupling)
        if alpha <= VANISHED * max(largest, np.sqrt(total)):
            pending = None
            continue
        entries.append((short.shape[1], column, alpha))
        short, back = np.column_stack([short, ask / alpha]), np.column_stack([back, turned / alpha])
        rest = _orthogonal(back[:, -1] - alpha * pending, right)
        coupling = float(np.linalg.norm(rest))
        largest = max(largest, coupling)
        pending = rest / coupling if coupling > VANISHED * max(largest, np.sqrt(total)) else None
    matrix = np.zeros((max(short.shape[1], 1), size))
    for row, column, value in entries:
        matrix[row, column] = value
    _, deviations, turn = np.linalg.svd(matrix, full_matrices=True)
    variances = np.zeros(size)
    variances[: len(deviations)] = deviations**2
    return Components(right @ turn.T, variances, float(total))


def _scores(mid: Centre, vectors: np.ndarray, variances: np.ndarray):
    names = ["id", "deviation", "scores"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            apart = mid.scattered(_matrix(batch.column(1)))
            near = (apart.astype(np.float64) ** 2).sum(axis=1)
            deviation = (apart * apart).sum(axis=1).tolist()
            for row in np.flatnonzero(near > 2.0**62).tolist():  # whole numbers of any size; what a long cannot hold is null
                exact = sum(int(e) ** 2 for e in apart[row])
                deviation[row] = exact if exact < 1 << 63 else None
            scores = (apart / float(mid.n)) @ vectors
            with np.errstate(divide="ignore", invalid="ignore"):
                scores = np.where(variances > 0, scores / np.sqrt(variances), np.nan)
            flat = pa.array(scores.ravel(), mask=np.isnan(scores.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(scores) + 1, dtype=np.int32) * scores.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), lists], names=names)

    return run


def whitened(rows: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, hold a null, non-finite or enormous entry (beyond 2^41), or are not of the most frequent length take
    no part. Repeated rows and null ids do. ``deviation`` is null where it exceeds a long. Components number at most
    as many as dimensions. One without variance has a null ``whitened``, is explained 0, and is left out of
    ``identity_error``, which is 0 if none has any. An empty table gives no rows. Which of equal variances comes first, and signs, are the same for all rows.
    """
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    table = materialize(whole_numbers(rows, id_col, vector_col), "whole-numbers")
    mid = centre(table)
    if mid is None:
        return spark.createDataFrame([], f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    found = bidiagonalised(table, mid)
    most = min(components, len(mid.sums))
    variances = np.where(found.variances[:most] > VANISHED**2 * found.total, found.variances[:most], 0.0)
    scored = table.mapInArrow(_scores(mid, found.vectors[:, :most], variances), f"id {kind}, deviation long, scores array<double>")
    scored = materialize(scored, "scores")
    some = [i for i in range(most) if variances[i] > 0]
    pairs = [F.covar_pop(F.col("scores")[i], F.col("scores")[j]).alias(f"c{i}_{j}") for i in some for j in some if i <= j]
    error = 0.0
    if pairs:
        covariance = scored.agg(*pairs).first()
        error = max(abs(covariance[f"c{i}_{j}"] - (i == j)) for i in some for j in some if i <= j)
    shares = [float(v / found.total) if found.total > 0 else 0.0 for v in variances]
    long = scored.select("id", "deviation", F.posexplode("scores").alias("place", "whitened"))
    return long.select(
        F.col("id").alias(id_col), (F.col("place") + 1).cast("int").alias("component"), F.lit(mid.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, shares)), F.col("place")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
