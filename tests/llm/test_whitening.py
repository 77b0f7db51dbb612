"""Whitening against the eigenvectors of the covariance."""

import math

import numpy as np
import pytest

from starloom.llm import queries, whitening


def by_numpy(vectors, most=8):
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    centred = apart / n
    variances, found = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(variances)[::-1][:most]
    return n, [sum(int(e) ** 2 for e in row) for row in apart], centred @ found[:, order], variances[order], variances.sum()


def check(got, ids, vectors, accurate=1e-8):
    n, deviations, projected, variances, total = by_numpy(vectors)
    assert len(got) == len(ids) * len(variances)
    table = {(r.vec_id, r.component): r for r in got}
    for c, variance in enumerate(variances):
        rows = [table[i, c + 1] for i in ids]
        assert [r.deviation for r in rows] == deviations and {r.n for r in rows} == {n}
        assert all(abs(r.explained - variance / total) <= 1e-10 for r in rows) and all(r.identity_error <= 1e-9 for r in rows)
        if variance <= 1e-12 * total:
            assert all(r.whitened is None for r in rows)
            continue
        want = projected[:, c] / math.sqrt(variance)
        mine = np.array([r.whitened for r in rows])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) <= accurate


@pytest.mark.parametrize("size", [1, 3, 12, 40])
def test_components_are_those_of_the_covariance(spark, size):
    rng = np.random.default_rng(size)
    vectors = (rng.standard_normal((300, size)) * np.linspace(3, 0.2, size) + rng.random(size) * 50).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), 1, 2.0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, component int, n double").repartition(7)
    check(whitening.whitened(rows).collect(), range(300), vectors)


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((50, 5)).tolist()
    odd = [None, [], [1.0, None, 1.0, 1.0, 1.0], [1.0, math.nan, 1.0, 1.0, 1.0], [1.0, math.inf, 1.0, 1.0, 1.0], [1.0] * 4, [1e300] * 5]
    rows = [*enumerate(vectors), *((100 + i, v) for i, v in enumerate(odd)), (None, vectors[0]), (3, vectors[3])]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 52 * 5 and {r.n for r in got} == {52}
    of = lambda i: sorted((r.component, r.deviation, round(r.whitened, 9)) for r in got if r.vec_id == i)
    assert of(None) == of(0) and len(of(3)) == 10
    assert not {r.vec_id for r in got} & set(range(100, 107))
    nothing = spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")
    assert whitening.whitened(nothing).collect() == [] and whitening.whitened(nothing.limit(0)).collect() == []


def test_too_few_directions(spark):
    rng = np.random.default_rng(7)
    flat = rng.standard_normal((80, 3)) @ rng.standard_normal((3, 6))
    flat = np.round(flat * 1024) / 1024  # nearly, but not quite, of three dimensions
    constant = np.column_stack([rng.standard_normal((80, 2)), np.ones((80, 4))])
    for vectors in (flat, constant, np.ones((5, 3)), np.ones((1, 3)), np.repeat(np.eye(6), 10, axis=0)):
        rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        got = whitening.whitened(rows).collect()
        n, deviations, _, variances, total = by_numpy(vectors)
        assert len(got) == len(vectors) * min(8, vectors.shape[1])
        by_component = {r.component: r for r in got}
        for c, variance in enumerate(variances, 1):
            assert abs(by_component[c].explained - (variance / total if total else 0)) <= 1e-10
            assert (by_component[c].whitened is None) == (variance <= 1e-12 * total)
        assert all(r.identity_error <= 1e-9 for r in got)
        assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviations)


def test_deviations_are_exact_or_null(spark):
    rows = spark.createDataFrame([(i, [float(i * 10_000_000), 0.5]) for i in range(5)], "vec_id long, embedding array<double>")
    _, deviations, *_ = by_numpy([(i * 10_000_000.0, 0.5) for i in range(5)])
    got = {r.vec_id: r.deviation for r in whitening.whitened(rows).where("component = 1").collect()}
    assert got == {i: d if d < 1 << 63 else None for i, d in enumerate(deviations)}
    assert None in got.values() and any(d and d > 1 << 53 for d in got.values()) or got[2] == 0


def test_the_query(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()
    sound = [r for r in vectors if r.embedding and all(e is not None and math.isfinite(e) for e in r.embedding)]
    got = queries.op13_lanczos_whitening(spark, "/root/testdata/sf0.001").collect()
    check(got, [r.vec_id for r in sound], [r.embedding for r in sound], accurate=1e-6)
