"""Nearest neighbours against brute force; quality against its formulas and held-out labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import ann, quality


def table(spark, rows):
    given = [(i, v, 1, 0.5) for i, v in rows]
    return spark.createDataFrame(given, "vec_id long, embedding array<double>, list int, score double")


def brute(rows, asked, k):
    found = {}
    for q, v in asked:
        far = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, x in rows if i != q)
        found[q] = far[:k]
    return found


def test_recall_over_many_lists(spark):
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.standard_normal((3000, 16)), 0.01 * rng.standard_normal((1500, 16)) + 1])  # a third nearly the same
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    asked = rows[::100]
    got = ann.neighbours(table(spark, rows), table(spark, asked), k=10).collect()
    want = brute(rows, asked, 10)
    hits = sum((r.score, r[2]) in {(round(d, 9), i) for d, i in want[r.query_id]} or r[2] in {i for _, i in want[r.query_id]} for r in got)
    assert len(got) == 10 * len(asked) and hits >= 0.95 * len(got)
    for r in got:
        assert r.score == pytest.approx(float(np.linalg.norm(points[r.query_id] - points[r[2]])), abs=1e-12)


def test_ties_nulls_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0]), (3, [0.0, 1.0]), (9, [0.0, 1.0]), (4, [0.0, -1.0]), (1, None), (2, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (10, [1.0, 2.0, 3.0]), (5, [1.0, 0.0]), (None, [1.0, 1.0]), (11, [])]
    got = ann.neighbours(table(spark, rows), table(spark, rows), k=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r[2]) for r in got if r.query_id == 5] == [(5, 1, 3), (5, 2, 4)]
    assert [(r[2], r.score) for r in got if r.query_id == 3] == [(9, 0.0), (5, pytest.approx(2**0.5))]
    assert {r.query_id for r in got} == {3, 4, 5, 9}
    assert [r[2] for r in ann.neighbours(table(spark, rows[:2]), table(spark, rows[:1])).collect()] == [3]
    assert ann.neighbours(table(spark, []), table(spark, [])).collect() == []


def test_an_abandoning_scan_finds_what_a_full_one_does():
    rng = np.random.default_rng(2)
    points = rng.standard_normal((600, 64))
    index = ann.fitted(points, len(points), 10)
    turned = points @ index.rotation
    blocks = [np.ascontiguousarray(turned[:, a : a + ann.COLUMNS].T) for a in range(0, 64, ann.COLUMNS)]
    same = 0
    for q in range(100):
        ids, far = ann.scanned(index, np.arange(600), points, blocks, q, points[q], 10)
        true = np.argsort(np.linalg.norm(points - points[q], axis=1))[1:11]
        same += len(set(ids.tolist()) & set(true.tolist()))
        assert (np.diff(far) >= 0).all()
    assert same >= 985


@pytest.mark.parametrize("dimensions", [32, 96, 384])
def test_copies_are_found_in_the_order_of_their_ids(dimensions):
    rng = np.random.default_rng(dimensions)
    index = ann.fitted(rng.standard_normal((600, dimensions)), 512, 10)
    for step in (0.0, 0.3):  # copies of the query, copies of a neighbour
        points = rng.standard_normal((512, dimensions)) * 100
        asked = points[7].copy()
        copies = np.sort(rng.choice(np.arange(8, 512), 200, replace=False))
        points[copies] = asked + step * rng.standard_normal(dimensions)
        turned = points @ index.rotation
        blocks = [np.ascontiguousarray(turned[:, a : a + ann.COLUMNS].T) for a in range(0, dimensions, ann.COLUMNS)]
        ids, far = ann.scanned(index, np.arange(512), points, blocks, 7, asked, 10)
        want = brute(list(enumerate(points)), [(7, asked)], 10)[7]
        assert ids.tolist() == [i for _, i in want] and far == pytest.approx([d for d, _ in want])


def test_copies_in_a_table(spark):
    rng = np.random.default_rng(6)
    points = rng.standard_normal((400, 32))
    points[10:210] = points[5]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    got = ann.neighbours(table(spark, rows), table(spark, [rows[5], rows[150]])).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r[2], r.score) for r in got] == [(5, i, 0.0) for i in range(10, 20)] + [(150, i, 0.0) for i in (5, *range(10, 19))]


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    learn = labels.where("doc_id % 3 > 0")
    scores = quality.scored(docs, learn, host=F.col("source"), path=F.concat_ws("/", "source", "lang"))
    rows = scores.join(labels.where("doc_id % 3 = 0"), "doc_id").select("kept", "quality").collect()
    assert len(rows) > 50 and sum(r.kept == bool(r.quality) for r in rows) >= 0.95 * len(rows)


def test_posteriors_shrink_toward_the_level_above(spark):
    rows = [(i, "word " * 20, "big", "big/a", 1.0) for i in range(60)] + [(100 + i, "word " * 20, "bad", "bad/a", 0.0) for i in range(60)]
    rows += [(200, "word " * 20, "small", "small/a", 0.0), (300, None, None, None, 1.0), (300, "", None, None, 1.0)]
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, h string, p string, quality double, score int, host int")
    got = {r.doc_id: r for r in quality.scored(docs, docs, F.col("h"), F.col("p")).collect()}
    assert len(got) == len(rows) - 1
    whole = sum(r[4] for r in rows) / len(rows)
    assert got[0].host_posterior > 0.9 and got[100].host_posterior < 0.1
    assert 0 < got[200].host_posterior < whole  # one document moves its host a little only
    assert got[200].path_posterior < got[200].host_posterior
    assert got[300].host is None and got[300].path is None


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "h", "p"), (1, "a b c", "h", "p")], "doc_id long, text string, h string, p string")
    none = spark.createDataFrame([(1, None)], "doc_id long, quality double")
    got = quality.scored(docs, none, F.col("h"), F.col("p")).collect()
    assert [(r.evidence, round(r.score, 6), r.kept) for r in got] == [(0.5, 0.5, True)] * 2
    assert quality.scored(docs.limit(0), none.limit(0), F.col("h"), F.col("p")).collect() == []


def test_a_label_says_nothing_about_its_own_document(spark):
    rows = [(i, "word " * (10 + i % 7), f"h{i % 40}", f"h{i % 40}/{i % 3}") for i in range(2000)] + [(5000, "word " * 12, "alone", "alone/a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string, p string")
    known = [(i, float(i % 5 == 0 or i % 2)) for i in range(0, 2000, 3)]
    scores = []
    for own in (0.0, 1.0):
        labels = spark.createDataFrame([*known, (5000, own)], "doc_id long, quality double")
        scores.append({r.doc_id: r.score for r in quality.scored(docs, labels, F.col("h"), F.col("p")).where("doc_id in (5000, 4)").collect()})
    assert abs(scores[0][5000] - scores[1][5000]) < 0.02 and abs(scores[0][4] - scores[1][4]) < 0.02


def test_the_only_document(spark):
    docs = spark.createDataFrame([(1, "a b c", "h", "p")], "doc_id long, text string, h string, p string")
    label = spark.createDataFrame([(1, 1.0)], "doc_id long, quality double")
    got = quality.scored(docs, label, F.col("h"), F.col("p")).collect()
    assert [(r.doc_id, round(r.score, 6)) for r in got] == [(1, 0.5)]


def test_a_crowded_list_is_searched_whole(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 64)
    monkeypatch.setattr(ann, "GROUP", 8)
    rng = np.random.default_rng(5)
    points = rng.standard_normal((900, 8)) * 0.01
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    asked = rows[::10]
    got = ann.neighbours(table(spark, rows), table(spark, asked), k=3).collect()
    want = brute(rows, asked, 3)
    assert len(got) == 3 * len(asked) and sum(r[2] in {i for _, i in want[r.query_id]} for r in got) >= 0.95 * len(got)
