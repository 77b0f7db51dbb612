"""Near duplicates against all pairs of full sets; the sketches against exact similarities."""

import random
import re

import numpy as np
import pytest

from starloom.llm import minhash, shared, shingles
from starloom.session import files_for, materialize, scratch_scope


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingle_set(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, size, percent=80):
    sets = {i: shingle_set(t, size) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def made(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["É", "ß", "x,"]
    fresh = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, rows = fresh(40), []
    for _ in range(40):
        base = fresh(rng.randint(1, 60))
        rows.append(base)
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(copy)
    chain = fresh(120)
    for k in range(25):  # a long chain of near copies whose ends are far apart
        chain = [*chain[: 4 * k], *fresh(2), *chain[4 * k + 2 :]]
        rows.append(list(chain))
    rows += [[*passage, *fresh(rng.randint(5, 30))] for _ in range(60)]
    texts = [rng.choice([" ", "\n", "\t  "]).join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in r) for r in rows]
    texts += [None, "", " \n", "one", "ONE", "two words", "two  words", "same " * 4000, "same " * 3000]
    order = list(enumerate(texts))
    rng.shuffle(order)
    return order


@pytest.mark.parametrize("size", [4, 5])
def test_components_are_those_of_all_pairs(documents, size):
    rows = made(size)
    got = minhash.near_duplicates(documents(*rows), words=size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_a_bucket_of_several_blocks(documents, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(1)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for k in range(60):
        copy = list(base)
        for _ in range(rng.randint(1, 6)):
            copy[rng.randrange(100)] = f"n{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(documents(*rows), words=4).collect()}
    assert got == brute(rows, 4)


def test_nothing_repeats_and_null_ids(documents):
    assert minhash.near_duplicates(documents()).collect() == []
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, "a b c d e f")]
    got = sorted(map(tuple, minhash.near_duplicates(documents(*rows)).collect()), key=repr)
    assert got == sorted([(5, 2, 2, False), (5, 2, 2, False), (None, 2, 2, True), (None, 0, None, True), (2, 2, 2, True)], key=repr)


@pytest.mark.parametrize("size", [3, 40, 2000])
def test_estimates_follow_similarity(size):
    rng = np.random.default_rng(size)
    errors = []
    for _ in range(30):
        pool = np.unique(rng.integers(0, 2**63, 2 * size, dtype=np.uint64) * np.uint64(2))
        a, b = np.sort(pool[: max(1, int(size * 0.9))]), np.sort(pool[max(0, int(size * 0.1)) : size])
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append(shingles.estimated_jaccard(shingles.registers([a]), shingles.registers([b]))[0] - exact)
    assert abs(np.mean(errors)) < 0.15 and (size < 1000 or np.abs(errors).max() < 0.13)


@pytest.fixture
def written(monkeypatch):
    """Names and numbers of files of the scratch tables that the near duplicates write."""
    tables = []

    def counted(df, name, row_group=None, files=None):
        out = materialize(df, name, row_group, files)
        tables.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(shared, "materialize", counted)
    monkeypatch.setattr(minhash, "materialize", counted)
    return tables


@pytest.fixture
def many_partitions(spark):
    """More shuffle partitions than small tables have use for, none of them put together."""
    own = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_linked_groups_end_as_soon_as_all_nodes_point_at_roots(spark, written, many_partitions):
    def groups(*edges):
        written.clear()
        with scratch_scope(spark):
            return {r.node: r.root for r in shared.linked_groups(spark.createDataFrame(edges, "a long, b long")).collect()}

    star = [(k % 3, k) for k in range(3, 200)]
    assert groups(*star) == {k: k % 3 for k in range(3, 200)} and len(written) == 1
    assert written[0][1] <= files_for(spark, len(star)) < 60
    assert groups() == {} and len(written) == 1
    rng = random.Random(3)
    for size, n in ((30, 25), (60, 40)):
        edges = [(rng.randrange(size), rng.randrange(size)) for _ in range(n)] + [(size + k, size + k + 1) for k in range(20)]
        root = list(range(size + 21))
        for _ in root:
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        assert groups(*edges) == {k: r for k, r in enumerate(root) if r != k}


def test_near_duplicates_walk_the_links_of_nodes_once_and_write_few_files(documents, spark, written, many_partitions):
    rng = random.Random(2)
    base = [f"b{k}" for k in range(100)]
    rows = [(k, " ".join(rng.choice(base[:9]) if rng.random() < 0.02 else w for w in base)) for k in range(120)]
    with scratch_scope(spark):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(documents(*rows), words=4).collect()}
    assert got == brute(rows, 4)
    assert max(n for name, n in written if name in {"kinds", "sets", "stars"}) <= files_for(spark, len(rows))
    assert "bands" not in dict(written) and "roots" not in dict(written)


def test_many_at_once_are_as_one_by_one(monkeypatch):
    rng = np.random.default_rng(5)
    pool = np.unique(rng.integers(0, 2**64, 400, dtype=np.uint64))
    sets = [np.sort(rng.choice(pool[:150], k, replace=False)) for k in rng.integers(1, 150, 200)]
    sets += [pool, pool[:1], pool[-1:], pool[:320]]
    for a in (sets[0], sets[7], pool, pool[:1]):
        assert minhash._similar_to(a, sets, 80).tolist() == [minhash._similar(a, b, 80) for b in sets]
    sets[3:3] = [np.empty(0, np.uint64)]
    alone = np.concatenate([shingles.registers([s]) for s in sets])
    monkeypatch.setattr(shingles, "RUN_HASHES", 500)
    assert (shingles.registers(sets) == alone).all() and not alone[3].any()
