"""Near duplicates by HyperMinHash.

Every document's shingle set becomes 256 registers of a leading-zero count and
ten mantissa bits. Bands of six registers are bucket keys, so two sets of
similarity 0.8 share a bucket but for three cases in a million. Candidates are
estimated from their registers, corrected for equal values by chance, and what
passes is confirmed on the full sets.

Copies with the same set are one node. In a bucket the smallest node is compared
with all others first, which links a large group of near copies in as many
comparisons as it has members. Buckets whose nodes are still in several
components are then compared block by block inside tasks, all nodes of other
components with each other; only links leave a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import shared, shingles
from starloom.session import files_for, materialize

DOCS_IN_FILE = 4_000  # of the documents, for each file of sets or links
KINDS_IN_FILE = 25_000  # with all their bands
BLOCK = 256  # nodes of a bucket compared with as many at a time
SLACK = 5  # standard errors by which an estimate may miss the threshold


def _sketches(words: int):
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("same", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, ends in shared.texts(batch.column(1)):
                sets = shingles.shingle_sets(data, ends, words)
                keys = shingles.band_keys(shingles.registers(sets))
                same = [hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets]
                flat = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, shingles.BANDS, dtype=np.int32), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, stop - first), pa.array([len(s) for s in sets], pa.int64()), pa.array(same, pa.binary()), flat],
                    schema=schema,
                )

    return run


def _full_sets(words: int):
    schema = pa.schema([("id", pa.int64()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, ends in shared.texts(batch.column(1)):
                sets = [s.tobytes() for s in shingles.shingle_sets(data, ends, words)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, stop - first), pa.array(sets, pa.binary())], schema=schema)

    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    place = np.searchsorted(large, small)
    both = int((large[np.minimum(place, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _similar_to(a: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the others are similar to ``a``; none of the sets is empty."""
    sizes = np.array([len(b) for b in others])
    flat = np.concatenate(others)
    place = np.searchsorted(a, flat)
    both = np.add.reduceat(a[np.minimum(place, len(a) - 1)] == flat, np.cumsum(sizes) - sizes, dtype=np.int64)
    return 100 * both >= percent * (len(a) + sizes - both)


def _least_estimate(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Estimates below this are out: the threshold less SLACK standard errors, with the registers a set of that size fills."""
    own = shingles.REGISTERS * -np.expm1(-sizes / shingles.REGISTERS)
    share = percent / 100
    return share - SLACK * np.sqrt(share * (1 - share) / np.maximum(own, 1))


def _confirmed(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                left, right = ([np.frombuffer(x, np.uint64) for x in part.column(k).to_pylist()] for k in (2, 3))
                seems = shingles.estimated_jaccard(shingles.registers(left), shingles.registers(right))
                least = _least_estimate(np.array([min(len(x), len(y)) for x, y in zip(left, right, strict=True)]), percent)
                yes = [bool(s >= m) and _similar(x, y, percent) for s, m, x, y in zip(seems, least, left, right, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], schema=schema).filter(pa.array(yes, pa.bool_()))

    return run


def _block_links(percent: int):
    """Links between components, by nodes of two blocks of a bucket (or within one).

    A pair that shares an earlier band meets in that band's bucket. One link per pair of components
    is enough there too, so components joined on the way are not compared again.
    """

    def run(table: pa.Table) -> pa.Table:
        component, block = table["component"].to_numpy(), table["block"].to_numpy()
        band, low, high = (table[c][0].as_py() for c in ("key", "i", "j"))
        sets = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        regs = shingles.registers(sets)
        keys = shingles.band_keys(regs)
        where = int(np.argmax(keys[0] == band))
        sizes = np.array([len(s) for s in sets])
        least = _least_estimate(sizes, percent)
        root = component.copy()
        links: list[tuple[int, int]] = []
        inner = low == high
        rows = np.arange(len(block)) if inner else np.flatnonzero(block == low)
        others = rows if inner else np.flatnonzero(block == high)
        for x in rows.tolist():
            against = others[others > x] if inner else others
            against = against[root[against] != root[x]]
            if not len(against):
                continue
            ratio = np.minimum(sizes[against], sizes[x]) * 100 >= percent * np.maximum(sizes[against], sizes[x])
            against = against[ratio]
            against = against[~(keys[against, :where] == keys[x, :where]).any(axis=1)]
            if len(against):
                seems = shingles.estimated_jaccard(regs[against], regs[x][None])
                against = against[seems >= np.minimum(least[against], least[x])]
            step = 8
            while len(against):  # ever more at once, without those that are joined by then
                now, against = against[:step], against[step:]
                for y in now[_similar_to(sets[x], [sets[y] for y in now.tolist()], percent)].tolist():
                    if root[y] != root[x]:
                        links.append((int(component[x]), int(component[y])))
                        root[root == root[y]] = root[x]
                against = against[root[against] != root[x]]
                step *= 4
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable by links), kept (id = component_id).

    A text's set holds the distinct ``words``-word shingles of its whole text (A-Z folded; words are separated by
    ASCII white space); a text of fewer words is one shingle, and one without words, empty or null is linked with
    nothing and kept. Two documents are linked if 100 * intersection >= percent * union. Rows that repeat an id are
    one document; rows whose id is null are kept, with a null component. Other columns of ``docs`` are not looked at.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketched = materialize(
        given.mapInArrow(_sketches(words), "id long, n_shingles long, same binary, bands array<long>"), "sketches"
    )
    spark, rows = docs.sparkSession, sketched.count()
    linkable = sketched.where("id is not null and same is not null")
    kinds = linkable.groupBy("same").agg(F.min_by("bands", "id").alias("bands"), F.min("id").alias("node"))
    kinds = materialize(kinds, "kinds", files=files_for(spark, rows, KINDS_IN_FILE))
    keyed = kinds.select("node", F.explode("bands").alias("key"))
    per_key = files_for(spark, rows * shingles.BANDS)
    shared_keys = keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    shared_keys = materialize(shared_keys, "buckets", files=per_key)
    members = materialize(keyed.join(shared_keys, "key").select("key", "pivot", "node"), "members")

    wanted = members.select(F.col("node").alias("id")).distinct()
    texts = given.join(wanted, "id", "left_semi").dropDuplicates(["id"])
    sets = materialize(texts.mapInArrow(_full_sets(words), "id long, hashes binary"), "sets", files=files_for(spark, rows, DOCS_IN_FILE))

    star = members.where("pivot <> node").select("pivot", "node").distinct()
    pairs = (
        star.join(sets.select(F.col("id").alias("node"), F.col("hashes").alias("right")), "node")
        .join(sets.select(F.col("id").alias("pivot"), F.col("hashes").alias("left")), "pivot")
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"), "left", "right")
    )
    links = materialize(pairs.mapInArrow(_confirmed(percent), "a long, b long"), "links", files=files_for(spark, rows, DOCS_IN_FILE))
    roots = shared.linked_groups(links)

    # The pivot has met all others of its bucket; what is left is between the others' components.
    rest = members.where("pivot <> node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("component"))
    rest = materialize(rest, "rest")
    mixed = rest.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
    mixed = mixed.where("lo <> hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = rest.join(materialize(mixed, "open-buckets", files=per_key), "key").withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    dealt = dealt.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.select("key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", F.col("node").alias("id"), "component")
    more = dealt.join(sets, "id").groupBy("key", "i", "j").applyInArrow(_block_links(percent), "a long, b long")
    # These link components, few as a rule; the nodes' own links are not walked a second time.
    joined = shared.linked_groups(materialize(more, "links")).toDF("component", "whole")

    out = sketched.drop("bands").withColumn("same", F.coalesce("same", F.encode(F.concat(F.lit("none "), F.col("id").cast("string")), "utf-8")))
    out = out.join(kinds.select("same", "node"), "same", "left").join(roots, "node", "left")
    out = out.withColumn("component", F.coalesce("root", "node", "id")).join(joined, "component", "left")
    out = out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("whole", "component").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
