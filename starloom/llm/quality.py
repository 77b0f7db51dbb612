"""Quality by hierarchical empirical Bayes: what a document's text says, with what its host and path have shown.

A logistic classifier of the text gives every document evidence. Grouped sums of it, by host and by path within the host,
become posterior means of a beta distribution: a path shrinks toward its host and a host toward the whole table, the more
the fewer documents it has. How strongly is estimated from the spread of the groups (method of moments). A document's score joins
its own evidence with the posterior of its path, from which its own share has been taken out, as it has from those of the host and of
the whole table that the path shrinks toward: a document's label says nothing about itself. Only what is fitted on all, the classifier and the two
strengths, has seen it as one of many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm import shared
from starloom.llm.shingles import word_hashes
from starloom.session import materialize

TRAIN = 20_000  # labelled documents, about, that the classifier is fitted on
FEATURES = ("symbols", "capitals", "digits", "repeated_words", "repeated_lines", "word_length", "log_words", "marks_per_word")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "*#$%&|~^_=<>{}[]\\/@+!"]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in ".,;:?"]] = True


def _features(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text; texts lie one behind the other in ``data``."""
    starts = np.concatenate([[0], ends[:-1]])

    def count(flag: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flag)])
        return (sums[ends] - sums[starts]).astype(np.float64)

    size = np.maximum(ends - starts, 1).astype(np.float64)
    words, upto = word_hashes(data, ends)
    first = np.concatenate([[0], upto[:-1]])
    number = np.maximum(upto - first, 1).astype(np.float64)
    distinct = np.array([len(np.unique(words[a:b])) for a, b in zip(first, upto, strict=True)], dtype=np.float64)
    lines, same = [], []
    whole = data.tobytes()
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        parts = whole[a:b].split(b"\n")
        lines.append(len(parts))
        same.append(len(set(parts)))
    solid = count(data > 32)
    return np.column_stack(
        [
            count(_SYMBOL[data]) / size, count((data >= 65) & (data <= 90)) / size, count((data >= 48) & (data <= 57)) / size, 1 - distinct / number,
            1 - np.array(same) / np.array(lines), solid / number / 10, np.log1p(number) / 10, count(_MARK[data]) / number,
        ]
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, stop, data, ends in shared.texts(batch.column(3)):
            values = _features(data, ends)
            flat = pa.ListArray.from_arrays(np.arange(0, values.size + 1, len(FEATURES), dtype=np.int32), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(first, stop - first) for k in range(3)), flat], names=["id", "host", "path", "features"])


def fitted(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights (the constant last) of a logistic regression with squares of the features, and the labels' log-odds; zeros without both classes."""
    if not len(labels) or labels.min() > 0.5 or labels.max() < 0.5:
        return np.zeros(2 * len(FEATURES) + 1), 0.0
    x = np.column_stack([features, features**2, np.ones(len(features))])
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.05)
    ridge[-1] = 0
    for _ in range(40):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - labels) + ridge * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-6)
        step = np.linalg.solve(bend, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    rate = labels.mean()
    return weights, float(np.log(rate / (1 - rate)))


def _strength(groups: DataFrame, center: str) -> Column:
    """Pseudo-documents of a group's prior: how closely the groups' rates lie around ``center`` beyond chance."""
    rate = F.col("s") / F.col("n")
    middle = F.col(center)
    chance = middle * (1 - middle) / F.col("n")
    between = F.sum(F.col("n") * ((rate - middle) ** 2 - chance)) / F.sum("n")
    inner = F.sum(F.col("n") * middle * (1 - middle)) / F.sum("n")
    return F.least(F.lit(1e6), F.greatest(F.lit(1.0), inner / F.greatest(between, F.lit(1e-9)) - 1)).alias("strength")


def scored(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.5
) -> DataFrame:
    """One row per row of ``docs``: id, host, path, evidence (the text's probability of quality), host_posterior, path_posterior,
    score and kept (score of at least ``threshold``).

    Several labels of a document count as their mean, labels of unknown documents and null ones not at all. A null host or path is
    a group of its own. A null or empty text has the features of an empty one. Without labels of both classes the evidence is one half for
    all. Rows that repeat count each; other columns are not looked at. An empty table gives no rows.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).cast("long").alias("id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    measured = materialize(given.mapInArrow(_measured, "id long, host string, path string, features array<double>"), "features")
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label"))
    known = materialize(known.where("id is not null and label is not null").groupBy("id").agg(F.avg("label").alias("label")), "labels")
    total = known.count()
    # Ids hash evenly, so this is a random sample of about TRAIN labelled documents; the fit needs no more.
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(max(total, 1))) < TRAIN)
    rows = sorted(tuple(r) for r in measured.join(chosen, "id").select("id", "features", "label").collect())
    weights, base = fitted(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))

    linear = F.lit(float(weights[-1]))
    for i in range(len(FEATURES)):
        f = F.col("features")[i]
        linear = linear + f * float(weights[i]) + f * f * float(weights[len(FEATURES) + i])
    sure = lambda p: F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), p))
    logit = lambda p: F.log(sure(p) / (1 - sure(p)))
    told = measured.join(known, "id", "left").withColumn("z", F.least(F.lit(30.0), F.greatest(F.lit(-30.0), linear)))
    told = told.withColumn("evidence", 1 / (1 + F.exp(-F.col("z")))).withColumn("own", F.coalesce("label", "evidence"))
    told = materialize(told.select("id", F.coalesce(F.concat(F.lit("="), "host"), F.lit("")).alias("host"), F.coalesce(F.concat(F.lit("="), "path"), F.lit("")).alias("path"), "z", "evidence", "own"), "evidence")

    by_path = materialize(told.groupBy("host", "path").agg(F.sum("own").alias("s"), F.count("*").alias("n")), "paths")
    by_host = by_path.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    whole = by_path.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    middle = float(whole.s) / whole.n if whole.n else 0.5
    by_host = materialize(by_host.withColumn("middle", F.lit(middle)), "hosts")
    pull = by_host.agg(_strength(by_host, "middle")).first().strength or 1.0
    posterior = (F.col("s") + F.lit(pull * middle)) / (F.col("n") + F.lit(pull))
    hosts = by_host.select("host", F.col("s").alias("host_s"), F.col("n").alias("host_n"), posterior.alias("host_posterior"))
    paths = materialize(by_path.join(hosts, "host"), "path-sums")
    near = paths.agg(_strength(paths, "host_posterior")).first().strength or 1.0

    joined = told.join(paths, ["host", "path"])
    own = F.col("own")
    over_all = (F.lit(float(whole.s or 0.0)) - own) / F.lit(whole.n - 1) if whole.n and whole.n > 1 else F.lit(0.5)
    on_host = (F.col("host_s") - own + F.lit(pull) * over_all) / (F.col("host_n") - 1 + F.lit(pull))
    others = (F.col("s") - own + F.lit(near) * on_host) / (F.col("n") - 1 + F.lit(near))
    prior = (F.col("s") + F.lit(near) * F.col("host_posterior")) / (F.col("n") + F.lit(near))
    score = 1 / (1 + F.exp(-(F.col("z") - F.lit(base) + logit(others))))
    out = joined.select(
        F.col("id").alias(id_col), F.expr("if(host = '', null, substring(host, 2))").alias("host"), F.expr("if(path = '', null, substring(path, 2))").alias("path"),
        "evidence", "host_posterior", prior.alias("path_posterior"), score.alias("score"),
    )
    return out.withColumn("kept", F.col("score") >= threshold)
