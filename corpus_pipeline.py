"""Documents from raw to packed: language, near duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. The stages before the last return the
columns of documents as they came. Texts of the language stage's ``und`` and nearly tied ones go; of each group of near
duplicates (five words, similarity 0.8) the document with the smallest id stays, its repeated rows as one; documents with a benchmark passage go; personal
data is replaced by its kind and n_chars follows the text; what is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import decontam, langid, minhash, packing, pii, queries, shared
from starloom.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shared.prepare_workers(spark)
    judged = langid.predicted(docs, langid.learned_dictionaries(docs.where(~langid.held_out())))
    return _without(docs, judged.where("rejected"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shared.prepare_workers(spark)
    groups = minhash.near_duplicates(docs, words=5, percent=80)
    # A row's decision is its id's: rows that repeat an id are one document, and one of them stays.
    left = _without(docs, groups.where("not kept"))
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("repeated_id"))
    again = materialize(again, "repeated")
    once = left.join(again, left["doc_id"] == again["repeated_id"], "left_semi").dropDuplicates(["doc_id"])
    return left.join(again, left["doc_id"] == again["repeated_id"], "left_anti").unionByName(once)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shared.prepare_workers(spark)
    return _without(docs, decontam.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    changed = pii.masked(docs)
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else changed


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shared.prepare_workers(spark)
    pieces = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), length=1024, power=queries.MIXTURE)
    return pieces.select("doc_id", "source", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", no_benchmark),
    ("personal_data", no_personal_data),
    ("packing", packed),
]
ORACLE_SQL = None  # compression, sketches and merges are beyond SQL; tests/llm compares run() with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents, each stage's result written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not among the ids that go; null ids stay."""
    ids = materialize(gone.select(F.col("doc_id").alias("gone_id")).where("gone_id is not null").distinct(), "gone")
    return docs.join(ids, docs["doc_id"] == ids["gone_id"], "left_anti")
