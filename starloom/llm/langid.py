"""Language by compression: a text is compressed with a dictionary of each language, and the shortest result names it.

Texts are folded to lower-case letters and blanks, and compressed in blocks so that the dictionary stays the
main source of matches however long a text is; the block sizes add up. A run of blanks is put behind every text: without
it the compressor stores a short text as it is, and all languages come out equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm import shared

BLOCK_BYTES = 4096
NARROW = 0.01  # least lead of the best language over the next, as a share of the next one's size
SAMPLE_TEXTS, SAMPLE_CHARS = 256, 256  # a dictionary is made of about so many pieces of so many characters
UNKNOWN = "und"
_PAD = b" " * 200
_SEARCH = {"strategy": zstandard.STRATEGY_GREEDY, "min_match": 4, "window_log": 17, "hash_log": 16, "chain_log": 16, "search_log": 3, "target_length": 16}


def folded(text: Column) -> Column:
    """Lower-case letters and their marks; everything else is a blank."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{M}]+", " "))


def learned_dictionaries(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """One dictionary per non-null language of ``rows``, the most frequent language first.

    It holds the middle SAMPLE_CHARS letters of about SAMPLE_TEXTS texts picked by the hash of id and text, so its size does not
    grow with the rows; all rows are counted, and rows that repeat are one. Languages without any letter in their texts are left out.
    """
    given = rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    given = given.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    given = given.withColumn("draw", F.xxhash64("id", "text"))
    # How many different rows a language has decides the share that is picked, so a language of any size has some, and one of few has all.
    kinds = given.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("draw").alias("different")).collect()
    counts = {r.lang: r.n for r in kinds}
    if not counts:
        return {}
    share = given.sparkSession.createDataFrame([(r.lang, max(1, r.different)) for r in kinds], "lang string, different long")
    picked = given.join(F.broadcast(share), "lang").where(F.pmod("draw", F.col("different")) < SAMPLE_TEXTS)
    letters = folded(F.col("text"))
    middle = F.substring(letters, F.greatest(F.lit(1), ((F.length(letters) - SAMPLE_CHARS) / 2).cast("int")), F.lit(SAMPLE_CHARS))
    pieces = picked.select("lang", "id", "draw", middle.alias("piece")).dropDuplicates(["lang", "draw"])
    found: dict[str, list[str]] = {}
    for row in sorted(pieces.collect(), key=lambda r: (r.lang, r.id, r.draw)):
        found.setdefault(row.lang, []).append(row.piece)
    return {lang: " ".join(found[lang]).encode() for lang in sorted(found, key=lambda x: (-counts[x], x))}


def _compressors(dictionaries: dict[str, bytes]) -> list[zstandard.ZstdCompressor]:
    made = []
    for data in dictionaries.values():
        settings = zstandard.ZstdCompressionParameters(write_content_size=False, write_checksum=False, write_dict_id=False, **_SEARCH)
        raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(compression_params=settings)
        made.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=raw))
    return made


def _sizes(compressors: list[zstandard.ZstdCompressor], data: bytes) -> np.ndarray:
    blocks = [data[at : at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)]
    return np.array([sum(len(c.compress(b)) for b in blocks) for c in compressors], dtype=np.float64)


def _lead(sizes: np.ndarray) -> float:
    if len(sizes) < 2:
        return 1.0
    best, second = np.partition(sizes, 1)[:2]
    return float((second - best) / second)


def predicted(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", narrow: float = NARROW) -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score (0 to 1), margin, rejected (the margin is under ``narrow``, or no language).

    lang_pred is the language whose dictionary compresses the whole text best; among equals the more frequent one. A
    null text, one without a letter, and any text if no language was learned give ``und``, score 0 and margin 0. Other
    columns of ``docs`` are not looked at; rows that repeat are judged each.
    """
    names = list(dictionaries)
    text = F.col(text_col).cast("string")
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.when(text.rlike(r"\p{L}"), folded(text)).alias("letters"))
    schema = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(dictionaries)
        for batch in batches:
            langs, scores, margins = [], [], []
            for at in range(0, len(batch), 256):
                for letters in batch.column(1).slice(at, 256).to_pylist():
                    if letters is None or not names:
                        langs.append(UNKNOWN), scores.append(0.0), margins.append(0.0)
                        continue
                    sizes = _sizes(compressors, letters.strip().encode() + _PAD)
                    best = int(np.argmin(sizes))
                    langs.append(names[best])
                    scores.append(float(1 / np.exp2(np.maximum(sizes[best] - sizes, -1000)).sum()))
                    margins.append(_lead(sizes))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())], schema=schema)

    shown = given.mapInArrow(run, "id long, lang_pred string, score double, margin double")
    return shown.select(F.col("id").alias(id_col), "lang_pred", "score", "margin", ((F.col("margin") < narrow) | (F.col("lang_pred") == UNKNOWN)).alias("rejected"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 2 when divided by 4. False for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
