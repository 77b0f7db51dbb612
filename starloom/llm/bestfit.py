"""Best-fit packing by bin completion: every document whole in one sequence where it fits, in as few sequences as the search finds.

Which lengths share a sequence depends only on how many pieces have each length, and there are no more lengths than tokens in a
sequence. So the pieces are tokenised and written once, counted by length, and a plan is searched over these counts
(``completion``): patterns, each a few lengths and a number of sequences. Then the pieces of a length are numbered, by the counts
of each written part, and a piece's number names its sequence and its place there. What the driver holds are the counts and
the plan, which do not grow with the documents. A piece's ids stay where they were written while the counts of parts and lengths can be broadcast;
beyond Spark's threshold they are shuffled once, evenly, by part and length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm import shared
from starloom.llm.completion import NODES, Solution, completed
from starloom.llm.packing import encoder
from starloom.session import materialize

PIECES = "id {}, piece int, start long, length int, ids binary, part int, place long"


def _pieces(vocabulary: str, end_id: int, length: int):
    """The pieces of each document, numbered within the part by their length. Only the first of a long one is short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(vocabulary).ids, TaskContext.get().partitionId()
        numbered = np.zeros(length + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            at = 0
            for some in shared.strings(batch.column(1)):
                rows, pieces, starts, sizes, ids, places = [], [], [], [], [], []
                for row, text in enumerate(some, at):
                    own = np.concatenate([encode(text).astype("<u4"), end])
                    bounds = [0, *range(len(own) % length or length, len(own) + 1, length)] if len(own) > length else [0, len(own)]
                    for number, (start, stop) in enumerate(zip(bounds, bounds[1:])):
                        rows.append(row)
                        pieces.append(number)
                        starts.append(start)
                        sizes.append(stop - start)
                        ids.append(own[start:stop].tobytes())
                        places.append(numbered[stop - start])
                        numbered[stop - start] += 1
                    if len(ids) >= 1000:
                        yield _batch(batch, rows, pieces, starts, sizes, ids, part, places)
                        rows, pieces, starts, sizes, ids, places = [], [], [], [], [], []
                yield _batch(batch, rows, pieces, starts, sizes, ids, part, places)
                at += len(some)

    return run


def _batch(batch: pa.RecordBatch, rows: list, pieces: list, starts: list, sizes: list, ids: list, part: int, places: list) -> pa.RecordBatch:
    made = [pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int32()), pa.array(ids, pa.binary())]
    made += [pa.array([part] * len(rows), pa.int32()), pa.array(places, pa.int64())]
    names = ["id", "piece", "start", "length", "ids", "part", "place"]
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *made], names=names)


class Plan:
    """Where the n-th piece of each length goes."""

    def __init__(self, solution: Solution):
        self.bins = solution.bins
        slots, next_place, sequence = [], {}, 0
        for bins, lengths in solution.patterns:
            offset = 0
            for length in dict.fromkeys(lengths):  # equal lengths lie side by side
                copies, first = lengths.count(length), next_place.get(length, 0)
                slots.append((length, first, copies, sequence, offset))
                next_place[length] = first + bins * copies
                offset += copies * length
            sequence += bins
        slots.sort()
        self.slots = np.array(slots, dtype=np.int64).reshape(-1, 5)
        self.keys = self._key(self.slots[:, 0], self.slots[:, 1])

    @staticmethod
    def _key(length: np.ndarray, place: np.ndarray) -> np.ndarray:
        return length << 44 | place

    def places(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of these lengths with these numbers."""
        slot = self.slots[np.searchsorted(self.keys, self._key(length, number), side="right") - 1]
        within = number - slot[:, 1]
        return slot[:, 3] + within // slot[:, 2], slot[:, 4] + within % slot[:, 2] * length


def packed(
    docs: DataFrame, vocabulary: str, length: int = 1024, end_id: int = 2, nodes: int = NODES, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, piece (from 0), start, length, ids (little-endian 32-bit), sequence_id, offset.

    A document is its ids and ``end_id``. One of at most ``length`` tokens is one piece; a longer one is cut into pieces of
    ``length`` and a first one with what is left over. Sequences are numbered from 0 without gaps, and pieces lie in them without
    gaps from offset 0. A null text is empty, so its document is the end alone; rows that repeat are packed each, null ids too. ``nodes`` bounds the
    search (see ``completion``), not what is packed. Other columns are not looked at; an empty table gives no rows.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shape = PIECES.format(docs.schema[id_col].dataType.simpleString())
    table = materialize(given.mapInArrow(_pieces(vocabulary, end_id, length), shape), "pieces")
    parts = materialize(table.groupBy("part", "length").agg(F.count("*").alias("n")), "part-lengths")
    counts = np.zeros(length + 1, dtype=np.int64)
    for row in parts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        counts[row["length"]] = row.n
    plan = Plan(completed(counts, length, nodes))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = materialize(parts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead")), "ahead")

    @F.pandas_udf("sequence long, offset long")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.places(lengths.to_numpy(np.int64), numbers.to_numpy(np.int64))
        return pd.DataFrame({"sequence": sequence, "offset": offset})

    placed = table.join(ahead, ["part", "length"]).withColumn("at", place("length", F.col("ahead") + F.col("place")))
    return placed.select(
        F.col("id").alias(id_col), "piece", "start", F.col("length").cast("long").alias("length"), "ids",
        F.col("at.sequence").alias("sequence_id"), F.col("at.offset").alias("offset"),
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id and the ids of each sequence, for training files. A sequence has no more pieces than tokens, so a group is small."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda done, p: F.concat(done, p["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))
