"""Mixture-controlled packing by deficit round-robin.

Every source is a queue of token ids. A round grants each source credit in the
ratio of the target shares and takes as many tokens as the credit covers; what
is left is carried into the next round, so after any number of windows a source
is within a token of its target. When a queue is empty the others share its part.
Sources beyond the OWN_QUEUES largest share SHARED_QUEUES queues, dealt by a hash of their names, so any number of sources is packed.
A window is a fixed number of sequences; its sources lie one after the other and
are cut into sequences without gaps, so only the very last sequence is padded.

The credit of all sources after w windows follows from w alone (``Schedule.served``),
so any task can take up the round-robin at any window with the deficits carried.
Documents queue in the order of the tokenised table: one pass writes that table
with running totals inside each of its parts, the totals of the parts are summed
up, and a second pass over the table cuts every document where its windows end.
Token ids stay where they were written while the queues of all parts can be broadcast; beyond
Spark's threshold they are shuffled once, evenly, by source and part.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm import shared
from starloom.llm.bytelevel import byte_characters
from starloom.session import materialize

OWN_QUEUES, SHARED_QUEUES = 8000, 256  # queues of one source each, and of the sources that are smaller than all those
MOST_SERVED = 1 << 20  # windows times queues that are worked out at a time
# The vocabulary's splitting rule; the second form is equal on texts without two white-space characters in a row.
_SPLIT = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPLIT_SINGLE = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
_TWO_SPACES = re.compile(r"\s\s")
# The splitting rule looks back over a run of white space, which its engine does for some ten thousands of characters only.
_WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_WHITE = re.compile(_WHITE + "{1000,}+")


class Encoder:
    """Ids of texts as the tokenizers library gives them for a byte-level vocabulary file, special strings included."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind = spec["pre_tokenizer"]
        if spec["normalizer"] or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"]:
            raise ValueError(f"{path}: not a plain byte-level vocabulary")
        self.path = path
        self.special = [t["content"] for t in spec["added_tokens"]]
        back = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("single", pat_str=_SPLIT_SINGLE, mergeable_ranks=ranks, special_tokens={})
        self.exact = tiktoken.Encoding("any", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.library = None

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path)
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        if not _TWO_SPACES.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        parts, at = [], 0
        for run in _LONG_WHITE.finditer(text):
            # All of the run but the character before a word is one piece; that character goes on with the word.
            end = run.end() if run.end() == len(text) else run.end() - 1
            parts += [self.exact.encode_to_numpy(text[at : run.start()], disallowed_special=()), self.whole.encode_to_numpy(run.group()[: end - run.start()], disallowed_special=())]
            at = end
        last = self.exact.encode_to_numpy(text[at:] if at else text, disallowed_special=())
        return np.concatenate([*parts, last]) if parts else last


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


@cache
def id_width(path: str) -> str:
    """Number type that holds the vocabulary's ids."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    most = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return "<u2" if most < 1 << 16 else "<u4"


class Schedule:
    """How many tokens of each source lie before a window, for totals and target shares by source."""

    def __init__(self, totals: np.ndarray, shares: np.ndarray, window: int):
        self.totals, self.window = totals.astype(np.int64), window
        self.shares = shares / shares.sum() if len(shares) else shares
        self.tokens = int(self.totals.sum())
        self.end = float((self.totals / self.shares).max()) + 1.0 if len(shares) else 0.0

    def _granted(self, clock: np.ndarray) -> np.ndarray:
        """Tokens covered by the credit of every source when ``clock`` tokens' worth has been granted to all."""
        return np.clip(np.floor(clock[:, None] * self.shares + 0.5), 0, self.totals).astype(np.int64)

    def served(self, windows: np.ndarray) -> np.ndarray:
        """(windows, sources): tokens taken from each queue before each window; rows sum to the window's first token."""
        goal = np.minimum(windows.astype(np.int64) * self.window, self.tokens)
        low, high = np.zeros(len(goal)), np.full(len(goal), self.end)
        for _ in range(80):
            middle = (low + high) / 2
            under = self._granted(middle).sum(axis=1) <= goal
            low, high = np.where(under, middle, low), np.where(under, high, middle)
        taken = self._granted(low)
        # Credits that are covered at the same instant are served in the order of the sources.
        spare = self._granted(high) - taken
        lacking = goal - taken.sum(axis=1)
        before = np.cumsum(spare, axis=1) - spare
        return taken + np.clip(lacking[:, None] - before, 0, spare)

    def cut(self, source: int, start: np.ndarray, size: np.ndarray, length: int) -> dict[str, np.ndarray]:
        """Pieces of documents that lie at ``start`` in a source's queue: row, from, count, sequence, offset."""
        first = max(0, self._window_of(source, int(start.min())) - 2)
        last = self._window_of(source, int((start + size).max())) + 3
        step = max(1, MOST_SERVED // max(1, len(self.totals)))
        parts = [self._cut_windows(source, start, size, length, w, min(w + step, last)) for w in range(first, last, step)]
        return {name: np.concatenate([part[name] for part in parts]) for name in parts[0]}

    def _cut_windows(self, source: int, start: np.ndarray, size: np.ndarray, length: int, first: int, last: int) -> dict[str, np.ndarray]:
        """The pieces that lie in the windows first..last-1."""
        served = self.served(np.arange(first, last + 1))
        mine = served[:, source]
        ahead = served[:, :source]
        base = (ahead[1:] - ahead[:-1]).sum(axis=1)  # what earlier sources have in each window
        here = np.flatnonzero((start < mine[-1]) & (start + size > mine[0]))
        head, tail = np.maximum(start[here], mine[0]), np.minimum((start + size)[here], mine[-1])
        one = np.searchsorted(mine, head, side="right") - 1
        two = np.searchsorted(mine, tail - 1, side="right") - 1
        row, window = _spread(one, two)
        begin = np.maximum(head[row], mine[window])
        stop = np.minimum(tail[row], mine[window + 1])
        full = stop > begin  # a source may have nothing in a window
        row, window, begin, stop = here[row[full]], window[full], begin[full], stop[full]
        place = base[window] + begin - mine[window]
        part, sequence = _spread(place // length, (place + stop - begin - 1) // length)
        left = np.maximum(place[part], sequence * length)
        right = np.minimum((place + stop - begin)[part], (sequence + 1) * length)
        return {
            "row": row[part],
            "from": begin[part] - start[row[part]] + left - place[part],
            "count": right - left,
            "sequence": (window[part] + first) * (self.window // length) + sequence,
            "offset": left - sequence * length,
        }

    def _window_of(self, source: int, position: int) -> int:
        """The window of a queue's token, or one beside it."""
        clock = np.array([min(self.end, (position + 0.5) / self.shares[source])])
        return int(self._granted(clock).sum()) // self.window


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers from first to last of every row: their rows and the numbers."""
    n = last - first + 1
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[row]


def _tokenised(path: str, end_id: int, width: str):
    schema = pa.schema([("id", pa.int64()), ("source", pa.string()), ("part", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path).ids, TaskContext.get().partitionId()
        running: dict[str, int] = {}
        end = np.array([end_id], dtype=width).tobytes()
        for batch in batches:
            at = 0
            for some in shared.strings(batch.column(2)):
                sources = batch.column(1).slice(at, len(some)).to_pylist()
                ids, before, counts = [], [], []
                for source, text in zip(sources, some, strict=True):
                    own = encode(text).astype(width).tobytes() + end
                    n = len(own) // len(end)
                    ids.append(own)
                    counts.append(n)
                    before.append(running.get(source, 0))
                    running[source] = before[-1] + n
                columns = [
                    batch.column(0).slice(at, len(some)), pa.array(sources, pa.string()), pa.array([part] * len(some), pa.int64()),
                    pa.array(before, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                at += len(some)

    return run


def _pieces(schedule: Schedule, length: int, width: str):
    schema = pa.schema([("id", pa.int64()), ("source", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
    bytes_each = np.dtype(width).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                some = batch.slice(at, 512)
                number, start, size = (some.column(k).to_numpy() for k in (2, 3, 4))
                found = []
                for source in np.unique(number).tolist():
                    rows = np.flatnonzero(number == source)
                    cut = schedule.cut(source, start[rows], size[rows], length)
                    found.append(cut | {"row": rows[cut["row"]]})
                row, begin, count, sequence, offset = (np.concatenate([f[k] for f in found]) for k in ("row", "from", "count", "sequence", "offset"))
                # The documents' ids lie one behind the other; a piece is a stretch of them.
                held = some.column(5).cast(pa.large_binary())
                _, at_ids, data = held.buffers()
                whole = np.frombuffer(at_ids, np.int64)[held.offset :]
                every = np.frombuffer(data, np.uint8)[whole[0] : whole[len(some)]].view(width).astype("<u4")
                base = (whole[: len(some)] - whole[0]) // bytes_each
                order = np.lexsort((begin, row))
                row, begin, count, sequence, offset = (x[order] for x in (row, begin, count, sequence, offset))
                if not np.array_equal(base[row] + begin, np.cumsum(count) - count) or count.sum() != len(every):
                    raise RuntimeError("pieces do not cover the documents")
                ends = np.concatenate([[0], np.cumsum(count)]) * 4
                ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(every)]).cast(pa.binary())
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pc.take(some.column(0), take), pc.take(some.column(1), take), pa.array(begin), pa.array(count), pa.array(size[row]), pa.array(sequence), pa.array(offset), ids],
                    schema=schema,
                )

    return run


def packed(
    docs: DataFrame, vocabulary: str, length: int = 1024, window_sequences: int = 64, end_id: int = 0, targets: dict[str, float] | None = None,
    power: float = 1.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per piece of a document: id, source, start, length, doc_tokens, sequence_id, offset, ids (little-endian 32-bit).

    Every document's ids, followed by ``end_id``, lie in the pieces once and in order. ``targets`` weighs the sources; one without weight gets the
    smallest one given. Without targets a source weighs its tokens to the ``power``: 1 gives every window the mixture of the whole, less raises small
    sources until they run out. A null source is a queue of its own, a null text is empty, rows that repeat are packed each. Sources that share a queue add
    up their weights. A window has ``window_sequences`` sequences, or more where they could not hold a few tokens of every queue. An empty table gives no rows.
    """
    given = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("source"),
        F.col(text_col).cast("string").alias("text"),
    )
    width = id_width(vocabulary)
    table = materialize(
        given.mapInArrow(_tokenised(vocabulary, end_id, width), "id long, source string, part long, before long, n_tokens long, ids binary"), "tokens"
    )
    parts = materialize(table.groupBy("source", "part").agg(F.sum("n_tokens").alias("n")), "parts")
    sizes = materialize(parts.groupBy("source").agg(F.sum("n").alias("n")), "sources")
    own = [row.source for row in sizes.orderBy(F.desc("n"), "source").limit(OWN_QUEUES).collect()]
    queues = docs.sparkSession.createDataFrame([(name, f"own {name}") for name in own], "source string, queue string")
    queue = F.coalesce("queue", F.concat(F.lit("shared "), F.pmod(F.xxhash64("source"), F.lit(SHARED_QUEUES)).cast("string")))
    named = materialize(sizes.join(F.broadcast(queues), "source", "left").select("source", "n", queue.alias("queue")), "queue-names")
    weight = F.pow("n", F.lit(power))
    if targets:
        asked = docs.sparkSession.createDataFrame([(f"={name}", float(w)) for name, w in targets.items()], "source string, weight double")
        named = named.join(F.broadcast(asked), "source", "left")
        weight = F.coalesce("weight", F.lit(float(min(targets.values()))))
    totals = named.groupBy("queue").agg(F.sum("n").alias("n"), F.sum(weight).alias("weight")).orderBy("queue").collect()  # OWN_QUEUES + SHARED_QUEUES at most
    names = [row.queue for row in totals]
    counts, weights = np.array([row.n for row in totals], dtype=np.int64), np.array([row.weight for row in totals], dtype=np.float64)
    schedule = Schedule(counts, weights, max(window_sequences, -(-4 * len(names) // length)) * length)
    numbers = docs.sparkSession.createDataFrame([(name, i) for i, name in enumerate(names)], "queue string, number long")
    earlier = Window.partitionBy("queue").orderBy("source", "part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.join(named.select("source", "queue"), "source").withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    queued = materialize(ahead.join(F.broadcast(numbers), "queue").select("source", "part", "number", "ahead"), "queues")
    placed = table.join(queued, ["source", "part"]).select(
        "id", F.expr("nullif(source, '')").alias("source"), "number", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "ids"
    )
    cut = placed.mapInArrow(
        _pieces(schedule, length, width), "id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
    return cut.withColumnRenamed("id", id_col).withColumn("source", F.expr("substring(source, 2)"))
