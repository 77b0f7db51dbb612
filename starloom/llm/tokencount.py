"""Token counts by byte-pair merging with a heap and a linked list, without making ids.

A word's symbols lie in a linked list; a heap holds the rank of every adjacent
pair. The lowest-ranked pair is merged until no pair has a rank, and the count
is the number of symbols less the number of merges. The splitting rules and the
merge table come from the vocabulary file. Counts of words and of blank-separated
stretches are kept, up to KEPT entries a worker, so that frequent ones are merged once.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import shared
from starloom.llm.bytelevel import byte_characters

KEPT = 400_000
_WIDE = 20  # bits of an id within a pair's key


class _Counts(dict):
    """Counts that are worked out when first asked for and forgotten when too many are held."""

    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, text: str) -> int:
        n = self.count(text)
        if len(text) <= 64:
            if len(self) >= KEPT:
                self.clear()
            self[text] = n
        return n


class MergeCounter:
    """Counts the tokens of texts for a word-end byte-pair vocabulary in the tokenizers library's file format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        odd = [t for t in spec["added_tokens"] if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or odd:
            raise ValueError(f"{path}: not a lower-case word-end byte-pair vocabulary")
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_characters()
        self.inner = [ids[x] for x in letters]
        self.final = [ids[x + suffix] for x in letters]
        self.pairs = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs[ids[a] << _WIDE | ids[b]] = (rank, ids[a + b])
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.word = regex.compile(split["pattern"]["Regex"])
        self.path = path
        self.words = _Counts(self.merged)
        self.stretches = _Counts(lambda text: sum(map(self.words.__getitem__, self.word.findall(text))))

    def merged(self, word: str) -> int:
        """Symbols of one word less the merges made."""
        data = word.encode()
        ids = [self.inner[b] for b in data[:-1]]
        ids.append(self.final[data[-1]])
        count = len(ids)
        if count == 1:
            return 1
        pairs, shift = self.pairs, count.bit_length()
        mask = (1 << shift) - 1
        heap = []
        for at in range(count - 1):
            found = pairs.get(ids[at] << _WIDE | ids[at + 1])
            if found:
                heap.append(found[0] << shift | at)
        heapq.heapify(heap)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        end = count
        while heap:
            entry = heapq.heappop(heap)
            at = entry & mask
            right = after[at]
            if ids[at] < 0 or right >= end:
                continue
            found = pairs.get(ids[at] << _WIDE | ids[right])
            if not found or found[0] != entry >> shift:
                continue
            ids[at], ids[right] = found[1], -1
            count -= 1
            right = after[at] = after[right]
            if right < end:
                before[right] = at
                found = pairs.get(ids[at] << _WIDE | ids[right])
                if found:
                    heapq.heappush(heap, found[0] << shift | at)
            left = before[at]
            if left >= 0:
                found = pairs.get(ids[left] << _WIDE | ids[at])
                if found:
                    heapq.heappush(heap, found[0] << shift | left)
        return count

    def _plain(self, text: str) -> int:
        if not text.isascii():
            # The library lowers character by character; Python has one rule that looks at a word's end.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        # Words never hold white space, so stretches between blanks can be counted apart. Four control
        # characters part stretches for Python alone; texts with them are cut at the blank only.
        stretches = text.split(" ") if _CONTROL.search(text) else text.split()
        return sum(map(self.stretches.__getitem__, stretches))

    def count(self, text: str) -> int:
        if not text.isascii() and _young().search(text):
            return len(_library(self.path).encode(text, add_special_tokens=False).ids)
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        return sum(map(self._plain, self.added.split(text))) + len(self.added.findall(text))


_CONTROL = re.compile("[\x1c-\x1f]")


# Fixed value: the first character after the planes whose tables of letters and of lower case all versions of Unicode in use share.
_SETTLED = "\u0250"
_SCRIPTS = (("\u0370", "\u052f"), ("\u0591", "\u06ff"), ("\u0900", "\u0dff"), ("\u0e00", "\u0eff"), ("\u1e00", "\u1fff"), ("\u2000", "\u206f"),
            ("\u20a0", "\u20bf"), ("\u2100", "\u23ff"), ("\u2500", "\u27bf"), ("\u3000", "\u30ff"), ("\u3400", "\u4dbf"), ("\u4e00", "\u9fff"),
            ("\uac00", "\ud7a3"), ("\uff00", "\uffef"), ("\U0001f300", "\U0001f64f"), ("\U0001f680", "\U0001f6ff"), ("\U0001f900", "\U0001f9ff"))


@cache
def _young() -> re.Pattern:
    """Characters whose class may depend on the version of Unicode, so that two libraries can differ on them: those outside the scripts
    of _SCRIPTS, and those in them that this Python does not know. Texts with one of them are rare; they go to the library."""
    ranges, first = [], None
    known = [(0, ord(_SETTLED) - 1), *((ord(a), ord(b)) for a, b in _SCRIPTS)]
    for low, high in known:
        for code in range(low, high + 2):
            odd = code <= high and unicodedata.category(chr(code)) == "Cn"
            if odd and first is None:
                first = code
            elif not odd and first is not None:
                ranges.append((first, code - 1))
                first = None
    ends = [*known, (0x110000, 0x110000)]
    ranges += [(a[1] + 1, b[0] - 1) for a, b in zip(ends, ends[1:]) if b[0] > a[1] + 1]
    return re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges) + "]")


@cache
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id as given, n_bytes (UTF-8) and n_tokens of the whole text; null counts as empty (0, 0).

    ``vocabulary`` is the path of the file on every worker. Special strings of the vocabulary inside a text are one
    token each, as the library has it. Other columns of ``docs`` are not looked at.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary).count
        for batch in batches:
            counts = [count(x) for part in shared.strings(batch.column(1)) for x in part]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), _sizes(batch.column(1))], schema=sized)

    sized = schema.append(pa.field("n_bytes", pa.int64()))
    counted = given.mapInArrow(run, "id long, n_tokens long, n_bytes long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def _sizes(column: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.binary_length(column.fill_null("")).cast(pa.int64())
