"""Fill-in-the-middle texts by content-defined chunk memoization.

A rolling hash over the last WINDOW bytes cuts every text into chunks where the content says so, so texts that share passages
share most of their chunks, wherever the passages lie. Of a chunk only a boundary summary is needed: its code points, the
words that end inside it, and whether it begins and ends within a word. Summaries are kept by content, in a cache of bounded
size in each worker: a chunk met again is told by its whole bytes, never by its hash alone. Summaries of neighbours combine
to the units of the document, and running counts name the one chunk that holds a cut; only that chunk is looked at again.

A unit is a word with the white space before it; white space that ends a text is a unit of its own. White space is U+0020 and
U+0009 to U+000D.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm import shared

WINDOW = 32  # bytes the rolling hash looks back
LEAST, MOST = 128, 4096  # bytes of a chunk; the last of a text may be shorter
RARE_BITS = 9  # a chunk ends where so many bits of the hash are zero: every 512 bytes or so beyond LEAST
BLOCK = 1 << 20  # bytes hashed at a time
KEPT_BYTES = 16 << 20  # chunks whose summaries a worker keeps

# Fixed values of the output form.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_DRAWN = np.random.default_rng(42).integers(0, 1 << 32, 256, dtype=np.uint32)
_WORD_END = re.compile(rb"[^\x20\x09-\x0d](?=[\x20\x09-\x0d])")
_BLANKS = b" \t\n\x0b\x0c\r"


class Summary(NamedTuple):
    chars: int
    ends: int  # words that end before the chunk's last byte
    starts_within: bool  # its first byte belongs to a word
    stops_within: bool  # its last byte belongs to a word


class Chunks:
    """Summaries by content; all are forgotten when the chunks kept outgrow ``most`` bytes."""

    def __init__(self, most: int = KEPT_BYTES):
        self.most, self.held, self.known = most, 0, {}

    def summary(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is None:
            within = chunk[-1] not in _BLANKS
            found = Summary(_chars(chunk), len(chunk.split()) - within, chunk[0] not in _BLANKS, within)
            if self.held > self.most:
                self.known, self.held = {}, 0
            self.known[chunk] = found
            self.held += len(chunk)
        return found


@cache
def _worker_chunks() -> Chunks:
    return Chunks()


def _chars(data: bytes) -> int:
    return len(data) if data.isascii() else len(data.decode("utf-8", "replace"))


def breaks(data: np.ndarray) -> np.ndarray:
    """Places before which the content asks for a cut: the hash of the WINDOW bytes before them is rare, and a character begins there."""
    found = []
    for first in range(0, len(data), BLOCK):
        back = max(0, first - WINDOW + 1)
        part = _DRAWN[data[back : first + BLOCK]]
        step = 1
        while step < WINDOW:  # twice the window each time; what is older leaves the 32 bits
            later = part.copy()
            later[step:] += part[:-step] << np.uint32(step)
            part, step = later, 2 * step
        found.append(np.flatnonzero(part[first - back :] >> np.uint32(32 - RARE_BITS) == 0) + first + 1)
    places = np.concatenate(found) if found else np.empty(0, np.int64)
    places = places[places < len(data)]
    return places[(data[places] & 0xC0) != 0x80]


def chunked(data: bytes, first: int, stop: int, places: list[int]) -> Iterator[bytes]:
    """The chunks of one text that lies at first to stop in ``data``; no chunk of one depends on the bytes before the text."""
    at, k = first, bisect_left(places, first)
    while at < stop:
        k = bisect_left(places, at + LEAST, k)
        end = min(places[k] if k < len(places) else stop, at + MOST, stop)
        while end < stop and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


class Units:
    """A text's units from the summaries of its chunks."""

    def __init__(self, chunks: Iterator[bytes], kept: Chunks):
        self.chunks, self.bytes_before, self.chars_before, self.ends = list(chunks), [], [], []
        self.between = []  # whether a word ends right before the chunk
        size = chars = ends = 0
        within = False
        for chunk in self.chunks:
            s = kept.summary(chunk)
            between = within and not s.starts_within
            self.bytes_before.append(size)
            self.chars_before.append(chars)
            self.between.append(between)
            size, chars, ends = size + len(chunk), chars + s.chars, ends + between + s.ends
            self.ends.append(ends)  # words that ended so far
            within = s.stops_within
        self.size, self.chars = size, chars
        self.n = ends + (size > 0)  # the last word, or the white space after it

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` units."""
        if units == 0:
            return 0, 0
        if units == self.n:
            return self.size, self.chars
        k = bisect_left(self.ends, units)
        place = units - (self.ends[k - 1] if k else 0) - self.between[k]  # which of the chunk's own word ends, from 1
        if place == 0:
            return self.bytes_before[k], self.chars_before[k]
        for found in _WORD_END.finditer(self.chunks[k]):
            place -= 1
            if place == 0:
                return self.bytes_before[k] + found.end(), self.chars_before[k] + _chars(self.chunks[k][: found.end()])
        raise RuntimeError("a chunk has fewer word ends than its summary says")


def _transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kept = _worker_chunks()
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for batch in batches:
        for first, stop, held, ends in shared.texts(batch.column(1)):
            data, places = held.tobytes(), breaks(held).tolist()
            draws = [batch.column(k).slice(first, stop - first).to_pylist() for k in (2, 3)]
            forms = batch.column(4).slice(first, stop - first)
            counts, prefixes, middles, outputs = [], [], [], []
            at = 0
            for end, one, two, form in zip(ends.tolist(), *draws, forms.to_pylist(), strict=True):
                units = Units(chunked(data, at, end, places), kept)
                counts.append(units.n)
                if form == "plain":
                    prefixes.append(None)
                    middles.append(None)
                    outputs.append(data[at:end])
                else:
                    low, high = sorted((one % (units.n + 1), two % (units.n + 1)))
                    (a, before), (b, upto) = units.cut(low), units.cut(high)
                    prefixes.append(before)
                    middles.append(upto - before)
                    left, middle, right = data[at : at + a], data[at + a : at + b], data[at + b : end]
                    outputs.append(b"".join((p, left, s, right, m, middle) if form == "psm" else (s, right, p, left, m, middle)))
                at = end
            made = [pa.array(counts, pa.int64()), forms, pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, stop - first), *made, pa.array(outputs, pa.binary()).cast(pa.string())], names=names)


def infilled(
    docs: DataFrame, seed: str = "42:", percent: int = 50, spm_percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output (the new text).

    What happens to a text follows from the SHA-256 of ``seed`` and its id alone: where the cuts lie, whether it is one of the
    ``percent`` that are transformed, and whether of the ``spm_percent`` whose suffix comes first. Empty and null texts (both
    empty), and texts that hold a sentinel, stay plain; their lengths are null. A null id is drawn for as an empty one. Rows that
    repeat are transformed each, alike. Other columns are not looked at; an empty table gives no rows.
    """
    hashed = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    drawn = [F.conv(F.substring(hashed, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    holds = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | holds | (drawn[2] % 100 >= percent)
    form = F.when(plain, "plain").when(drawn[3] % 100 < spm_percent, "spm").otherwise("psm")
    given = docs.select(F.col(id_col).alias("id"), text.alias("text"), drawn[0].alias("one"), drawn[1].alias("two"), form.alias("form"))
    kind = docs.schema[id_col].dataType.simpleString()
    made = given.mapInArrow(_transformed, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. Sentinels are in no transformed text, nor can a cut make one up."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
