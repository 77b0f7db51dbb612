"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

A stretch of n characters that is found again with at most e edits shares n - q + 1 - q * e of its q-grams, and all of
them lie on diagonals (place in the document less place in the item) at most e apart. Shared q-grams are counted in
bins of diagonals; two neighbouring bins are a band, and bands overlap by a bin. Bands that reach the bound are
verified by an alignment that stays in the band: of the whole item, else of every PASSAGE characters of it that share enough q-grams. Items are held against documents in blocks of bounded size.

Items too short for the lemma are looked for letter for letter between word borders, by the hash of all of them.

Texts are compared with ASCII and Latin-1 letters folded to lower case, and runs of other ASCII characters as one blank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import shared
from starloom.llm.shingles import mixed

Q = 10
EDITS = 0.05  # edits per character of a passage
PASSAGE = 120  # characters of an item that must be found again, or all of a shorter item, unless told otherwise
LEAST = 24  # shorter items must be found letter for letter, as whole words
BIN = 8  # diagonals per bin, a power of two and more than the edits of a passage
BLOCK_BYTES = 8 << 20  # benchmark text held against the documents at a time
MOST_STARTS = 1 << 17  # words at which short items are looked for at a time
MOST_HITS = 1_000_000  # places in items that are counted at a time
STRETCH = 1 << 20  # characters whose q-grams are looked up at a time
MOST_CELLS = 1 << 18  # windows times diagonals that are aligned at a time
_MAP_BITS = 22

_BASE = 0xB5297A4D3F84D5B5
_KEEP = np.zeros(256, dtype=bool)
_KEEP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def folded(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes of texts that lie one behind the other, where each came from, and the texts' new ends."""
    keep = _KEEP[data]
    use = keep.copy()
    use[1:] |= keep[:-1]
    cut = ends[:-1][ends[:-1] < len(data)]
    use[cut] = keep[cut]  # no blank at a text's beginning
    at = np.flatnonzero(use)
    kept = data[at]
    out = np.where(keep[at], _LOWER[kept], np.uint8(32))
    lead = (at > 0) & (data[np.maximum(at - 1, 0)] == 0xC3)
    out = np.where(lead & (kept >= 0x80) & (kept <= 0x9E) & (kept != 0x97), kept + 0x20, out).astype(np.uint8)
    return out, at, np.searchsorted(at, ends)


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the q-gram that begins at each place; the last q - 1 places have none."""
    n = len(text) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    value = np.zeros(n, dtype=np.uint64)
    for k in range(Q):
        value *= np.uint64(_BASE)
        value += text[k : k + n]
    return mixed(value)


@dataclass(frozen=True)
class ShortItems:
    """Items of one length under LEAST, folded, in the order of their hashes."""

    hashes: np.ndarray
    letters: np.ndarray  # a row each
    ids: np.ndarray


@dataclass(frozen=True)
class Items:
    """A block of benchmark items, folded, with their q-grams in the order of their hashes."""

    ids: np.ndarray
    texts: list[bytes]
    least: np.ndarray  # shared q-grams that a band must have
    hashes: np.ndarray  # distinct, rising
    begin: np.ndarray  # occurrences of hash i are at begin[i]:begin[i + 1] of the next two
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray  # by the leading bits of a hash: whether any item has it
    longest: int
    passage: int
    short: list[ShortItems]


def _row_hashes(letters: np.ndarray) -> np.ndarray:
    """Hash of each row of letters."""
    value = np.zeros(len(letters), dtype=np.uint64)
    for column in letters.T:
        value *= np.uint64(_BASE)
        value += column
    return mixed(value)


def _short_items(short: list[tuple[int, bytes]]) -> list[ShortItems]:
    result = []
    for size in sorted({len(text) for _, text in short}):
        own = [(i, text) for i, text in short if len(text) == size]
        letters = np.frombuffer(b"".join(text for _, text in own), np.uint8).reshape(-1, size)
        hashes = _row_hashes(letters)
        order = np.argsort(hashes, kind="stable")
        result.append(ShortItems(hashes[order], letters[order], np.array([i for i, _ in own], dtype=np.int64)[order]))
    return result


def indexed(rows: list[tuple[int, str]], passage: int = PASSAGE) -> Items | None:
    ids, texts, hashes, item, place, least, short = [], [], [], [], [], [], []
    for item_id, text in rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        out = folded(data, np.array([len(data)]))[0].tobytes().strip() if len(data) else b""
        if len(out) < LEAST:
            short += [(item_id, out)] if out else []
            continue
        own = gram_hashes(np.frombuffer(out, np.uint8))
        n = min(len(out), passage)
        least.append(max(1, n - Q + 1 - Q * int(EDITS * n)))
        hashes.append(own)
        item.append(np.full(len(own), len(ids)))
        place.append(np.arange(len(own)))
        ids.append(item_id)
        texts.append(out)
    if not ids and not short:
        return None
    none = np.empty(0, np.int64)
    every, at, item = np.concatenate([np.empty(0, np.uint64), *hashes]), np.concatenate([none, *place]), [none, *item]
    order = np.argsort(every, kind="stable")
    distinct, begin = np.unique(every[order], return_index=True)
    seen = np.zeros(1 << _MAP_BITS, dtype=bool)
    seen[(distinct >> np.uint64(64 - _MAP_BITS)).astype(np.int64)] = True
    return Items(
        np.array(ids, dtype=np.int64), texts, np.array(least), distinct, np.append(begin, len(every)), np.concatenate(item)[order], at[order],
        seen, max(map(len, texts), default=0), passage, _short_items(short),
    )


def _hits(items: Items, text: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document, place in the text and hash number of q-grams that items have too, in the order of their places, so that at most about
    MOST_HITS places in items go with what is given at a time."""
    for first in range(0, len(text), STRETCH):
        grams = gram_hashes(text[first : first + STRETCH + Q - 1])
        maybe = np.flatnonzero(items.seen[(grams >> np.uint64(64 - _MAP_BITS)).astype(np.int64)])
        rank = np.searchsorted(items.hashes, grams[maybe])
        rank[rank == len(items.hashes)] = 0
        same = items.hashes[rank] == grams[maybe]
        place, rank = maybe[same] + first, rank[same]
        doc = np.searchsorted(ends, place, side="right")
        inside = place + Q <= ends[doc]
        place, rank, doc = place[inside], rank[inside], doc[inside]
        part = np.cumsum(items.begin[rank + 1] - items.begin[rank]) // MOST_HITS
        for some in np.split(np.arange(len(place)), np.flatnonzero(np.diff(part)) + 1):
            if len(some):
                yield doc[some], place[some], rank[some]


def _short_hits(items: Items, text: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Document, place in the text and id of the short items of a length that stand there as whole words, and that length."""
    blank = text == 32
    first = ~blank
    first[1:] &= blank[:-1]
    begins = np.concatenate([[0], ends[:-1]])
    begins = begins[begins < ends]
    first[begins] = ~blank[begins]
    every = np.flatnonzero(first)
    for some in range(0, len(every), MOST_STARTS):
        start = every[some : some + MOST_STARTS]
        doc = np.searchsorted(ends, start, side="right")
        for short in items.short:
            size = short.letters.shape[1]
            stop = start + size
            whole = (stop == ends[doc]) | ((stop < ends[doc]) & blank[np.minimum(stop, len(text) - 1)])
            at, of = start[whole], doc[whole]
            letters = text[at[:, None] + np.arange(size)]
            hashes = _row_hashes(letters)
            begin = np.searchsorted(short.hashes, hashes, side="left")
            count = np.searchsorted(short.hashes, hashes, side="right") - begin
            part = np.cumsum(count) // MOST_STARTS
            for rows in np.split(np.arange(len(at)), np.flatnonzero(np.diff(part)) + 1):
                hit = np.repeat(rows, count[rows])
                which = np.arange(len(hit)) - np.repeat(np.cumsum(count[rows]) - count[rows], count[rows]) + begin[hit]
                same = (letters[hit] == short.letters[which]).all(axis=1)
                if same.any():
                    yield of[hit[same]], at[hit[same]], short.ids[which[same]], size


def _bands(items: Items, text: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Document, item, lowest and highest diagonal of the bands that reach the bound.

    Shared q-grams come in the order of their places. A diagonal that lies further back than the longest item gets no more of them,
    so its bins are judged and forgotten: what is held at a time does not grow with a text.
    """
    begins = np.concatenate([[0], ends])
    shift = -(-items.longest // BIN) * BIN
    room = (np.diff(begins) + shift) // BIN + 3
    base = np.cumsum(room) - room
    number = len(items.ids)
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    found: dict[tuple[int, int], list[list[int]]] = {}

    def judge(limit: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Take up the bands whose two bins lie before line ``limit``; what is left is not complete."""
        after = np.searchsorted(keys, keys + number)
        after[after == len(keys)] = 0
        both = counts + np.where(keys[after] == keys + number, counts[after], 0) if len(keys) else counts
        good = both >= items.least[keys % number]
        stay = keys >= (limit - 1) * number if limit is not None else np.zeros(len(keys), dtype=bool)
        take = keys[good & ~stay]
        line, item = take // number, take % number
        order = np.lexsort((line, item))
        line, item = line[order], item[order]
        doc = np.searchsorted(base, line, side="right") - 1
        low = (line - base[doc]) * BIN - shift
        new = np.ones(len(order), dtype=bool)
        new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (low[1:] > low[:-1] + 2 * BIN)
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(order)) - 1
        for d, i, a, b in zip(doc[at].tolist(), item[at].tolist(), low[at].tolist(), (low[last] + 2 * BIN - 1).tolist() if len(at) else [], strict=True):
            mine = found.setdefault((d, i), [])
            if mine and a <= mine[-1][1] + 1:
                mine[-1][1] = b
            else:
                mine.append([a, b])
        return keys[stay], counts[stay]

    for doc, place, rank in _hits(items, text, ends):
        if len(keys):  # no line before this one gets more
            keys, counts = judge(int(base[doc[0]] + (place[0] - begins[doc[0]] - items.longest + shift) // BIN))
        count = items.begin[rank + 1] - items.begin[rank]
        hit = np.repeat(np.arange(len(place)), count)
        at = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count) + items.begin[rank][hit]
        bins = (place[hit] - begins[doc[hit]] - items.place[at] + shift) // BIN
        more, times = np.unique((base[doc[hit]] + bins) * number + items.item[at], return_counts=True)
        every = np.concatenate([keys, more])
        keys, where = np.unique(every, return_inverse=True)
        counts = np.bincount(where, weights=np.concatenate([counts, times]), minlength=len(keys)).astype(np.int64)
    keys, counts = judge(None)
    return [(d, i, a, b) for (d, i), mine in sorted(found.items()) for a, b in mine]


def aligned_end(pattern: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int]:
    """Fewest edits that turn the whole pattern into a stretch of the text on diagonals low..high, and where it ends."""
    width = high - low + 1
    lanes = np.arange(width)
    cost = np.where((low + lanes >= 0) & (low + lanes <= len(text)), 0, len(pattern) + 1)
    padded = np.concatenate([text.astype(np.int16), np.full(width + 1, -1, np.int16)])
    for i, letter in enumerate(pattern.tolist()):
        column = i + low + lanes  # place in the text that is matched with letter i, by diagonal
        valid = (column >= 0) & (column < len(text))
        step = cost + np.where(valid & (padded[np.clip(column, 0, len(text))] == letter), 0, 1)
        step = np.where(valid, step, len(pattern) + 1)
        skip = np.append(cost[1:] + 1, len(pattern) + 1)  # the letter is missing in the text
        best = np.minimum(step, skip)
        cost = np.minimum.accumulate(best - lanes) + lanes  # letters that the text has besides
    lane = int(np.argmin(cost))
    return int(cost[lane]), min(len(text), max(0, len(pattern) + low + lane))


def _aligned(pattern: bytes, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Edits, start and end of the best stretch of the text for the pattern."""
    letters = np.frombuffer(pattern, np.uint8)
    edits, end = aligned_end(letters, text, low, high)
    if edits > EDITS * len(pattern):
        return edits, 0, 0
    begin = max(0, end - len(pattern) - edits)
    part = text[begin:end][::-1]
    back, length = aligned_end(letters[::-1], part, -edits, edits + 1)
    return edits, end - min(length, len(part)), end


def _aligned_ends(patterns: np.ndarray, text: np.ndarray, low: np.ndarray, width: int, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """aligned_end for patterns of equal length, a row each, on ``width`` diagonals from low and within first..last of the text."""
    lanes = np.arange(width)
    first, last = first[:, None], last[:, None]
    place = low[:, None] + lanes
    most = patterns.shape[1] + 1
    cost = np.where((place >= first) & (place <= last), 0, most)
    beyond = np.full((len(patterns), 1), most)
    for letters in patterns.T:
        valid = (place >= first) & (place < last)
        step = np.where(valid, cost + (text[np.clip(place, 0, len(text) - 1)] != letters[:, None]), most)
        skip = np.append(cost[:, 1:] + 1, beyond, axis=1)
        cost = np.minimum.accumulate(np.minimum(step, skip) - lanes, axis=1) + lanes
        place = place + 1
    lane = np.argmin(cost, axis=1)
    row = np.arange(len(patterns))
    return cost[row, lane], np.clip(place[row, lane], first[:, 0], last[:, 0])


def _windows(pattern: bytes, text: np.ndarray, low: int, high: int, passage: int) -> Iterator[tuple[int, int, int, int]]:
    """Every ``passage`` characters of a longer item that are found on diagonals low..high: where they begin in the item, edits, start and end in the text."""
    letters = np.frombuffer(pattern, np.uint8)
    most = int(EDITS * passage)
    # Only windows that share enough q-grams with the text can be found.
    shared_grams = np.concatenate([[0], np.cumsum(np.isin(gram_hashes(letters), gram_hashes(text)))])
    grams = passage - Q + 1
    starts = np.flatnonzero(shared_grams[grams:] - shared_grams[:-grams] >= max(1, grams - Q * most))
    every, width = np.lib.stride_tricks.sliding_window_view(letters, passage), high - low + 1
    # A window that is there letter for letter needs no alignment.
    whole, found, other = text.tobytes(), [], []
    for at in starts.tolist():
        place = whole.find(pattern[at : at + passage], max(0, at + low), max(0, at + high + passage))
        if place >= 0:
            found.append((at, 0, place, place + passage))
        else:
            other.append(at)
    starts = np.array(other, dtype=np.int64)
    rows = max(1, MOST_CELLS // width)
    for k in range(0, len(starts), rows):
        at = starts[k : k + rows]
        zero = np.zeros(len(at), dtype=np.int64)
        edits, end = _aligned_ends(every[at], text, at + low, width, zero, zero + len(text))
        good = edits <= most
        at, edits, end = at[good], edits[good], end[good]
        if not len(at):
            continue
        # Backwards from where it ends, a window shows where it begins.
        head = len(text) - end
        back = _aligned_ends(every[at][:, ::-1], text[::-1], head - most, 2 * most + 2, head, np.minimum(head + passage + edits, len(text)))[1]
        found += zip(at.tolist(), edits.tolist(), (len(text) - back).tolist(), end.tolist(), strict=True)
    yield from sorted(found)


def verified(items: Items, text: np.ndarray, item: int, low: int, high: int) -> list[tuple[int, int, int, int]]:
    """Passages of an item in one folded document, in a band: start, end, edits, characters of the item."""
    pattern, passage = items.texts[item], items.passage
    slack = int(EDITS * len(pattern)) + 1
    begin = max(0, low - slack)
    part = text[begin : max(0, high + len(pattern) + slack + 1)]
    exact = part.tobytes().find(pattern)
    if exact >= 0:
        return [(begin + exact, begin + exact + len(pattern), 0, len(pattern))]
    edits, a, b = _aligned(pattern, part, low - begin - slack, high - begin + slack)
    if b > a:
        return [(begin + a, begin + b, edits, len(pattern))]
    found: list[tuple[int, int, int, int]] = []
    last = 0  # where the item's characters end that are found so far
    for at, edits, a, b in _windows(pattern, part, low - begin - BIN, high - begin + BIN, passage) if len(pattern) > passage else ():
        if found and begin + a <= found[-1][1]:
            s, e, n, m = found[-1]
            found[-1] = (min(s, begin + a), max(e, begin + b), max(n, edits), m + at + passage - max(at, last))
        else:
            found.append((begin + a, begin + b, edits, passage))
        last = at + passage
    return found


_ROW = pa.schema([("id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64()), ("passage_chars", pa.int64()), ("item_chars", pa.int64())])


def _search(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, ends in shared.texts(batch.column(1)):
                if not len(data):
                    continue
                text, origin, stops = folded(data, ends)
                if items.short and len(text):
                    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])  # code points before each byte
                    heads = np.concatenate([[0], ends[:-1]])
                    for docs, places, ids, size in _short_hits(items, text, stops):
                        head = letters[heads[docs]]
                        begins, stands = letters[origin[places]] - head, letters[origin[places + size - 1] + 1] - head
                        same = np.full(len(docs), size)
                        columns = [begins, stands, np.zeros(len(docs), np.int64), same, same]
                        own = batch.column(0).take(pa.array(first + docs))
                        yield pa.RecordBatch.from_arrays([own, pa.array(ids), *[pa.array(c, pa.int64()) for c in columns]], schema=_ROW)
                rows = []
                for doc, item, low, high in _bands(items, text, stops) if items.texts else ():
                    begin = int(stops[doc - 1]) if doc else 0
                    head = int(ends[doc - 1]) if doc else 0
                    for a, b, edits, size in verified(items, text[begin : stops[doc]], item, low, high):
                        lead = data[head : origin[begin + b - 1] + 1]
                        letters = (lead & 0xC0) != 0x80
                        begins = int(np.count_nonzero(letters[: origin[begin + a] - head]))
                        rows.append((batch.column(0)[first + doc].as_py(), int(items.ids[item]), begins, int(np.count_nonzero(letters)), edits, size, len(items.texts[item])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*sorted(set(rows), key=repr), strict=True)], schema=_ROW)

    return run


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    passage: int = PASSAGE,
) -> DataFrame:
    """One row per benchmark passage found: id, item_id, start and end in the text (code points, end exclusive), edits,
    passage_chars and item_chars (folded). A passage is a whole item, or ``passage`` characters of a longer one and what joins them, with at most EDITS
    edits per character; an item of fewer than LEAST folded characters must stand in the text letter for letter, as whole words, and gives a
    row for each place, so a benchmark of single common words gives many.

    All of every text and every item is looked at. Null and empty texts and items without a letter or digit give nothing; items of equal
    text are all reported; rows that repeat are reported each. Other columns are not looked at.
    """
    if passage < LEAST or int(EDITS * passage) >= BIN:
        raise ValueError(f"passage must be {LEAST} to {int(BIN / EDITS) - 1} characters")
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("item_id is not null and text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    result = spark.createDataFrame([], "id long, item_id long, start long, end long, edits long, passage_chars long, item_chars long")
    for block in range(blocks):  # each block has a bounded size and is held against all documents
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        index = indexed(sorted((r.item_id, r.text) for r in mine), passage)
        if index is not None:
            result = result.union(given.mapInArrow(_search(index), result.schema.simpleString()[7:-1].replace(":", " ")))
    return result.withColumnRenamed("id", id_col)
