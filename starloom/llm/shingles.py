"""Word shingles of whole texts as 64-bit numbers, and their compressed HyperMinHash registers (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

REGISTERS = 256  # one per value of a hash's leading byte
BAND_ROWS = 6
BANDS = REGISTERS // BAND_ROWS
MANTISSA_BITS = 10
PROBES = 48
RUN_SETS, RUN_HASHES = 4096, 1 << 18  # sets whose registers are filled at once, and the hashes they may have
# Two different minima share a register value about this often: half the leading
# ones agree and then ten mantissa bits (the sum over leading-zero counts of 4^-(z+1) / 2^10).
COLLISION = (1 / 3) / 2**MANTISSA_BITS

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + 1
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """The numbers well scattered over 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_table(base: int, size: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < size:
        have = np.full(max(size, 1 << 20), base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have, dtype=np.uint64)
    return have


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts that lie one behind the other in ``data`` (UTF-8, A-Z folded), and
    how many words begin before each text's end. ``ends`` are the texts' ends, rising to len(data)."""
    size = len(data)
    if not size:
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64)
    solid = ~_SPACE[data]
    cut = np.zeros(size + 1, dtype=bool)
    cut[0] = True
    cut[ends] = True
    first = solid & cut[:-1]
    first[1:] |= solid[1:] & ~solid[:-1]
    last = solid & cut[1:]
    last[:-1] |= solid[:-1] & ~solid[1:]
    begin, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(_LOWER[data] * _power_table(_BASE, size)[:size], out=sums[1:])
    words = (sums[stop] - sums[begin]) * _power_table(_INVERSE, size)[begin]
    words = mixed(words + (stop - begin).astype(np.uint64) * _STEP)
    return words, np.searchsorted(begin, ends)


def shingle_sets(data: np.ndarray, ends: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles; a shorter text is one shingle, one without words none."""
    words, upto = word_hashes(data, ends)
    rolled = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for k in range(size):
        rolled = rolled * _STEP + words[k : k + len(rolled)]
    rolled = mixed(rolled)
    sets, start = [], 0
    for stop in upto.tolist():
        count = stop - start
        if count >= size:
            sets.append(np.unique(rolled[start : stop - size + 1]))
        elif count:
            whole = np.uint64(count)
            with np.errstate(over="ignore"):
                for word in words[start:stop]:
                    whole = whole * _STEP + word
            sets.append(mixed(np.array([whole], dtype=np.uint64)))
        else:
            sets.append(np.empty(0, np.uint64))
        start = stop
    return sets


def _probe_table() -> np.ndarray:
    grid = np.arange(1, PROBES + 1, dtype=np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(REGISTERS, dtype=np.uint64)
    return (mixed(grid) % np.uint64(REGISTERS)).astype(np.int64)


_PROBE = _probe_table()


def _fill(table: np.ndarray, sets: list[np.ndarray], sizes: np.ndarray) -> None:
    """Write the registers that the sets fill themselves. The sets are sorted, so the smallest hash of a register is the first with its leading byte."""
    hashes = np.concatenate(sets) if len(sets) > 1 else sets[0]
    if not len(hashes):
        return
    lead = (hashes >> np.uint64(56)).astype(np.uint8)
    ends = np.cumsum(sizes)
    first = np.ones(len(hashes), dtype=bool)
    np.not_equal(lead[1:], lead[:-1], out=first[1:])
    first[ends[ends < len(hashes)]] = True
    at = np.flatnonzero(first)
    part, power = np.frexp(((hashes[at] << np.uint64(8)) >> np.uint64(11)).astype(np.float64))
    zeros = np.minimum(53 - power, 62)
    mantissa = ((part * 2 - 1) * (1 << MANTISSA_BITS)).clip(0).astype(np.int64)
    table[np.searchsorted(ends, at, side="right"), lead[at]] = (zeros + 1 << MANTISSA_BITS) | mantissa


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers per set: leading zeros and mantissa of the smallest hash in each bucket.

    A bucket that a small set leaves empty borrows another's register, at places that are the same for
    all sets, so any register of two sets agrees with the probability of their similarity. 0: the set is empty.
    """
    table = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    first = 0
    while first < len(sets):  # runs of sets, one at least
        stop = max(first + 1, int(np.searchsorted(np.cumsum(sizes[first : first + RUN_SETS]), RUN_HASHES, side="right")) + first)
        _fill(table[first:stop], sets[first:stop], sizes[first:stop])
        first = stop
    own = table.copy()
    row, col = np.nonzero((own == 0) & (own != 0).any(axis=1)[:, None])
    for probe in _PROBE:
        if not len(row):
            break
        got = own[row, probe[col]]
        table[row, col] = got
        row, col = row[got == 0], col[got == 0]
    for k in np.unique(row):  # very few filled buckets: the next filled one to the right, around the end
        filled = np.flatnonzero(own[k])
        near = filled[np.searchsorted(filled, np.arange(REGISTERS)) % len(filled)]
        table[k] = np.where(table[k] == 0, own[k][near], table[k])
    return table


def band_keys(table: np.ndarray) -> np.ndarray:
    """One signed 64-bit key per row and band of registers."""
    used = table[:, : BANDS * BAND_ROWS].reshape(len(table), BANDS, BAND_ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(table), BANDS)).copy()
    for k in range(BAND_ROWS):
        keys = keys * _STEP + used[:, :, k]
    return mixed(keys).view(np.int64)


def estimated_jaccard(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal registers per row, less the share that chance makes equal."""
    same = (a == b).mean(axis=1)
    return (same - COLLISION) / (1 - COLLISION)
