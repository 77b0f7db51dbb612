"""Bin completion by branch and bound, over counts of lengths.

The search looks at lengths and how many pieces have each, never at single pieces, so its work does not grow with them. A step
takes the largest length left, completes a bin around it, and repeats that bin as often as its lengths last. Completions that
another one dominates are never tried: one that could swap some of its lengths, or none, for a single larger one that still
fits. Least waste comes first. The waste a better solution may have is known from the total, so branches that waste more are cut,
by what is lost so far and by a bound on what the rest must lose. Best-fit decreasing packs the rest at the root and again below it;
the best such solution is the incumbent. Sets of lengths are the bits of whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

NODES = 2500  # steps of the search; the incumbent stands when they are used up
LOOKS = 200  # lengths that the listing of fillings may add, for each step
TRIED = 24  # steps between attempts to pack the rest by best fit

Bin = tuple[int, ...]


@dataclass(frozen=True)
class Solution:
    bins: int
    patterns: list[tuple[int, Bin]]  # how many bins hold which lengths
    bound: int  # no packing has fewer bins


@dataclass
class Effort:
    """What the listing of fillings may still do; without a limit all."""

    left: int | None

    def spent(self) -> bool:
        if self.left is None:
            return False
        self.left -= 1
        return self.left < 0


def best_fit(counts: np.ndarray, size: int) -> list[tuple[int, Bin]]:
    """Best-fit decreasing: every length in turn goes to the fullest bins that take it, alike bins together."""
    open_bins: dict[int, list[tuple[int, Bin]]] = {}  # by room
    for length in range(size, 0, -1):
        left = int(counts[length])
        if not left:
            continue
        for room in sorted(r for r in open_bins if r >= length):
            groups, open_bins[room] = open_bins[room], []
            each = room // length
            for n, held in groups:
                full = min(n, left // each)
                left -= full * each
                some = min(left, each - 1) if full < n else 0
                left -= some
                for number, taken in ((full, each), (1 if some else 0, some), (n - full - (1 if some else 0), 0)):
                    if number:
                        open_bins.setdefault(room - taken * length, []).append((number, held + (length,) * taken))
        each = size // length
        for number, taken in ((left // each, each), (1 if left % each else 0, left % each)):
            if number:
                open_bins.setdefault(size - taken * length, []).append((number, (length,) * taken))
    return [group for groups in open_bins.values() for group in groups]


def lower_bound(counts: np.ndarray, size: int) -> int:
    """Bins that any packing needs: by the total, and by lengths too large to lie together, less the room they leave to middling ones."""
    lengths = np.arange(size + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * lengths)
    k = np.arange(size // 2 + 1)  # lengths under k are left out of account
    alone = number[size] - number[size - k]  # longer than size - k
    apart = number[size - k] - number[size // 2]  # longer than half
    below = np.where(k > 0, total[np.maximum(k - 1, 0)], 0)
    middling = total[size // 2] - below
    room = apart * size - (total[size - k] - total[size // 2])
    return int((alone + apart + np.maximum(0, -((room - middling) // size))).max(initial=0))


def _reach(counts: np.ndarray, lengths: list[int], room: int) -> list[int]:
    """Sums up to ``room`` that the first lengths, ever more of them, can make."""
    mask, sums, found = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        left, step = min(int(counts[length]), room // length), 1
        while left:
            step = min(step, left)
            sums |= sums << (length * step) & mask
            left, step = left - step, 2 * step
        found.append(sums)
    return found


def _spread(sums: int, by: int) -> int:
    """The sums and all up to ``by`` above them."""
    done = 0
    while done < by:
        step = min(done + 1, by - done)
        sums |= sums << step
        done += step
    return sums


def _spread_down(sums: int, by: int) -> int:
    """The sums and all up to ``by`` below them."""
    done = 0
    while done < by:
        step = min(done + 1, by - done)
        sums |= sums >> step
        done += step
    return sums


def dominated(filling: Bin, left: int, slack: int) -> bool:
    """Whether a length of ``left`` (bits) could take the place of some of the filling's, or of none, and waste less or hold fewer."""
    singles = some = several = 0
    for length in filling:
        several |= some << length | several << length
        some |= some << length | 1 << length
        singles |= 1 << length
    larger = _spread(singles | 1, slack - 1) << 1 if slack else 0
    return bool((_spread(several, slack) | larger) & left & ~1)


def fillings(counts: np.ndarray, room: int, slack: int, effort: Effort | None = None) -> Iterator[tuple[int, Bin]]:
    """(waste, lengths) of the undominated fillings of ``room`` that waste ``slack`` at most: least waste, then largest lengths first.

    Lengths are added from the largest down, so what dominates a part of a filling is larger than all that follows and stays so.
    A length that would make the part dominated is never added: of the fillings that add up to ``room``, which can be too many to
    list, few are looked at. Lengths that fit into the waste are all in the filling, or it is dominated. Each length added counts as ``effort``.
    """
    effort = effort or Effort(None)
    lengths = np.flatnonzero(counts[: room + 1]).tolist()
    present = sum(1 << length for length in lengths)
    place = {length: i for i, length in enumerate(lengths)}

    def exact(target: int, upto: int, sums: int, left: int) -> Iterator[Bin]:
        """Lengths up to a place that add up to ``target``, after others whose parts make ``sums``; ``left`` are those not used up."""
        if target == 0:
            yield ()
            return
        near = _spread_down(left, waste)
        barred = _spread_down(left >> 1, waste - 1) if waste else 0
        rest = sums
        while rest:
            at = rest.bit_length() - 1
            barred |= near >> at
            rest ^= 1 << at
        free = present & ~barred & (1 << min(lengths[upto], target) + 1) - 1 if upto >= 0 else 0
        while free:
            length = free.bit_length() - 1
            free ^= 1 << length
            i = place[length]
            if not reach[i] >> target & 1 or effort.spent():
                return
            most = min(int(counts[length]), target // length)
            made = [sums, sums | 1 << length | sums << length]  # the sums with none and more copies
            while len(made) <= most and not made[-1] << length & near:
                made.append(made[-1] | made[-1] << length)
            for copies in range(len(made) - 1, 0, -1):
                after = target - copies * length
                if after == 0:
                    yield (length,) * copies
                elif i and reach[i - 1] >> after & 1:
                    unused = left & ~(1 << length) if copies == counts[length] else left
                    yield from ((length,) * copies + more for more in exact(after, i - 1, made[copies], unused))

    small: Bin = ()  # those that fit into the waste, with all their copies
    sums, left, reach = 0, present, _reach(counts, lengths, room)
    for waste in range(min(slack, room) + 1):
        if waste and counts[waste]:
            if sum(small) + waste * int(counts[waste]) > room - waste:
                return  # nor does it with more waste
            small = (waste,) * int(counts[waste]) + small
            for _ in range(int(counts[waste])):
                sums |= 1 << waste | sums << waste
            left &= ~(1 << waste)
            larger = lengths[place[waste] + 1 :]
            reach = [1] * (len(lengths) - len(larger)) + _reach(counts, larger, room)
        if sum(small) > room - waste:
            return
        for filling in exact(room - waste - sum(small), len(lengths) - 1, sums, left):
            filling += small
            used = sum(1 << length for length in set(filling) if filling.count(length) == counts[length])
            if not dominated(filling, present & ~used, waste):
                yield waste, filling


def _steps(counts: np.ndarray, size: int, slack: int, effort: Effort) -> Iterator[tuple[int, Bin, int]]:
    """(bins, lengths of each, waste of all) around the largest length: as many bins as can be, then fewer."""
    largest = int(np.flatnonzero(counts)[-1])
    rest = counts.copy()
    rest[largest] -= 1
    for waste, filling in fillings(rest, size - largest, slack, effort):
        lengths = (largest, *filling)
        most = min(int(counts[length]) // lengths.count(length) for length in set(lengths))
        if waste:
            most = min(most, slack // waste)
        for times in range(most, 0, -1):
            yield times, lengths, times * waste


def completed(counts: np.ndarray, size: int, nodes: int = NODES) -> Solution:
    """Patterns that hold ``counts[n]`` pieces of every length n from 1 to ``size``, in as few bins as the search finds.

    ``nodes`` bounds the effort, with LOOKS for each, not the pieces: all are packed. Given enough nodes the number of bins is the least there is.
    """
    counts = counts.astype(np.int64)
    best = best_fit(counts, size)
    bins, bound = sum(n for n, _ in best), lower_bound(counts, size)
    total = int((counts * np.arange(size + 1)).sum())
    solution, left = Solution(bins, best, bound), counts.copy()
    # One entry per step: the further choices at its node, what was chosen, and its bins and waste.
    stack: list[list] = []
    seen: dict[bytes, int] = {}
    done = lost = steps = 0
    effort = Effort(nodes * LOOKS)

    def allowed() -> int:
        """Waste that one bin less than the incumbent leaves."""
        return (solution.bins - 1) * size - total

    def applied(times: int, lengths: Bin) -> None:
        for length in lengths:
            left[length] -= times

    if solution.bins > bound:
        stack.append([_steps(left.copy(), size, allowed(), effort), None])
    while stack and steps < nodes and solution.bins > bound:
        choices, chosen = stack[-1]
        if chosen:
            applied(-chosen[0], chosen[1])
            done, lost, stack[-1][1] = done - chosen[0], lost - chosen[2], None
        step = next(choices, None)
        if step is None or lost + step[2] > allowed() and step[0] == 1:  # the choices that follow waste no less
            stack.pop()
            continue
        if lost + step[2] > allowed():
            continue
        steps += 1
        applied(*step[:2])
        done, lost, stack[-1][1] = done + step[0], lost + step[2], step
        packed = [s[1][:2] for s in stack]
        if not left.any():
            solution = Solution(done, packed, bound)
            continue
        key = left.tobytes()
        if seen.get(key, done + 1) <= done or done + lower_bound(left, size) >= solution.bins:
            continue
        seen[key] = done
        if steps % TRIED == 0:
            rest = best_fit(left, size)
            if done + sum(n for n, _ in rest) < solution.bins:
                solution = Solution(done + sum(n for n, _ in rest), packed + rest, bound)
                continue
        stack.append([_steps(left.copy(), size, allowed() - lost, effort), None])
    return solution
