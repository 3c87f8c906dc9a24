"""Packing lengths into bins by bin completion, a branch-and-bound search (Korf).

The search always fills the bin of the largest length that is left. It enumerates the undominated ways to do
so and gives a branch up when its waste rules out a better packing than the best one
known. Best-fit decreasing gives the first one.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

MAX_STEPS = 400_000  # lengths and sets that a search may look at, about a microsecond each


def best_fit_decreasing(counts: Sequence[int], capacity: int) -> list[list[int]]:
    """Bins of lengths. ``counts[n]`` items have length n."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set if a bin has room r
    for length in range(capacity, 0, -1):
        for _ in range(counts[length]):
            fitting = open_rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                index = by_room[room].pop()
                if not by_room[room]:
                    open_rooms &= ~(1 << room)
                bins[index].append(length)
            else:
                room, index = capacity, len(bins)
                bins.append([length])
            by_room[room - length].append(index)
            open_rooms |= 1 << (room - length)
    return bins


class Fillings:
    """The undominated sets of lengths for the room beside the largest length, those with least waste first.

    Pairs that fill the room come before all others, as most bins need no more. Only then the sums are worked out:
    ``sums[i]`` has a bit for every sum that the i smallest lengths can make, in as many copies as there are. So the
    enumeration of the sets with a given sum follows only branches that lead to one.
    """

    def __init__(self, counts: Sequence[int], lengths: int, room: int):
        self.counts, self.room = counts, room
        self.bits = lengths & (2 << room) - 2
        self.steps = 0  # lengths and sets looked at since the search last asked

    def __iter__(self) -> Iterator[tuple[int, ...]]:
        if self.bits >> self.room & 1:
            yield (self.room,)  # it dominates all others
            return
        below = self.bits
        while below:
            n = below.bit_length() - 1
            below ^= 1 << n
            other = self.room - n
            if other > n:
                break
            if self.bits >> other & 1 and (other < n or self.counts[n] > 1):
                yield n, other
        yield from self._others()

    def _others(self) -> Iterator[tuple[int, ...]]:
        self.lengths = [n for n, bit in enumerate(reversed(bin(self.bits)[2:])) if bit == "1"]
        self.sums, within = [1], (2 << self.room) - 1
        for n in self.lengths:
            reached, copies, step = self.sums[-1], min(self.counts[n], self.room // n), 1
            while copies and reached != within:
                step = min(step, copies)
                reached |= reached << step * n & within
                copies -= step
                step *= 2
            self.sums.append(reached)
        self.steps += len(self.lengths)
        top = len(self.lengths)
        rest = self.sums[top]
        while rest:
            total = rest.bit_length() - 1
            rest ^= 1 << total
            for chosen in self._with_sum(total, top, 0):
                self.steps += 1
                if (total < self.room or len(chosen) > 2) and not self.dominated(chosen):
                    yield chosen

    def _with_sum(self, total: int, top: int, used: int) -> Iterator[tuple[int, ...]]:
        """Sets of the ``top`` smallest lengths with this sum; ``used`` copies of the largest of them are taken."""
        if not total:
            yield ()
            return
        fitting = bisect_right(self.lengths, total, 0, top)
        if fitting < top:
            top, used = fitting, 0
        while top and self.sums[top] >> total & 1:
            n = self.lengths[top - 1]
            if used < self.counts[n]:
                for others in self._with_sum(total - n, top, used + 1):
                    yield (n, *others)
            self.steps += 1
            top, used = top - 1, 0

    def dominated(self, chosen: tuple[int, ...]) -> bool:
        """Whether a length that was left out fits in place of some of ``chosen`` that are no longer together.

        Then the set with that length leaves shorter ones for other bins, and stands for this set.
        """
        slack = self.room - sum(chosen)
        own = sum(1 << n for n in set(chosen))
        if _spread(_sums(chosen), slack) & self.bits & ~own:
            return True
        again = [n for n in set(chosen) if chosen.count(n) < self.counts[n]]
        return any(_spread(_sums([m for m in chosen if m != n]), slack) >> n & 1 for n in again)


def _sums(chosen: Sequence[int]) -> int:
    sums = 1
    for n in chosen:
        sums |= sums << n
    return sums


def _spread(bits: int, reach: int) -> int:
    """A bit for every place that is at most ``reach`` above a bit."""
    step = 1
    while reach:
        step = min(step, reach)
        bits |= bits << step
        reach -= step
        step *= 2
    return bits


def lower_bound(counts: Sequence[int], capacity: int) -> int:
    """No packing has fewer bins: the sum, and what lengths over half a bin leave to lengths from k up."""
    best = -(-sum(n * c for n, c in enumerate(counts)) // capacity)
    large = [(n, c) for n, c in enumerate(counts) if c and 2 * n > capacity]
    n_large = sum(c for _, c in large)
    room = sum((capacity - n) * c for n, c in large)
    # Going up in k, bins of lengths over capacity - k take nothing of length k or more.
    small = sum(n * c for n, c in enumerate(counts) if 2 * n <= capacity)
    for k in range(1, capacity // 2 + 1):
        closed = capacity - k + 1
        if 2 * closed > capacity and closed < len(counts):
            room -= (capacity - closed) * counts[closed]
        best = max(best, n_large - (-max(0, small - room) // capacity))
        small -= k * counts[k] if k < len(counts) else 0
    return best


def pack(counts: Sequence[int], capacity: int, max_steps: int = MAX_STEPS) -> list[list[int]]:
    """Bins of lengths, as few as the search finds within ``max_steps``; the fewest there are if it ends before.

    ``counts[n]`` items have length n; lengths run from 1 to the capacity.
    """
    best = best_fit_decreasing(counts, capacity)
    total = sum(n * c for n, c in enumerate(counts))
    bound = lower_bound(counts, capacity)
    left = list(counts) + [0] * (capacity + 1 - len(counts))
    lengths = sum(1 << n for n in range(1, capacity + 1) if left[n])
    items, waste, steps = sum(left[1:]), 0, 0
    # Per open bin: its largest length, the ways to fill it, those to come, the one in use.
    frames: list[list] = []

    def take(chosen: tuple[int, ...], sign: int) -> None:
        nonlocal lengths, items
        for n in chosen:
            left[n] -= sign
            items -= sign
            lengths = lengths | 1 << n if left[n] else lengths & ~(1 << n)

    def open_bin() -> None:
        largest = lengths.bit_length() - 1
        take((largest,), 1)
        ways = Fillings(left, lengths, capacity - largest)
        frames.append([largest, ways, iter(ways), None])

    if len(best) > bound:
        open_bin()
    while frames and len(best) > bound and steps < max_steps:
        frame = frames[-1]
        if frame[3] is not None:
            waste -= capacity - frame[0] - sum(frame[3])
            take(frame[3], -1)
        frame[3] = next(frame[2], None)
        steps += 1 + frame[1].steps
        frame[1].steps = 0
        if frame[3] is None:
            take((frame[0],), -1)
            frames.pop()
            continue
        waste += capacity - frame[0] - sum(frame[3])
        take(frame[3], 1)
        if waste > (len(best) - 1) * capacity - total:
            # Ways come by their waste, so no further one saves a bin either.
            frame[2] = iter(())
            continue
        if items:
            open_bin()
        else:
            best = [[largest, *filling] for largest, _, _, filling in frames]
    return best
