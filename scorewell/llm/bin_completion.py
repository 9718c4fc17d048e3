"""Bin completion over counts of sizes: as few bins of ``capacity`` as the search finds.

Sizes are whole numbers of at most ``capacity``, so however many items there are,
the search sees one count a size, and a *pattern* (so many items of each of some
sizes) stands for all bins that are filled alike.

* ``best_fit``: sizes in descending order, each item into the fullest bin that has
  room; bins with equal room take items together.
* ``bound``: no packing has fewer bins (the L2 bound of Martello and Toth: sizes
  that can't share a bin, and the room beside them against what needs it).
* ``dive``: around the largest item left, the least wasteful of the first fillings of
  its bin, used as often as the counts allow, until nothing is left.  Each pattern uses
  up a size, so there are at most as many steps as sizes.
* ``complete``: best fit, then the dive, then branch and bound: around the largest item
  left, the undominated fillings of its bin, least waste first, each used as often as
  the counts allow and then once.  At each node best fit completes the packing: the
  incumbent.  A node is pruned if its bins and the bound of what is left, wasted room
  included, reach the incumbent; the nodes below one are made when they are due.

A filling is dominated if an item that is left out fits into its room, or could
stand for smaller ones in it: swapping them never makes the rest harder to pack.

The search ends when the incumbent meets the bound, when all nodes are visited
(then it is proven to be least as well), or after ``nodes`` nodes; it keeps the
best packing found.  ``fillings`` bounds the fillings tried at a node, ``dive`` those
at a step.  All bound the time, not the items: every item is in the packing, whatever
ends the search.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np

#: A bin's contents: (size, items of it), largest size first.
Pattern = tuple[tuple[int, int], ...]


@dataclass(frozen=True)
class Packing:
    #: How many bins each pattern fills.
    bins: dict[Pattern, int]
    least: int
    proven: bool

    @property
    def n(self) -> int:
        return sum(self.bins.values())


def best_fit(counts: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Best fit in descending order of size; groups of bins with equal contents go together."""
    room: dict[int, list[tuple[Pattern, int]]] = {}  # groups by the room that is left
    rooms: list[int] = []

    def put(pattern: Pattern, left: int, n: int) -> None:
        if left not in room:
            rooms.insert(bisect_left(rooms, left), left)
            room[left] = []
        room[left].append((pattern, n))

    for size in sorted((k for k, n in counts.items() if n), reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                space = rooms[at]
                pattern, n = room[space].pop()
                if not room[space]:
                    del room[space], rooms[at]
            else:
                space, pattern, n = capacity, (), left
            each = space // size
            full = min(n, left // each)
            if full:
                put((*pattern, (size, each)), space - each * size, full)
                left -= full * each
            if full < n and left and left < each:
                put((*pattern, (size, left)), space - left * size, 1)
                full, left = full + 1, 0
            if full < n and pattern:
                put(pattern, space, n - full)
    out: Counter[Pattern] = Counter()
    for groups in room.values():
        for pattern, n in groups:
            out[pattern] += n
    return dict(out)


def bound(counts: dict[int, int], capacity: int) -> int:
    """L2: for a threshold t, items over capacity - t stand alone, those over half the
    capacity in bins of their own with room for others, and those of t or more fill the room or need more bins."""
    n = np.zeros(capacity + 2, np.int64)
    n[np.fromiter(counts, np.int64, len(counts))] = np.fromiter(counts.values(), np.int64, len(counts))
    number = np.concatenate([[0], np.cumsum(n)])  # below each size
    total = np.concatenate([[0], np.cumsum(n * np.arange(capacity + 2))])
    t = np.arange(capacity // 2 + 1)
    half = capacity // 2 + 1
    over, high = number[-1] - number[capacity - t + 1], number[capacity - t + 1] - number[half]
    free = high * capacity - (total[capacity - t + 1] - total[half])
    need = total[half] - total[np.minimum(t, half)]
    return int((over + high + np.maximum(0, -((free - need) // capacity))).max())


def _smear(bits: int, n: int, by: int = 1) -> int:
    """The bits moved up by 0 to n times ``by`` places, all of them."""
    done = 1
    while done <= n:
        step = min(done, n + 1 - done)
        bits |= bits << step * by
        done += step
    return bits


def dominated(filling: list[tuple[int, int]], left_out: int, room: int) -> bool:
    """Could an item left out (bit x of ``left_out``: one of size x is) join the filling,
    or stand for smaller ones or several of the same sum in it, within ``room``?"""
    one, more, every = 0, 0, 1  # sums of one item, of two or more, of any number with none
    for size, n in filling:
        more |= _smear((every ^ 1) << size, n - 1, size)
        if n > 1:
            more |= _smear(1 << 2 * size, n - 2, size)
        one |= 1 << size
        every = _smear(every, n, size)
    could = _smear(more, room)
    if room:
        could |= _smear((1 | one) << 1, room - 1)
    return bool(could & left_out)


def ways(sizes: list[int], left: dict[int, int], space: int) -> Iterator[tuple[tuple[tuple[int, int], ...], int]]:
    """(what is taken, the room left) for choices of items of the ascending ``sizes``, most of the largest first;
    all of them but those that leave out some of the smallest for which there is room."""
    stack = [(len(sizes), space, ())]
    while stack:
        k, space, taken = stack.pop()
        k = bisect_right(sizes, space, 0, k)
        if not k:
            yield taken, space
            continue
        size = sizes[k - 1]
        n = min(left[size], space // size)
        if k > 1:
            stack.append((k - 1, space, taken))
            stack.extend((k - 1, space - m * size, (*taken, (size, m))) for m in range(1, n))
        stack.append((k - 1, space - n * size, (*taken, (size, n))))


def fillings(counts: dict[int, int], largest: int, capacity: int, most: int) -> tuple[list[list[tuple[int, int]]], bool]:
    """The undominated ways to fill the bin of ``largest``, least waste first; and whether they are all."""
    left = {k: n for k, n in counts.items() if n and k <= largest}
    left[largest] -= 1
    sizes = sorted(k for k, n in left.items() if n)
    every = np.zeros(capacity + 1, np.uint8)
    every[sizes] = 1
    all_left = int.from_bytes(np.packbits(every, bitorder="little").tobytes(), "little")
    found, whole = [], True
    for tried, (taken, room) in enumerate(ways(sizes, left, capacity - largest), 1):
        if len(found) >= most or tried > 20 * most:
            whole = False
            break
        out = all_left
        for size, n in taken:
            if left[size] == n:
                out ^= 1 << size
        if not dominated(taken, out, room):
            found.append((room, list(taken)))
    return [taken for _, taken in sorted(found, key=lambda f: f[0])], whole


def _used(pattern: Pattern, left: dict[int, int], times: int) -> dict[int, int]:
    """What is left after so many bins of the pattern."""
    after = dict(left)
    for size, n in pattern:
        after[size] -= times * n
        if not after[size]:
            del after[size]
    return after


def _pattern(largest: int, taken) -> Pattern:
    """The filling's items and the largest."""
    items = dict(taken)
    items[largest] = items.get(largest, 0) + 1
    return tuple(sorted(items.items(), reverse=True))


def dive(counts: dict[int, int], capacity: int, most: int = 1000, spare: int = 1_000_000) -> dict[Pattern, int]:
    """The packing that takes, for the largest item left, the least wasteful of the first ways to fill its bin.

    A step tries ``most``, and up to 39 times as many more while ``spare``, further ones of all steps, lasts.
    """
    left, bins = {k: n for k, n in counts.items() if n}, {}
    sizes = sorted(left)
    while sizes:
        largest = sizes[-1]
        left[largest] -= 1
        best, least, tried = (), capacity, 0
        for taken, room in islice(ways(sizes if left[largest] else sizes[:-1], left, capacity - largest), most + min(39 * most, spare)):
            tried += 1
            if room < least:
                best, least = taken, room
            if not room:
                break
        spare -= max(0, tried - most)
        left[largest] += 1
        pattern = _pattern(largest, best)
        times = min(left[s] // n for s, n in pattern)
        bins[pattern] = bins.get(pattern, 0) + times
        for size, n in pattern:
            left[size] -= times * n
            if not left[size]:
                del sizes[bisect_left(sizes, size)]
    return bins


def complete(counts: dict[int, int], capacity: int, nodes: int = 300, most_fillings: int = 50) -> Packing:
    """The best packing that the search finds; see the module."""
    counts = {k: n for k, n in counts.items() if n}
    if any(not 0 < k <= capacity for k in counts):
        raise ValueError(f"sizes must be from 1 to {capacity}")
    least = bound(counts, capacity)
    best = best_fit(counts, capacity)
    best_n, proven, visited = sum(best.values()), True, 0
    if best_n > least:
        other = dive(counts, capacity)
        if sum(other.values()) < best_n:
            best, best_n = other, sum(other.values())

    def below(left: dict[int, int], done: dict[Pattern, int], used: int, found: list[list[tuple[int, int]]]) -> Iterator[tuple]:
        largest = max(left)
        for taken in found:
            pattern = _pattern(largest, taken)
            often = min(left[s] // n for s, n in pattern)
            for times in dict.fromkeys((often, 1)):
                yield _used(pattern, left, times), done | {pattern: done.get(pattern, 0) + times}, used + times

    # Depth first: of each open node those below it, each (what is left, the bins so far, how many they are).
    stack = [iter([(counts, {}, 0)])] if best_n > least else []
    while stack:
        node = next(stack[-1], None)
        if node is None:
            stack.pop()
            continue
        left, done, used = node
        # The waste of the bins so far counts in used, that of the rest in its bound.
        beneath = used + bound(left, capacity)
        if beneath >= best_n:
            continue
        if visited >= nodes:
            proven = False
            break
        visited += 1
        rest = best_fit(left, capacity)
        if used + sum(rest.values()) < best_n:
            best = dict(done)
            for p, n in rest.items():
                best[p] = best.get(p, 0) + n
            best_n = used + sum(rest.values())
            if best_n <= least:
                break
        if beneath < best_n:
            found, whole = fillings(left, max(left), capacity, most_fillings)
            proven &= whole
            stack.append(below(left, done, used, found))
    return Packing(best, least, proven or best_n == least)
