"""Merging pairs of symbols in arrays of words, touching only the places of the pair.

Words stand one after another in one array of symbol numbers, with a 0 before and
after each. A symbol made of several cells has its number in its first and its last
one (-1 between them), so both neighbours of a place are found by the widths of
symbols.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np

Pair = tuple[int, int]


def pair_keys(sym: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The pairs whose right symbols start at ``bounds``, as one number each; 0 at the edge of a word."""
    left, right = sym[bounds - 1].astype(np.int64), sym[bounds].astype(np.int64)
    return np.where((left > 0) & (right > 0), left << 32 | right, 0)


def is_among(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which keys are among ``some``, which are sorted."""
    if not len(some):
        return np.zeros(len(keys), bool)
    return some[np.minimum(np.searchsorted(some, keys), len(some) - 1)] == keys


def by_key(keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Values by key, in the order they stand in."""
    if len(keys):
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        yield from zip(keys[first].tolist(), np.split(values, first[1:]))


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys other than 0 and the sums of their ``n``."""
    keep = keys != 0
    keys, n = keys[keep], n[keep]
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first)


def _distinct(*parts: np.ndarray) -> np.ndarray:
    every = np.sort(np.concatenate(parts))
    return every[np.concatenate((every[:1] == every[:1], every[1:] != every[:-1]))]


class Cells:
    """An array of words and the places of pairs in it."""

    def __init__(self, sym: np.ndarray):
        self.sym = sym
        self.width: dict[int, int] = {}
        self.gone = np.zeros(len(sym), bool)

    def size(self, symbol: int) -> int:
        return self.width.get(symbol, 1)

    def places(self, pair: Pair, found: np.ndarray) -> np.ndarray:
        """Where the pair still stands, of the places found before; of a run of equal symbols every second one."""
        a, b = pair
        middle = np.sort(found).astype(np.int64)
        middle = middle[(self.sym[middle - 1] == a) & (self.sym[middle] == b)]
        if a == b:
            run = np.concatenate(([True], np.diff(middle) != self.size(a)))
            nth = np.arange(len(middle)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            middle = middle[nth % 2 == 0]
        return middle

    def merge(self, pair: Pair, new: int, middle: np.ndarray) -> np.ndarray:
        """Put one symbol in the places; returns where pairs with it have their right symbols."""
        a, b = pair
        first, after = middle - self.size(a), middle + self.size(b)
        # What is inside the new symbol is no start or end any more.
        self.sym[middle - 1] = self.sym[middle] = -1
        self.sym[first] = self.sym[after - 1] = new
        self.gone[middle] = True
        self.width[new] = self.size(a) + self.size(b)
        return _distinct(first, after)

    def compact(self) -> np.ndarray:
        """The array with one cell for each symbol again."""
        return self.sym[~self.gone]


def learn(
    sym: np.ndarray, weights: np.ndarray, wanted: int, least: int, name: Callable[[Pair], tuple | None], number: Callable[[Pair], tuple[int, bool]],
) -> list[tuple[int, int, int]]:
    """Merge the most frequent pair again and again: (left, right, new symbol) in order.

    ``weights`` has a count for each word. ``name`` gives the order among pairs of one
    count, or None for a pair that must not be merged; ``number`` the new symbol, and
    whether it is a new one. It ends after ``wanted`` merges, when no pair has a count of
    ``least``, or after a merge whose symbol was there before.
    """
    cells, starts = Cells(sym), np.flatnonzero(sym == 0)
    counts: dict[int, int] = {}
    places: dict[int, list[np.ndarray]] = {}
    heap: list[tuple] = []

    def counted(bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        keys = pair_keys(cells.sym, bounds)
        for key, found in by_key(keys[keys != 0], bounds[keys != 0]):
            yield key, int(weights[np.searchsorted(starts, found, "right") - 1].sum()), found

    def push(key: int) -> None:
        order = name((key >> 32, key & 0xFFFFFFFF))
        if order is not None and counts[key] >= least:
            heapq.heappush(heap, (-counts[key], order, key))

    # In parts, so that the sorted keys of a part are all that is held besides the places.
    for low in range(1, len(sym), 1 << 20):
        for key, n, found in counted(np.arange(low, min(len(sym), low + (1 << 20)))):
            counts[key] = counts.get(key, 0) + n
            places.setdefault(key, []).append(found.astype(np.int32))
    for key in counts:
        push(key)
    merges: list[tuple[int, int, int]] = []
    while heap and len(merges) < wanted:
        negative, _, key = heapq.heappop(heap)
        n = counts.get(key, 0)
        if n != -negative:
            # Counted down since (a count that rose was pushed again).
            if 0 < n < -negative:
                push(key)
            continue
        pair = (key >> 32, key & 0xFFFFFFFF)
        new, fresh = number(pair)
        merges.append((*pair, new))
        if not fresh:
            break
        middle = cells.places(pair, np.concatenate(places.pop(key)))
        a, b = pair
        for changed, total, _ in counted(_distinct(middle - cells.size(a), middle, middle + cells.size(b))):
            counts[changed] -= total
            if not counts[changed]:
                del counts[changed]
                places.pop(changed, None)
        for changed, total, found in counted(cells.merge(pair, new, middle)):
            counts[changed] = counts.get(changed, 0) + total
            places.setdefault(changed, []).append(found.astype(np.int32))
            push(changed)
    return merges


def replay(sym: np.ndarray, merges: list[tuple[int, int, int]]) -> np.ndarray:
    """The words after these merges, one after another, each everywhere; only their places are touched."""
    cells = Cells(sym.copy())
    wanted = np.sort(np.array([a << 32 | b for a, b, _ in merges], np.int64))
    places: dict[int, list[np.ndarray]] = {}

    def note(bounds: np.ndarray) -> None:
        keys = pair_keys(cells.sym, bounds)
        keep = is_among(keys, wanted)
        for key, found in by_key(keys[keep], bounds[keep]):
            places.setdefault(key, []).append(found.astype(np.int32))

    for low in range(1, len(sym), 1 << 20):
        note(np.arange(low, min(len(sym), low + (1 << 20))))
    for a, b, new in merges:
        found = places.pop(a << 32 | b, None)
        if found is not None:
            middle = cells.places((a, b), np.concatenate(found))
            if len(middle):
                note(cells.merge((a, b), new, middle))
    return cells.compact()


def runs_of(sym: np.ndarray, weights: np.ndarray, pairs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of symbols that are neighbours in one of ``pairs`` (sorted keys), by length: (distinct runs, counts)."""
    live = np.concatenate((is_among(pair_keys(sym, np.arange(1, len(sym))), pairs), [False]))
    before = np.concatenate(([False], live[:-1]))
    first, last = np.flatnonzero(live & ~before), np.flatnonzero(before & ~live)
    n, length = weights[np.cumsum(sym == 0)[first] - 1], last - first + 1
    order = np.argsort(length, kind="stable")
    edges = np.flatnonzero(np.diff(length[order])) + 1
    for group in np.split(order, edges):
        if len(group):
            size = int(length[group[0]])
            rows = np.ascontiguousarray(sym[first[group][:, None] + np.arange(size)])
            distinct, which = np.unique(rows.view(np.dtype((np.void, 4 * size))).ravel(), return_inverse=True)
            sums = np.zeros(len(distinct), np.int64)
            np.add.at(sums, which, n[group])
            yield distinct.view(np.int32).reshape(-1, size), sums
