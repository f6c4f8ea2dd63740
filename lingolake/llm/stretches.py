"""A store of encoded stretches of text, from which texts' ids are put together without a Python object per id."""

from __future__ import annotations

from itertools import repeat

import numpy as np


class Numbers(dict):
    """Numbers of stretches; new ones get the next numbers when they are first asked for.

    ``old`` has those of the generation before, which come over when they are asked for again.
    """

    def __init__(self, seen: Stretches, old: dict[bytes, int] | None = None):
        self.seen, self.old = seen, old or {}

    def of(self, stretches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of distinct stretches, and the places of those that are new."""
        n = len(stretches)
        out = np.fromiter(map(self.get, stretches, repeat(-1)), np.int64, n)
        missing = np.flatnonzero(out < 0)
        asked = stretches[missing].tolist()
        at = np.fromiter(map(self.old.get, asked, repeat(-1)), np.int64, len(asked))
        new = np.flatnonzero(at < 0)
        at[new] = np.arange(self.seen.given, self.seen.given + len(new))
        self.seen.given += len(new)
        self.update(zip(asked, at.tolist()))
        out[missing] = at
        return out, missing[new]


class Stretches:
    """Ids of stretches by number.  Numbers are given out first (``Numbers``), ids are added later, in any order."""

    def __init__(self):
        self.given = self.used = 0
        self.begin, self.size, self.flat = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)

    def add(self, numbers: list[int] | np.ndarray, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Adds stretches whose ids lie between ``starts`` and ``ends`` within ``ids``."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.given > len(self.begin):
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        self.flat[self.used : self.used + len(ids)] = ids
        self.begin[numbers] = self.used + starts
        self.size[numbers] = ends - starts
        self.used += len(ids)

    def gather(self, numbers: list[int]) -> np.ndarray:
        """The ids of stretches, one after the other."""
        at = np.asarray(numbers, np.int64)
        if not len(at):
            return np.zeros(0, np.uint32)
        n = self.size[at]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.begin[at] - ends + n, n) + np.arange(ends[-1])]


def renewed(seen: Stretches, known: list[Numbers], without: set[int] = frozenset()) -> tuple[Stretches, list[Numbers]]:
    """A new generation, which begins with what this one was asked for (but for the numbers ``without``)."""
    fresh, out = Stretches(), []
    for numbers in known:
        kept = {p: i for p, i in numbers.items() if i not in without} if without else numbers
        at = np.fromiter(kept.values(), np.int64, len(kept))
        first = fresh.given
        fresh.given += len(at)
        if len(at):
            ends = np.cumsum(seen.size[at])
            fresh.add(np.arange(first, fresh.given), seen.gather(at), ends - seen.size[at], ends)
        out.append(Numbers(fresh, dict(zip(kept, range(first, fresh.given)))))
    return fresh, out


def parted(sizes: np.ndarray, ids: np.ndarray, lengths: np.ndarray | list[int]) -> np.ndarray | None:
    """Where the ids of stretches end, given the bytes of each id and of each stretch; None if an id spans a border."""
    ends, at = np.cumsum(lengths), np.cumsum(sizes[ids])
    if not len(at) or at[-1] != ends[-1]:
        return None
    stop = np.searchsorted(at, ends)
    return stop + 1 if (at[stop] == ends).all() else None
