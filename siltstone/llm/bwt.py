"""Column-wise construction of the Burrows-Wheeler transform and common prefixes of a collection.

All strings are aligned at their ends.  Round j inserts, for every string of at
least j symbols, its suffix of length j: the place is found from the symbol in
front of the previous suffix and its rank among equal symbols of the transform
so far, and the longest common prefixes with both new neighbours are one more
than a minimum over the old ones.  Transform and prefixes are one sequence of
pairs that each round reads once from front to back and writes anew; it lies in
a file beyond a set size, so only the strings' own places are held in memory.

Suffixes of different strings never compare equal past an end: each string has
an end of its own, in the order of the strings.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 22
#: Sequences up to this many pairs stay in memory; longer ones go to scratch files of the running task.
IN_MEMORY = 1 << 24


class Sequence:
    """Pairs of a symbol (low byte) and a common prefix with what stands before (high byte), written once and read in order, in memory or in a file."""

    def __init__(self, n: int, in_memory: int = IN_MEMORY):
        self.n, self.at = n, 0
        self.file = tempfile.TemporaryFile() if n > in_memory else None
        self.data = None

    def write(self, values: np.ndarray) -> None:
        if self.file:
            self.file.write(values.tobytes())
        elif len(values) == self.n:
            self.data = values
        else:
            if self.data is None:
                self.data = np.empty(self.n, dtype=np.uint16)
            self.data[self.at : self.at + len(values)] = values
        self.at += len(values)

    def read(self, start: int, end: int) -> np.ndarray:
        if self.file:
            self.file.seek(2 * start)
            return np.frombuffer(self.file.read(2 * (end - start)), dtype=np.uint16)
        return self.data[start:end]

    def symbols(self, start: int, end: int) -> np.ndarray:
        return self.read(start, end).astype(np.uint8)

    def prefixes(self, start: int, end: int) -> np.ndarray:
        return (self.read(start, end) >> np.uint16(8)).astype(np.uint8)

    def close(self) -> None:
        if self.file:
            self.file.close()


def _pairs(symbols: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
    return symbols | (prefixes.astype(np.uint16) << np.uint16(8))


def _range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low..high], both included; no two low ends are equal."""
    if not len(low):
        return np.zeros(0, dtype=np.uint8)
    owner = np.empty(len(values), dtype=np.int32)
    used = np.zeros(len(values), dtype=bool)
    owner[low] = np.arange(len(low), dtype=np.int32)
    used[low] = True
    sorted_low = np.flatnonzero(used)  # in order, so that the gaps between the ranges cost one pass
    order = owner[sorted_low]
    pairs = np.empty(2 * len(low), dtype=np.int64)
    pairs[0::2], pairs[1::2] = sorted_low, high[order] + 1
    out = np.empty(len(low), dtype=np.uint8)
    out[order] = np.minimum.reduceat(np.append(values, np.uint8(255)), pairs)[0::2]
    return out


def _inside(sorted_at: np.ndarray, a: int, b: int, whole: bool) -> tuple[int, int]:
    return (0, len(sorted_at)) if whole else tuple(np.searchsorted(sorted_at, [a, b]))


class Collection:
    """Symbols are bytes under 255 (UTF-8 has none over 244); lengths are under 255."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, chunk: int = CHUNK, in_memory: int = IN_MEMORY):
        self.order = np.argsort(-lengths.astype(np.int64), kind="stable")  # the longest first: those still growing are a prefix
        self.lengths = lengths[self.order].astype(np.int64)
        self.last = np.cumsum(lengths, dtype=np.int64)[self.order] - 1
        self.data, self.m, self.chunk, self.in_memory = data, len(lengths), chunk, in_memory
        self.growing = np.searchsorted(-self.lengths, -np.arange(int(self.lengths[0]) + 2 if self.m else 1), side="right")
        self.build()

    def symbols(self, j: int, n: int) -> np.ndarray:
        """In front of the suffix of length j, for the first n strings; 0 at a string's start."""
        going = self.growing[j + 1]  # those of more than j symbols
        out = np.zeros(n, dtype=np.uint8)
        out[:going] = self.data[self.last[:going] - j] + np.uint8(1)
        return out

    def build(self) -> None:
        m = self.m
        first = self.symbols(0, m) if m else np.zeros(0, np.uint8)
        self.counts = np.bincount(first, minlength=256)
        self.sequence = Sequence(m, self.in_memory)
        self.sequence.write(_pairs(first, np.zeros(m, dtype=np.uint8)))
        place = np.arange(m)
        for j in range(1, int(self.lengths[0]) + 1 if m else 1):
            place = place[: self.growing[j]]
            place, prefix, next_at, next_prefix = self._ranks(place)
            new = self.symbols(j, len(place))
            self.sequence = self._insert(place, _pairs(new, prefix), next_at, next_prefix)
            self.counts += np.bincount(new, minlength=256)

    def _ranks(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """One pass over the sequence: the new places of the suffixes, their prefixes with what stands before, and the
        places and prefixes of what stands behind."""
        n, m, counts = self.sequence.n, self.m, self.counts
        base = m + np.concatenate(([0], np.cumsum(counts)[:-1])) - counts[0]  # first place of the suffixes with each first symbol
        seen = np.zeros(256, dtype=np.int64)
        carry = np.full(256, 255, dtype=np.uint8)  # least prefix since the last of each symbol
        was_active = np.zeros(256, dtype=bool)
        whole = n <= self.chunk
        order = None if whole else np.argsort(place, kind="stable")
        sorted_place = place if whole else place[order]
        out_at = np.empty(len(place), dtype=np.int64)
        out_prefix = np.empty(len(place), dtype=np.uint8)
        behind: list[tuple[np.ndarray, np.ndarray]] = []
        for a in range(0, n, self.chunk):
            b = min(n, a + self.chunk)
            s, v = self.sequence.symbols(a, b), self.sequence.prefixes(a, b)
            i, k = _inside(sorted_place, a, b, whole)
            local = sorted_place[i:k] - a
            active = np.zeros(b - a, dtype=bool)
            active[local] = True
            by = np.argsort(s, kind="stable")
            here = counts if whole else np.bincount(s, minlength=256)
            starts = np.concatenate(([0], np.cumsum(here)[:-1]))
            there = np.flatnonzero(here)
            act = active[by]
            some = act.copy()  # the new suffixes and what stands right behind one in its symbol's list
            some[1:] |= act[:-1]
            heads = starts[there]
            some[heads] = act[heads] | was_active[there]
            at_list = np.flatnonzero(some)
            pos = by[at_list]
            sym = s[pos]
            mine = act[at_list]
            head = at_list == starts[sym]
            value = np.zeros(len(at_list), dtype=np.uint8)
            inner = np.flatnonzero((sym != 0) & ~head)
            value[inner] = _range_minima(v, by[at_list[inner] - 1] + 1, pos[inner]) + np.uint8(1)
            if a:  # the first of a symbol in this chunk follows its last in an earlier one
                outer = np.flatnonzero(head & (sym != 0) & (seen[sym] > 0))
                least = np.minimum.accumulate(v)
                value[outer] = np.minimum(carry[sym[outer]], least[pos[outer]]) + np.uint8(1)
            at = (base + seen - starts)[sym] + at_list
            back = np.empty(b - a, dtype=np.int32)
            own = np.flatnonzero(mine)
            back[pos[own]] = own
            rows = back[local]
            to = slice(i, k) if whole else order[i:k]
            out_at[to], out_prefix[to] = at[rows], value[rows]
            after = np.flatnonzero(~mine & (sym != 0))
            behind.append((at[after], value[after]))
            if b < n:
                least_behind = np.append(np.minimum.accumulate(v[::-1])[::-1], np.uint8(255))
                absent = here == 0
                carry[absent] = np.minimum(carry[absent], least_behind[0])
                last = starts[there] + here[there] - 1
                carry[there] = least_behind[by[last] + 1]
                was_active[there] = act[last]
                seen += here
        return out_at, out_prefix, np.concatenate([x for x, _ in behind]), np.concatenate([x for _, x in behind])

    def _insert(self, at: np.ndarray, new: np.ndarray, next_at: np.ndarray, next_prefix: np.ndarray) -> Sequence:
        """The sequence with the new pairs in their places and the prefixes of what stands behind them set anew."""
        n = self.sequence.n + len(at)
        out = Sequence(n, self.in_memory)
        whole = n <= self.chunk
        order, next_order = (slice(None), slice(None)) if whole else (np.argsort(at, kind="stable"), np.argsort(next_at, kind="stable"))
        sorted_at, sorted_next = at[order], next_at[next_order]
        sorted_new, sorted_prefix = new[order], next_prefix[next_order]
        taken = 0
        for a in range(0, n, self.chunk):
            b = min(n, a + self.chunk)
            i, k = _inside(sorted_at, a, b, whole)
            old = np.ones(b - a, dtype=bool)
            inside = sorted_at[i:k] - a
            old[inside] = False
            upto = taken + (b - a) - (k - i)
            pairs = np.empty(b - a, dtype=np.uint16)
            pairs[old] = self.sequence.read(taken, upto)
            pairs[inside] = sorted_new[i:k]
            x, y = _inside(sorted_next, a, b, whole)
            changed = sorted_next[x:y] - a
            pairs[changed] = (pairs[changed] & np.uint16(255)) | (sorted_prefix[x:y].astype(np.uint16) << np.uint16(8))
            out.write(pairs)
            taken = upto
        self.sequence.close()
        return out

    def steps(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For j = 1, 2, ...: the strings that have a suffix of length j, as numbers in the order given, and its places in the transform."""
        n = self.sequence.n
        to = np.empty(n, dtype=np.int32 if n < 1 << 31 else np.int64)
        to[np.argsort(self.sequence.symbols(0, n), kind="stable")] = np.arange(self.m - self.counts[0], n + self.m - self.counts[0], dtype=to.dtype)
        at = np.arange(self.m)
        for j in range(1, (int(self.lengths[0]) if self.m else 0) + 1):
            going = self.growing[j]
            at = to[at[:going]]
            yield j, self.order[:going], at

    def classes(self, width: int) -> np.ndarray:
        """A number for each place of the transform: suffixes of width symbols or more have equal numbers if their first width symbols are equal."""
        return np.cumsum(self.sequence.prefixes(0, self.sequence.n) < width, dtype=np.int64)

    def close(self) -> None:
        self.sequence.close()
