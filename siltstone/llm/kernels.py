"""Vectorised text kernels shared by the operators of this subpackage.

All kernels work on one contiguous byte buffer that holds many texts, so the
cost per text is small and no Python loop runs per byte or per word.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D; all separators
are ASCII, so UTF-8 texts can be cut as bytes.  A word's hash is chained over
its 8-byte lanes through a finaliser that is a bijection, so words of up to 8
bytes never collide with others of their length and no algebra of long words
(as of polynomials modulo 2**64) makes two of them equal.

Hashes of windows are Rabin-Karp polynomials modulo 2**64: the hash of
``x[s:e]`` is ``sum(x[i] * B**(i - s))``, read off a prefix sum in constant time
because the odd base B has an inverse.  A finaliser spreads the polynomial over
all bits before it is cut or used for ordering.  Such polynomials find
candidates; where a wrong match would change a result, operators compare the
bytes or a cryptographic digest of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)


def _byte_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)


BYTE_VALUES = _byte_table(7)
#: ASCII capitals folded.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] = np.arange(97, 123)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown on demand and kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.empty(size, dtype=np.uint64)
        out[0] = 1
        done = 1
        while done < size:  # doubling: the next block is the first times base**done
            take = min(done, size - done)
            np.multiply(out[:take], U64(pow(base, done, 1 << 64)), out=out[done : done + take])
            done += take
        _powers[base] = have = out
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and odd multiplication, a bijection)."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(29)
    h *= U64(0xA0761D6478BD642F)
    h ^= h >> U64(32)
    return h


_LANE = np.array([(1 << 8 * i) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
#: Words of more bytes are hashed one by one.
LONG_WORD = 64


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word ``data[s:e]``."""
    length = ends - starts
    lanes = np.ndarray((len(data) + 1,), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), 0, (1,))  # the 8 bytes from every place on
    out = mix(lanes[starts] & _LANE[np.minimum(length, 8)] ^ (length.astype(np.uint64) * U64(0x9E3779B97F4A7C15)))
    short = length <= LONG_WORD
    going, done = np.flatnonzero((length > 8) & short), 8
    while len(going):
        lane = lanes[starts[going] + done] & _LANE[np.minimum(length[going] - done, 8)]
        out[going] = mix((out[going] + U64(0xA24BAED4963EE407)) ^ lane)
        done += 8
        going = going[length[going] > done]
    for i in np.flatnonzero(~short).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


class Hasher:
    """Polynomial hashes of the slices of one sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        n = len(values)
        self.inv = powers(pow(base, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(base, n), out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inv[start])

    def raw_windows(self, width: int) -> np.ndarray:
        """As windows, before the finaliser: equal for equal windows, but spread over the high bits only after a multiplication."""
        n = max(0, len(self.sums) - width)
        out = self.sums[width : width + n] - self.sums[:n]
        out *= self.inv[:n]
        return out

    def windows(self, width: int) -> np.ndarray:
        """Of every window of this width; the entry i starts at i."""
        return mix(self.raw_windows(width))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and the n + 1 offsets, without a copy where there are no nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the buffer, and the n + 1 word offsets of the texts. No word crosses a text."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~space[data]
    first = np.empty(n, dtype=bool)
    first[0] = True
    np.logical_not(solid[:-1], out=first[1:])
    cuts = offsets[:-1]
    first[cuts[cuts < n]] = True
    starts = np.flatnonzero(solid & first)
    last = np.empty(n, dtype=bool)
    last[-1] = True
    np.logical_not(solid[1:], out=last[:-1])
    ends_at = offsets[1:] - 1
    last[ends_at[ends_at >= 0]] = True
    ends = np.flatnonzero(solid & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, in order. By sorting: numpy's own way, by a hash table, takes several times as long for numbers that are hashes."""
    s = np.sort(values)
    return s[np.append(True, s[1:] != s[:-1])] if len(s) else s


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of this width, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


def ragged_arange(lengths: np.ndarray) -> np.ndarray:
    """0..l-1 for each length l, concatenated."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Flags of the n places that some window [s, s + width) covers."""
    s = np.sort(starts)
    new = np.flatnonzero(s[1:] > s[:-1] + width) + 1  # windows that touch or overlap are one run
    step = np.zeros(n + 1, dtype=np.int8)
    if len(s):
        step[s[np.append(0, new)]] = 1
        step[np.minimum(s[np.append(new, len(s)) - 1] + width, n)] -= 1
    return np.cumsum(step[:-1], dtype=np.int8).view(bool)
