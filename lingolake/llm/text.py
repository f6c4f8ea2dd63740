"""Array kernels over whole texts: words, word hashes, window hashes.

A *word* is a run of bytes that are not ASCII white space (x20, x09-x0D), which is the same as the
code-point pattern ``[^\\x20\\x09-\\x0D]+``.  Everything here works on an Arrow string column as one byte
buffer, so that no Python object is made per word.  Nulls count as empty texts.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Texts are worked on in pieces of about so many bytes (a longer text is a piece of its own).
PIECE = 1 << 20


@lru_cache(maxsize=256)
def _random(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def drawn() -> int:
    """A seed that nobody can know beforehand, to be drawn on the driver once a run: texts can't be made to collide under it."""
    return int.from_bytes(os.urandom(8), "little")


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: For n bytes of a block of eight: a mask of them.
MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class ByteHash:
    """64-bit hashes of byte segments of a buffer.

    A segment is cut into halves of blocks of eight bytes; each pair of halves is added to a pair of random numbers of its
    own and multiplied, and the products are summed modulo 2**64 (a universal family: two segments have equal upper
    halves of the sum with probability 2**-32 over the choice of the seed, whatever they hold).  Two independent sums give
    the 64 bits.  The numbers come from the seed, one for each place, so there is no power series that texts could cancel.
    """

    def __init__(self, seed: int, lower: bool = False):
        self.seed, self.lower = seed, lower
        self.parts = [np.zeros((0, 2), np.uint64)] * 2
        self.base = _random(seed, 4)
        self._grow(9)

    def _grow(self, blocks: int) -> None:
        if len(self.parts[0]) < blocks:
            blocks = max(blocks, 2 * len(self.parts[0]))
            # a longer stream of a seed begins with the shorter one
            self.parts = [_random((self.seed + 1 + i) & (1 << 64) - 1, 2 * blocks).reshape(-1, 2) for i in (0, 1 << 32)]

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(starts)
        if not n:
            return np.zeros(0, np.uint64)
        padded = np.zeros(len(data) + 8, np.uint8)
        np.take(LOWER, data, out=padded[: len(data)]) if self.lower else np.copyto(padded[: len(data)], data)
        at_any = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
        size = ends - starts
        one, two = (self.base[i] + self.base[i + 2] * size.astype(np.uint64) for i in (0, 1))
        half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
        rows, block = None, 0
        while block < 8:
            left, begin = (size, starts) if rows is None else (size[rows] - 8 * block, starts[rows] + 8 * block)
            value = at_any[begin] & MASK[np.minimum(left, 8)]
            a, b = value & low, value >> half
            for total, m in ((one, self.parts[0][block]), (two, self.parts[1][block])):
                product = (a + m[0]) * (b + m[1])
                if rows is None:
                    total += product
                else:
                    total[rows] += product
            block += 1
            rows = np.flatnonzero(size > 8 * block) if rows is None else rows[size[rows] > 8 * block]
            if not len(rows):
                break
        else:
            # the few long ones, each at once
            self._grow(int(size[rows].max()) // 8 + 1)
            for i in rows.tolist():
                value = at_any[starts[i] + 64 : ends[i] : 8].copy()
                value[-1] &= MASK[(size[i] - 1) % 8 + 1]
                a, b = value & low, value >> half
                for total, m in ((one, self.parts[0]), (two, self.parts[1])):
                    m = m[8 : 8 + len(value)]
                    total[i : i + 1] += ((a + m[:, 0]) * (b + m[:, 1])).sum(dtype=np.uint64)
        return mix((one & ~low) | (two >> half))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, where, data = column.buffers()
    if not len(column) or where is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, which bounds what the kernels hold."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(buffers(batch.column(batch.schema.get_field_index(column)))[1])
        begin, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > most:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        yield batch.slice(begin)
    _give_back()


def _give_back() -> None:
    """Returns free memory to the system at the end of a task: a Python worker lives on for the next one."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


class Words:
    """Words of a column: ``starts``/``ends`` are byte positions, ``doc`` has n + 1 word offsets by text."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = buffers(column)
        n = len(self.data)
        solid = ~SPACE[self.data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        inner = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        first[inner] |= solid[inner]
        last[inner - 1] |= solid[inner - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.doc)
        self.solid = solid

    def owner(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, k: int) -> np.ndarray:
        """Index of the first word of each run of k words of one text."""
        ok = np.zeros(len(self.starts), bool)
        if len(ok) >= k:
            ok[: len(ok) - k + 1] = True
            for j in range(1, k):
                at = self.doc[1:] - j
                ok[at[(at >= 0) & (at >= self.doc[:-1])]] = False
        return np.flatnonzero(ok)

    def bytes_of(self, i: int) -> bytes:
        """Text i's words, joined by one space."""
        a, b = self.doc[i], self.doc[i + 1]
        return b" ".join(self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().split()) if b > a else b""


def rolled(hashes: np.ndarray, k: int, seed: int) -> np.ndarray:
    """A hash of each run of k values, by its first one; runs at the very end are left out."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, c in enumerate(_random(seed, k) | np.uint64(1)):
        out += hashes[j : j + n] * c
    return mix(out)
