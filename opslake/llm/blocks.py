"""Texts of an Arrow batch as one byte array, with vectorised word splitting and rolling hashes.

Documents are joined by a line feed, so no word or window crosses a document. All hashes are
polynomials modulo 2**64 whose windows come from prefix sums, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the longest table so far is kept."""
    table = _powers.get(int(base))
    if table is None or len(table) < n:
        table = np.full(max(n, 1 << 16), base, np.uint64)
        table[0] = 1
        table = _powers[int(base)] = np.cumprod(table)
    return table[:n]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    h = h ^ np.uint64(salt)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running polynomial; ``span_hash`` takes differences of it."""
    n = len(values)
    out = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of values[start:end]; equal content gives equal hashes wherever it stands."""
    return mix((prefix[end] - prefix[start]) * powers(INVERSE, len(prefix))[start], salt)


def window_hash(values: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of every window of so many values, by its start."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    prefix = prefix_hash(values)
    return mix((prefix[size:] - prefix[:n]) * powers(INVERSE, n), salt)


class Block:
    """Some documents: ``data`` is their bytes, each followed by a line feed."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes + 1) - 1
        self.starts = self.ends - self.sizes
        self.data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)

    def docs(self) -> np.ndarray:
        """Document number of every byte."""
        return np.repeat(np.arange(len(self.texts)), self.sizes + 1)

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """Sum over the bytes of every document."""
        return np.add.reduceat(per_byte.astype(np.int64), self.starts)

    def words(self, lower: bool = False) -> "Words":
        return Words(self, lower)


class Words:
    """Words of a block: maximal runs of bytes that are not ASCII white space."""

    def __init__(self, block: Block, lower: bool):
        self.data = LOWER[block.data] if lower else block.data
        white = WHITE[self.data]
        edge = np.diff(white.astype(np.int8), prepend=np.int8(1))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        self.end = self.end[self.end > 0][: len(self.start)]
        self.count = np.diff(np.searchsorted(self.start, np.append(block.starts, len(self.data))))
        self.first = np.cumsum(self.count) - self.count
        self.doc = np.repeat(np.arange(len(block.texts)), self.count)
        self.white = white

    def hashes(self, salt: int = 0) -> np.ndarray:
        return span_hash(prefix_hash(self.data), self.start, self.end, salt)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def whole(self, size: int) -> np.ndarray:
        """Which starts have a whole window of so many words in their document."""
        n = len(self.start) - size + 1
        return self.doc[:n] == self.doc[size - 1:] if n > 0 else np.zeros(0, bool)


def covered(n: int, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
    """Which of n places lie in one of the given windows."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + sizes, -1)
    return np.cumsum(steps[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.diff(flags.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def encoded(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text; a null is an empty text."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = BLOCK_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Slices of the batches of about ``most`` bytes of text; one longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        share = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            yield part, Block(encoded(part.column(column)))


def anchors(h: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` consecutive hashes the place of its smallest one, the leftmost of equals.

    Equal runs choose the same relative place, so equal windows of text meet on the hash found there.
    """
    if len(h) < width:
        return np.zeros(0, np.int64)
    mask = np.uint64((1 << len(h).bit_length()) - 1)
    least = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size < width:
        step = min(size, width - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    return (least & mask).astype(np.int64)


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of the given stretches, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The stretches of ``values`` between the cuts, first to last, as binary values."""
    values = np.ascontiguousarray(values)
    offsets = (np.asarray(cuts) * values.strides[0]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """The bytes of binary values without nulls, one after the other, as numbers."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]].view(kind)
