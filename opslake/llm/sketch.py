"""Filter of the hashed keys that occur twice or more: counted exactly by slice, shared at a fixed size."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from opslake.llm.blocks import Block, blocks, mix, packed, unpacked

#: Odd multipliers of the rows.
ROWS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Keys are counted in 2**SLICE_BITS slices, by their first bits and 32 more.
SLICE_BITS = 8


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (keys * np.uint64(ROWS[row]) >> np.uint64(64 - bits)).astype(np.int64)


def slice_bits(bits: int) -> int:
    """First bits of a key that name its slice; a slice of a bitmap has a byte at least."""
    return min(SLICE_BITS, max(0, bits - 3))


def shortened(keys: np.ndarray, bits: int) -> np.ndarray:
    """Slice and 32 more bits of a key; keys are mixed anew, as anchors are mostly small numbers."""
    return mix(keys) >> np.uint64(32 - slice_bits(bits))


def seen_twice(bitmaps: list[np.ndarray], keys: np.ndarray, bits: int) -> np.ndarray:
    """Keys that pass the filter; never misses one that occurred twice."""
    lead = slice_bits(bits)
    short = shortened(keys, bits)
    at = (short >> np.uint64(32)).astype(np.int64) << (bits - lead)
    out = np.ones(len(keys), bool)
    for row, bitmap in enumerate(bitmaps):
        cell = at + cells(short << np.uint64(32 - lead), row, bits - lead)
        out &= (bitmap[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return out


def opened(slices: list[list[bytes]]) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(map(zlib.decompress, row)), np.uint8) for row in slices]


class Packed:
    """Bitmaps in compressed slices, so that the driver holds and sends few bytes; whoever receives them has plain arrays."""

    def __init__(self, slices: list[list[bytes]]):
        self.slices = slices

    def __reduce__(self):
        return opened, (self.slices,)


def count_min(docs: DataFrame, text: str, keys_of: Callable[[Block], np.ndarray], bits: int) -> Broadcast:
    """Bitmaps, one for each row, in which the cells of every key that occurs twice or more are set.

    ``keys_of`` gives the keys of a block of texts, one for each occurrence. Keys that occur once leave no trace, so the bitmaps
    fill with the number of keys that repeat, not with the length of the texts. What is shared has len(ROWS) * 2**bits bits at
    most, whatever the input; runs of empty cells take little. The first bits of a key name its slice and 32 more are sent,
    twice at most from a block. A task holds one slice at a time, in order.
    """
    lead = slice_bits(bits)
    slices, width = 1 << lead, 1 << bits - lead

    def partial(batches):
        for _, block in blocks(batches, text):
            keys = np.sort(shortened(keys_of(block), bits))
            keys = keys[np.append(np.ones(min(2, len(keys)), bool), keys[2:] != keys[:-2])]
            cuts = np.searchsorted(keys, np.arange(slices + 1).astype(np.uint64) << np.uint64(32))
            full = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), packed(keys.astype(np.uint32), np.append(cuts[full], len(keys)))],
                ["slice", "keys"])

    def bitmaps_of(s: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.sort(np.concatenate(parts))
        again = np.unique(keys[1:][keys[1:] == keys[:-1]]).astype(np.uint64) | np.uint64(s << 32)
        out = []
        for row in range(len(ROWS)):
            bitmap = np.zeros(width, bool)
            bitmap[cells(again << np.uint64(32 - lead), row, bits - lead)] = True
            out.append(zlib.compress(np.packbits(bitmap), 1))
        return pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([out])], ["slice", "bits"])

    def merge(batches):
        at, parts = None, []
        for batch in batches:
            slot = np.asarray(batch.column(0))
            head = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])[:len(slot)])
            for a, b in zip(head.tolist(), np.append(head[1:], len(slot)).tolist()):
                if parts and slot[a] != at:
                    yield bitmaps_of(at, parts)
                    parts = []
                at = int(slot[a])
                parts.append(unpacked(batch.column(1).slice(a, b - a), np.uint32))
        if parts:
            yield bitmaps_of(at, parts)

    sent = docs.select(text).mapInArrow(partial, "slice int, keys binary")
    merged = sent.repartition("slice").sortWithinPartitions("slice").mapInArrow(merge, "slice int, bits array<binary>")
    empty = zlib.compress(bytes(width // 8 or 1), 1)
    bitmaps = [[empty] * slices for _ in ROWS]
    for r in merged.collect():
        for row, part in zip(bitmaps, r.bits):
            row[r.slice] = bytes(part)
    return docs.sparkSession.sparkContext.broadcast(Packed(bitmaps))
