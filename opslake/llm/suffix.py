"""Removal of byte strings that also start earlier, by a column-wise Burrows-Wheeler transform of many segments.

Strings of ``length`` bytes can only be equal if their anchors are: the smallest hash of ``GRAM`` bytes inside. A shared
filter drops anchors that occur once. Around each other anchor lies a segment: the bytes of all strings that have it.
The segments of a bucket are laid out with their anchors in one column, so equal strings start in the same column.
Then, from the last column to the first, one symbol of every segment is inserted: a stable sort by that symbol turns the
order of the suffixes right of it into the order of the suffixes that begin with it, which is what an insertion into
the collection's transform does, and common prefixes follow as one more than the least between the old neighbours. Where
a common prefix reaches ``length``, neighbours begin with the same string, and all but the earliest are marked.
Equal segments of a bucket are one segment of the collection, the earliest; those that are alone with their anchor are
left out. Columns are sequential files that are written once and read once.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.blocks import (
    BLOCK_BYTES, Block, anchors, blocks, encoded, gather, packed, prefix_hash, runs, span_hash, unpacked, window_hash)
from opslake.llm.marks import FIRST_LOT, MARKS, keyed, mark_rows, marked, rows_as, settled_rows, with_marks
from opslake.llm.sketch import count_min, seen_twice

GRAM = 36
#: Stands for "no symbol here"; no byte of UTF-8 has this value.
NONE = 255
PART = "bucket int, owners binary, places binary, bytes binary, marks binary"
#: Whole buckets are taken together up to about so many segments.
SEGMENTS = 50_000


def anchored(block: Block, length: int):
    """Starts of the strings of a block, their anchors, and the hash of every gram."""
    grams = window_hash(block.data, GRAM)
    n = len(block.data) - length + 1
    if n <= 0:
        return grams, np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = block.docs()
    start = np.flatnonzero((doc[:n] == doc[length - 1:]) & (np.arange(n) + length <= block.ends[doc[:n]]))
    return grams, start, anchors(grams, length - GRAM + 1)[start]


def anchor_keys(length: int):
    def keys(block: Block) -> np.ndarray:
        grams, _, place = anchored(block, length)
        return grams[place[np.append(True, place[1:] != place[:-1])]] if len(place) else np.zeros(0, np.uint64)

    return keys


def column_classes(columns: list[np.ndarray] | "ColumnFiles", rank: np.ndarray, lead: int, length: int) -> np.ndarray:
    """For each segment and start column 0..lead, whether an equal string of an earlier rank starts there.

    ``columns`` gives the symbols of all segments by column; ``rank`` orders the segments. Strings that leave their
    segment hold NONE and are only equal to others that do.
    """
    n = len(rank)
    order, common = np.arange(n), np.zeros(n + 1, np.int32)
    earlier = np.zeros((lead + 1, n), bool)
    for c in range(lead + length - 1, -1, -1):
        symbols = columns[c][order]
        turn = np.argsort(symbols, kind="stable")
        order, sorted_ = order[turn], symbols[turn]
        reach = np.empty(2 * n, np.int64)
        reach[0::2] = np.append(0, turn[:-1] + 1)
        reach[1::2] = turn + 1
        least = np.minimum.reduceat(common, reach)[0::2]
        fresh = np.zeros(n + 1, np.int32)
        fresh[1:n] = np.where(sorted_[1:] == sorted_[:-1], np.minimum(least[1:] + 1, length), 0)
        common = fresh
        if c <= lead:
            head = np.flatnonzero(common[:n] < length)
            first = np.minimum.reduceat(rank[order], head)
            earlier[c, order] = rank[order] > np.repeat(first, np.diff(np.append(head, n)))
    return earlier


class ColumnFiles:
    """Segments in, one sequential file for each column out; the folder goes with the object."""

    def __init__(self, width: int):
        self.folder = tempfile.TemporaryDirectory()
        self.files = [open(os.path.join(self.folder.name, str(c)), "wb") for c in range(width)]

    def add(self, rows: np.ndarray) -> None:
        for file, column in zip(self.files, np.ascontiguousarray(rows.T)):
            column.tofile(file)

    def close_for_reading(self) -> None:
        for file in self.files:
            file.close()

    def __getitem__(self, c: int) -> np.ndarray:
        return np.fromfile(os.path.join(self.folder.name, str(c)), np.uint8)


def lots(sizes: np.ndarray, most: int = BLOCK_BYTES) -> list[np.ndarray]:
    """Segments by number, in parts of about so many bytes."""
    return np.array_split(np.arange(len(sizes)), max(1, int(sizes.sum()) // most))


def merged(body: np.ndarray, place: np.ndarray, rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each segment the earliest equal one, and which of these share their anchor with another one.

    ``body`` holds the segments' bytes in turn, ``place`` their start, first column and number of strings; ``rank`` orders
    them. Segments are equal if their columns and bytes are.
    """
    lead = length - GRAM
    sizes = place[:, 2] + length - 1
    begin = np.cumsum(sizes) - sizes
    whole, anchor = np.empty(len(place), np.uint64), np.empty(len(place), np.uint64)
    for lot in lots(sizes):
        a = begin[lot] - begin[lot[0]]
        prefix = prefix_hash(body[begin[lot[0]]:begin[lot[-1]] + sizes[lot[-1]]])
        whole[lot] = span_hash(prefix, a, a + sizes[lot])
        at = a + lead - place[lot, 1]
        anchor[lot] = span_hash(prefix, at, at + GRAM)
    order = np.lexsort((rank, whole, place[:, 2], place[:, 1]))
    same = np.append(False, (whole[order[1:]] == whole[order[:-1]]) & (place[order[1:], 1:] == place[order[:-1], 1:]).all(axis=1))
    for lot in lots(np.where(same, sizes[order], 0)):
        later = lot[same[lot]]
        if len(later):
            size = sizes[order[later]]
            equal = body[gather(begin[order[later]], size)] == body[gather(begin[order[later - 1]], size)]
            same[later] = np.logical_and.reduceat(equal, np.cumsum(size) - size)
    first = np.empty(len(order), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    lone = order[~same]
    _, which, times = np.unique(anchor[lone], return_inverse=True, return_counts=True)
    return first, np.sort(lone[times[which] > 1])


def repeated_strings(docs: DataFrame, length: int, bits: int, buckets: int) -> DataFrame:
    """Marks of every string that also starts earlier."""
    shared = count_min(docs, "text", anchor_keys(length), bits)
    lead = length - GRAM

    def segments(batches):
        for batch, block in blocks(batches):
            grams, start, place = anchored(block, length)
            passed = seen_twice(shared.value, grams[place], bits) if len(place) else np.zeros(0, bool)
            start, place = start[passed], place[passed]
            if not len(start):
                continue
            head = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)))
            count = np.diff(np.append(head, len(start)))
            s, a = start[head], place[head]
            column = s - a + lead
            doc = np.searchsorted(block.ends, s)
            k, h = (np.asarray(batch.column(i)) for i in (0, 1))
            # Segments that repeat within the block: the earliest goes on for all, the others are marked whole.
            same = span_hash(prefix_hash(block.data), s, s + count + length - 1, salt=0x5BD1E995)
            same ^= (column * 256 + count).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            order = np.lexsort((s, h[doc], k[doc], same, grams[a]))
            new = np.append(True, (np.diff(same[order]) != 0) | (np.diff(grams[a][order]) != 0))
            owner = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            # A repeated row has the same place as its twin and is no earlier or later copy of it.
            twin = (k[doc[order]] == k[doc[owner]]) & (h[doc[order]] == h[doc[owner]]) & (
                s[order] - block.starts[doc[order]] == s[owner] - block.starts[doc[owner]])
            late = order[~new & ~twin]
            at = gather(s[late], count[late])
            d = np.repeat(doc[late], count[late])
            yield settled_rows(k[d], h[d], at - block.starts[d], buckets, PART)
            pick = np.sort(order[new])
            bucket = (grams[a[pick]] % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            i, bucket = pick[by], bucket[by]
            cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(i))
            size = count[i] + length - 1
            owners = np.stack([k[doc[i]], h[doc[i]]], axis=1)
            places = np.stack([s[i] - block.starts[doc[i]], column[i], count[i]], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts[:-1]], pa.int32()), packed(owners, cuts), packed(places, cuts),
                 packed(block.data[gather(s[i], size)], np.append(0, np.cumsum(size))[cuts]),
                 pa.nulls(len(cuts) - 1, pa.binary())], ["bucket", "owners", "places", "bytes", "marks"])

    def transformed(parts):
        owner = np.concatenate([unpacked(p.column(1), np.int64) for p in parts]).reshape(-1, 2)
        place = np.concatenate([unpacked(p.column(2), np.int32) for p in parts]).reshape(-1, 3).astype(np.int64)
        body = np.concatenate([unpacked(p.column(3), np.uint8) for p in parts])
        # Rank of a segment: its document, then where its anchor stands; equal for the twins of repeated rows.
        anchor = place[:, 0] - place[:, 1]
        by = np.lexsort((anchor, owner[:, 1], owner[:, 0]))
        step = np.any(np.diff(np.stack([owner[by, 0], owner[by, 1], anchor[by]]), axis=1) != 0, axis=0)
        rank = np.empty(len(by), np.int64)
        rank[by] = np.append(0, np.cumsum(step))
        first, kept = merged(body, place, rank, length)
        late = np.flatnonzero(rank != rank[first])
        for lot in lots(place[late, 2]):
            i = late[lot]
            d = np.repeat(i, place[i, 2])
            yield mark_rows(owner[d, 0], owner[d, 1], gather(place[i, 0], place[i, 2]), buckets)
        if not len(kept):
            return
        size = place[:, 2] + length - 1
        begin = np.cumsum(size) - size
        files = ColumnFiles(lead + length)
        with files.folder:
            for lot in lots(size[kept]):
                i = kept[lot]
                rows = np.full((len(i), lead + length), NONE, np.uint8)
                flat = gather(np.arange(len(i)) * rows.shape[1] + place[i, 1], size[i])
                rows.reshape(-1)[flat] = body[gather(begin[i], size[i])]
                files.add(rows)
            files.close_for_reading()
            earlier = column_classes(files, rank[kept], lead, length)
        for lot in np.array_split(np.arange(len(kept)), max(1, len(kept) // 50_000)):
            column, i = np.nonzero(earlier[:, lot])
            i = kept[lot[i]]
            inside = (column >= place[i, 1]) & (column < place[i, 1] + place[i, 2])
            i, column = i[inside], column[inside]
            yield mark_rows(owner[i, 0], owner[i, 1], place[i, 0] + column - place[i, 1], buckets)

    def transform(batches):
        parts, n, last = [], 0, None
        for batch in batches:
            bucket = np.asarray(batch.column(0))
            settled = bucket >= FIRST_LOT
            if settled.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[settled] - FIRST_LOT, pa.int32()), batch.column(4).filter(pa.array(settled))],
                    ["lot", "marks"])
                # Buckets come in order, so lots of marks are behind them.
                batch = batch.slice(0, int(settled.argmax()))
                bucket = bucket[:batch.num_rows]
            head = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[:len(bucket)])
            for a, b in zip(head.tolist(), np.append(head[1:], len(bucket)).tolist()):
                if n >= SEGMENTS and bucket[a] != last:
                    yield from transformed(parts)
                    parts, n = [], 0
                part, last = batch.slice(a, b - a), bucket[a]
                parts.append(part)
                n += len(unpacked(part.column(2), np.int32)) // 3
        if parts:
            yield from transformed(parts)

    sent = docs.select("k", "h", "text").mapInArrow(segments, PART)
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(transform, MARKS)


def remove_earlier(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text", bits: int = 27
                   ) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans, kept: bytes without those of strings that also start earlier.

    Earlier means a smaller id, or an earlier start in the same document. Rows with one id but other texts are ordered by
    a hash; rows that repeat id and text are one document and get the same result; a null id is the smallest. A null or
    empty text has nothing to remove. ``spans`` are the removed (start, end) in bytes; ``kept`` are the other bytes, which
    may cut a character. Other columns are not read. ``bits`` sizes the sketch: 2 * 2**bits bits are shared.
    """
    def remove(batches):
        for batch in batches:
            sizes, n_removed, spans, kept = [], [], [], []
            for t, parts in zip(encoded(batch.column(1)), batch.column(2).to_pylist()):
                gone = marked(len(t), parts, length) if parts else np.zeros(0, bool)
                sizes.append(len(t))
                n_removed.append(int(gone.sum()))
                spans.append([{"start": a, "end": b} for a, b in zip(*(x.tolist() for x in runs(gone)))])
                kept.append(b"".join(t[a:b] for a, b in zip(*runs(~gone))) if parts else t)
            stretch = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array([len(x) for x in spans], pa.int64()), pa.array(spans, stretch), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    kind = docs.schema[doc_id].dataType.simpleString()
    named = keyed(docs, doc_id, text)
    return marked_texts(named, length, bits).select("doc_id", "text", "stretches").mapInArrow(
        remove, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                "spans array<struct<start:bigint,end:bigint>>, kept binary")


def marked_texts(named: DataFrame, length: int, bits: int) -> DataFrame:
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    buckets = max(8, 4 * int(named.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return with_marks(named, repeated_strings(named, length, bits, buckets))


def cut_texts(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text", bits: int = 27
              ) -> DataFrame:
    """The rows of ``docs`` with all columns and the same removal done in ``text``.

    Bytes of a character that a cut leaves in part are dropped too. A null text stays null, and a text of which nothing is
    left is empty.
    """
    def cut(batches):
        for batch in batches:
            kept = []
            for t, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if parts:
                    data = t.encode()
                    left = runs(~marked(len(data), parts, length))
                    t = b"".join(data[a:b] for a, b in zip(*left)).decode("utf-8", "ignore")
                kept.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], ["_row", "_kept"])

    named = keyed(rows_as(docs, "_row"), doc_id, text, "_row")
    done = marked_texts(named, length, bits).select("_row", "text", "stretches").mapInArrow(
        cut, f"_row {named.schema['_row'].dataType.simpleString()}, _kept string")
    return done.select(*[F.col("_kept").alias(c) if c == text else F.col(f"_row.`{c}`") for c in docs.columns])
