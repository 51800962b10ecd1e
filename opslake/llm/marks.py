"""Marked stretches of documents: brought together by document and joined to the texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.blocks import covered

MARKS = "lot int, marks binary"
MARK = np.dtype([("k", "<i8"), ("h", "<i8"), ("start", "<i4"), ("count", "<i4")])
#: Candidates and marks share a shuffle: lots of marks are numbered from here in the bucket column.
FIRST_LOT = 1 << 20
LEAST = -(1 << 63)


def keyed(docs: DataFrame, doc_id: str, text: str, *more: str) -> DataFrame:
    """k, h, doc_id, text and ``more``: the id (a null is the smallest) and a hash of id and text name a document.

    Rows that repeat both id and text are one document under two rows.
    """
    return docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LEAST).cast("bigint")).alias("k"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("h"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        *more)


def rows_as(docs: DataFrame, name: str) -> DataFrame:
    """The frame with a column that holds the whole row."""
    return docs.withColumn(name, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))


def packed_marks(k: np.ndarray, h: np.ndarray, start: np.ndarray, lots: int) -> tuple[list[int], list[bytes]]:
    """Marked windows as runs (first start, count) of one document each, packed by lot; a document has one lot."""
    order = np.lexsort((start, h, k))
    k, h, start = k[order], h[order], start[order]
    head = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1]) | (start[1:] > start[:-1] + 1))[:len(k)])
    runs = np.empty(len(head), MARK)
    runs["k"], runs["h"], runs["start"] = k[head], h[head], start[head]
    runs["count"] = start[np.append(head, len(k))[1:] - 1] - start[head] + 1
    lot = runs["h"] % lots
    by = np.argsort(lot, kind="stable")
    cut = np.searchsorted(lot[by], np.arange(lots + 1))
    full = np.flatnonzero(np.diff(cut)).tolist()
    return full, [runs[by[cut[x]:cut[x + 1]]].tobytes() for x in full]


def mark_rows(k: np.ndarray, h: np.ndarray, start: np.ndarray, lots: int) -> pa.RecordBatch:
    lot, marks = packed_marks(k, h, start, lots)
    return pa.RecordBatch.from_arrays([pa.array(lot, pa.int32()), pa.array(marks, pa.binary())], ["lot", "marks"])


def settled_rows(k: np.ndarray, h: np.ndarray, start: np.ndarray, lots: int, columns: str) -> pa.RecordBatch:
    """Marks that are known before the shuffle of candidates, as rows of its columns: int, then binary ones."""
    lot, marks = packed_marks(k, h, start, lots)
    names = [c.split()[0] for c in columns.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([x + FIRST_LOT for x in lot], pa.int32()),
         *(pa.nulls(len(lot), pa.binary()) for _ in names[2:]), pa.array(marks, pa.binary())], names)


def passed_on(bucket: int, marks: pa.Scalar) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket - FIRST_LOT], pa.int32()), pa.array([marks.as_py()], pa.binary())], ["lot", "marks"])


def by_document(marks: DataFrame) -> DataFrame:
    """k, h, stretches: one row for each document with its (start, count) pairs as int32."""
    def merge(batches):
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for lot, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lot, []).append(part)
        for parts in held.values():
            runs = np.frombuffer(b"".join(parts), MARK)
            runs = runs[np.lexsort((runs["start"], runs["h"], runs["k"]))]
            k, h = runs["k"], runs["h"]
            head = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1])))
            pairs = np.stack([runs["start"], runs["count"]], axis=1)
            cuts = zip(head.tolist(), np.append(head[1:], len(runs)).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(k[head]), pa.array(h[head]), pa.array([pairs[a:b].tobytes() for a, b in cuts], pa.binary())],
                ["k", "h", "stretches"])

    return marks.repartition("lot").mapInArrow(merge, "k bigint, h bigint, stretches binary")


def with_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The keyed documents with their marks; null where there are none."""
    return docs.join(by_document(marks), ["k", "h"], "left")


def marked(size: int, stretches: bytes, window: int) -> np.ndarray:
    """Which places of a document lie in one of its marked windows."""
    start, count = np.frombuffer(stretches, np.int32).reshape(-1, 2).astype(np.int64).T
    return covered(size, start, count + window - 1)
