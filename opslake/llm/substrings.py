"""Removal of word windows that occur more than once, behind a count-min prefilter."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.blocks import Block, anchors, blocks, encoded, gather, runs, window_hash
from opslake.llm.marks import FIRST_LOT, MARKS, keyed, mark_rows, marked, passed_on, settled_rows, with_marks
from opslake.llm.sketch import count_min, seen_twice

PART = "bucket int, anchors binary, owners binary, starts binary, counts binary, windows binary, marks binary"


def anchored(block: Block, window: int):
    """Windows of a block: word hashes, starts of whole windows, and the place of each one's anchor.

    The anchor of a window is its smallest hash of half as many words, so it stays the same wherever the window
    stands, and neighbours mostly share it.
    """
    words = block.words()
    hashes = words.hashes()
    gram = (window + 1) // 2
    grams = window_hash(hashes, gram)
    start = np.flatnonzero(words.whole(window))
    place = anchors(grams, window - gram + 1)[start] if len(start) else start
    return words, hashes, grams, start, place


def anchor_keys(window: int):
    def keys(block: Block) -> np.ndarray:
        _, _, grams, _, place = anchored(block, window)
        return grams[np.unique(place)]

    return keys


def repeated_windows(docs: DataFrame, window: int, bits: int, buckets: int) -> DataFrame:
    """Marks of every window whose words also start elsewhere.

    The sketch holds anchors: two places of a window are two places of its anchor, so the estimate of the anchor is
    never below that of the window. Windows that pass are grouped exactly, by 64 bits of the anchor and 64 independent
    bits of the window. Equal windows of a block are settled there and sent on once, so a hot passage comes once from
    each block, not once from each document.
    """
    shared = count_min(docs, "text", anchor_keys(window), bits)

    def candidates(batches):
        for batch, block in blocks(batches):
            words, hashes, grams, start, place = anchored(block, window)
            passed = seen_twice(shared.value, grams[place], bits) if len(place) else np.zeros(0, bool)
            start, key = start[passed], grams[place[passed]]
            whole = window_hash(hashes, window, salt=0x5BD1E995)[start] if len(start) else np.zeros(0, np.uint64)
            # Settle what repeats within the block.
            order = np.lexsort((start, whole, key))
            new = np.append(True, (key[order][1:] != key[order][:-1]) | (whole[order][1:] != whole[order][:-1]))
            group = np.cumsum(new[:len(order)]) - 1
            times = np.bincount(group, minlength=1)[group] if len(order) else group
            settled, first = np.zeros(len(order), bool), np.zeros(len(order), bool)
            settled[order] = times > 1
            first[order] = new[:len(order)]
            k, h = (np.asarray(batch.column(i)) for i in (0, 1))
            doc = words.doc[start] if len(start) else start
            local = start - words.first[doc]
            yield settled_rows(k[doc[settled]], h[doc[settled]], local[settled], buckets, PART)
            # Send each window once; neighbours with one anchor make a stretch. No reply is needed for settled ones.
            send = np.flatnonzero(first)
            joined = np.zeros(len(send), bool)
            joined[1:] = ((start[send][1:] == start[send][:-1] + 1) & (key[send][1:] == key[send][:-1])
                          & (settled[send][1:] == settled[send][:-1]) & (doc[send][1:] == doc[send][:-1]))
            head = np.flatnonzero(~joined)
            size = np.diff(np.append(head, len(send)))
            at = send[head]
            owners = np.stack([k[doc[at]], h[doc[at]], (~settled[at]).astype(np.int64)], axis=1)
            bucket = (key[at] % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            out = []
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                pick = by[cuts[b]:cuts[b + 1]]
                out.append((b, key[at[pick]].tobytes(), owners[pick].tobytes(), local[at[pick]].astype(np.int32).tobytes(),
                            size[pick].astype(np.int32).tobytes(), whole[send[gather(head[pick], size[pick])]].tobytes(),
                            None))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                    ["bucket", "anchors", "owners", "starts", "counts", "windows", "marks"])

    def group(batches):
        parts = ([], [], [], [], [])
        for batch in batches:
            for i in range(batch.num_rows):
                if (bucket := batch.column(0)[i].as_py()) >= FIRST_LOT:
                    yield passed_on(bucket, batch.column(6)[i])
                    continue
                for part, column, kind in zip(parts, range(1, 6), (np.uint64, np.int64, np.int32, np.int32, np.uint64)):
                    part.append(np.frombuffer(batch.column(column)[i].as_py(), kind))
        if not parts[0]:
            return
        key, owner, start, count, whole = map(np.concatenate, parts)
        owner = owner.reshape(-1, 3)
        stretch = np.repeat(np.arange(len(key)), count)
        at = start[stretch] + np.arange(len(stretch)) - np.repeat(np.cumsum(count) - count, count)
        order = np.lexsort((whole, key[stretch]))
        a, w = key[stretch][order], whole[order]
        new = np.append(True, (a[1:] != a[:-1]) | (w[1:] != w[:-1]))
        run = np.cumsum(new) - 1
        again = np.zeros(len(order), bool)
        again[order] = np.bincount(run)[run] > 1
        again &= owner[stretch, 2] == 1
        for lot in np.array_split(np.flatnonzero(again), max(1, again.sum() // 500_000)):
            yield mark_rows(owner[stretch[lot], 0], owner[stretch[lot], 1], at[lot], buckets)

    sent = docs.select("k", "h", "text").mapInArrow(candidates, PART)
    return sent.repartition("bucket").mapInArrow(group, MARKS)


def remove_repeats(docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text", bits: int = 27
                   ) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text: texts without the words of windows that also start anywhere else.

    Words are runs without ASCII white space; kept words are joined by one space. Windows are judged on the input. A
    null or empty text has no words and an empty kept text. Repeated rows are documents of their own, so their windows
    repeat. A null id is kept. Other columns are not read. ``bits`` sizes the sketch: 2 * 2**bits bits are shared.
    """
    spark = docs.sparkSession
    buckets = max(8, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = keyed(docs, doc_id, text)
    marks = repeated_windows(named, window, bits, buckets)

    def remove(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for t, parts in zip(encoded(batch.column(1)), batch.column(2).to_pylist()):
                words = t.split()
                n_words.append(len(words))
                if parts:
                    gone = marked(len(words), parts, window)
                    n_removed.append(int(gone.sum()))
                    words = [w for a, b in zip(*runs(~gone)) for w in words[a:b]]
                else:
                    n_removed.append(0)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return with_marks(named, marks).select("doc_id", "text", "stretches").mapInArrow(
        remove, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_text string")
