"""Packing of tokenised documents into sequences by exact complements, then best fit.

The plan is made on counts of lengths, of which there are at most ``capacity``; rows are dealt to the planned
places by their rank among the rows of their length. The plan's size follows the capacity, not the data.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opslake.llm.blocks import encoded
from opslake.llm.token_counts import BYTE_CHARS
from opslake.session import use_text_batches

#: Outside these, lower case, normal form or classes may differ from the library's; such texts go to it whole.
UNSURE = regex.compile(r"[^\x00-\u02FF\u2010-\u2027]")
SURE = sorted({x for c in (*range(0x300), *range(0x2010, 0x2028)) for x in (chr(c), *chr(c).lower())})
#: Fixed value: the pattern that splits text before the merges of the vocabulary with word ends.
PRETOKEN_SOURCE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same pattern over the sure characters, with its classes written out: the plainer matcher takes half the time.
PRETOKEN = re.compile(regex.sub(r"\\p\{.\}|\\s", lambda m: "".join(
    re.escape(c) for c in SURE if regex.match(m[0], c)), PRETOKEN_SOURCE))


class WordIds(dict):
    """Packed ids (little-endian unsigned 32 bit) of a lower-cased pre-token; starts anew when full."""

    def __init__(self, path: str, most: int):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = {c: np.array([i], "<u4").tobytes() for c, i in added.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, added)) + ")" if added else r"(?!)")

    def __missing__(self, pretoken: str) -> bytes:
        tokens = self.model.tokenize(pretoken.encode().decode("latin-1").translate(BYTE_CHARS))
        ids = np.array([t.id for t in tokens], "<u4").tobytes()
        if len(self) >= self.most:
            self.clear()
        self[pretoken] = ids
        return ids

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, text: str) -> bytes:
        if UNSURE.search(text):
            return self.library(text)
        if "<|" not in text:
            return b"".join(map(self.__getitem__, PRETOKEN.findall(text.lower())))
        return b"".join(self.special[part] if part in self.special
                        else b"".join(map(self.__getitem__, PRETOKEN.findall(part.lower())))
                        for part in self.split.split(text))


@lru_cache(maxsize=1)
def worker_ids(path: str, most: int) -> WordIds:
    """The cache of this worker process; it lives on from task to task."""
    return WordIds(path, most)


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, doc_id: str = "doc_id",
                  text: str = "text", cache_size: int = 300_000) -> DataFrame:
    """doc_id, piece, start, length, ids: every document's ids, cut into pieces of at most ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers; each document ends with ``end_id``, so a null or empty text
    is one piece of length 1. Repeated rows and null ids give their own pieces. Other columns are not read.
    """
    use_text_batches(docs.sparkSession)

    def encode(batches):
        ids_of, end = worker_ids(tokenizer, cache_size), np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            names, rows = batch.column(0), ([], [], [], [], [])
            for at, t in enumerate(encoded(batch.column(1))):
                ids = ids_of.of(t.decode("utf-8", "replace")) + end
                for piece, cut in enumerate(range(0, len(ids), step)):
                    part = ids[cut:cut + step]
                    for column, value in zip(rows, (at, piece, cut // 4, len(part) // 4, part)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()),
                 pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.binary())],
                ["doc_id", "piece", "start", "length", "ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(
        encode, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


class Plan:
    """Sequences as (times, lengths), made from counts of lengths.

    ``deep`` takes pairs and triples for exact complements besides single lengths.
    """

    def __init__(self, counts: dict[int, int], capacity: int, deep: bool = True):
        self.capacity, self.deep = capacity, deep
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.sequences: list[tuple[int, tuple[int, ...]]] = []
        self.rest: list[tuple[int, int]] = []
        self.fill_exactly()
        self.fit_rest()

    def take(self, lengths: tuple[int, ...]) -> None:
        """As many sequences of these lengths as there are rows for."""
        needs = {x: lengths.count(x) for x in lengths}
        times = min(int(self.left[x]) // n for x, n in needs.items())
        if times:
            for x, n in needs.items():
                self.left[x] -= times * n
            self.sequences.append((times, lengths))

    def pair(self, total: int, most: int) -> tuple[int, int] | None:
        """The pair a >= b with this sum and a <= most that has the largest a."""
        a = np.arange(min(most, total - 1), (total + 1) // 2 - 1, -1)
        if len(a):
            good = (self.left[a] > 0) & (self.left[total - a] > np.where(a == total - a, 1, 0))
            if good.any():
                a = int(a[np.argmax(good)])
                return a, total - a
        return None

    def complement(self, gap: int, most: int, sums: np.ndarray) -> tuple[int, ...] | None:
        """Lengths that fill the gap exactly: one, a pair or a triple."""
        if gap <= most and self.left[gap] > 0:
            return (gap,)
        if not self.deep:
            return None
        if found := self.pair(gap, most):
            return found
        firsts = np.arange(min(most, gap - 2), (gap + 2) // 3 - 1, -1)
        firsts = firsts[(self.left[firsts] > 0) & sums[gap - firsts]] if len(firsts) else firsts
        for a in firsts.tolist():
            self.left[a] -= 1
            found = self.pair(gap - a, a)
            self.left[a] += 1
            if found:
                return a, *found
        return None

    def pair_sums(self) -> np.ndarray:
        """Which sums some pair of available lengths had when this index was made."""
        has = (self.left > 0).astype(float)
        size = 2 * len(has)
        return np.fft.irfft(np.fft.rfft(has, size) ** 2, size)[:len(has)] > 0.5

    def fill_exactly(self) -> None:
        c = self.capacity
        if self.left[c]:
            self.take((c,))
        for length in range(c - 1, 0, -1):
            if not self.left[length]:
                continue
            sums = self.pair_sums()
            while self.left[length]:
                self.left[length] -= 1
                found = self.complement(c - length, length, sums)
                self.left[length] += 1
                if found is None:
                    break
                self.take((length, *found))
            if self.left[length]:
                self.rest.append((length, int(self.left[length])))
                self.left[length] = 0

    def fit_rest(self) -> None:
        """Best fit in decreasing order for what no exact combination took."""
        c = self.capacity
        open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
        gaps = np.zeros(c + 1, bool)

        def put(gap, times, lengths):
            if times:
                open_.setdefault(gap, []).append((times, lengths))
                gaps[gap] = True

        for length, n in self.rest:
            while n:
                fitting = np.flatnonzero(gaps[length:])
                if len(fitting):
                    gap = length + int(fitting[0])
                    times, lengths = open_[gap].pop()
                    used = min(times, n)
                    gaps[gap] = bool(open_[gap])
                    put(gap, times - used, lengths)
                    put(gap - length, used, (*lengths, length))
                    n -= used
                else:
                    each = min(c // length, n)
                    used = n // each
                    put(c - each * length, used, (length,) * each)
                    n -= used * each
        self.sequences += [x for group in open_.values() for x in group]

    @property
    def size(self) -> int:
        return sum(times for times, _ in self.sequences)

    def places(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By length: first rank of each run of places, the sequence of that rank, and the offset in it."""
        taken: dict[int, int] = {}
        out: dict[int, list[tuple[int, int, int]]] = {}
        base = 0
        for times, lengths in self.sequences:
            offset = 0
            for length in lengths:
                rank = taken.get(length, 0)
                out.setdefault(length, []).append((rank, base, offset))
                taken[length] = rank + times
                offset += length
            base += times
        return {k: tuple(np.array(v, np.int64).T) for k, v in out.items()}


def best_plan(counts: dict[int, int], capacity: int) -> Plan:
    """The smaller of two plans: pairs and triples fill more exactly, but may use up short lengths that long ones need."""
    return min((Plan(counts, capacity, deep) for deep in (True, False)), key=lambda plan: plan.size)


def pack(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "piece"),
         rows_per_share: int = 50_000) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``capacity``; the other columns stay.

    ``pieces`` is read twice and has to give the same rows each time: hand in a stored or checkpointed frame.
    Rows of equal length change places freely; ties in ``order`` are broken by nothing else, as any choice is
    valid within one run. An empty frame gives an empty one.
    """
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shares = max(1, sum(counts.values()) // rows_per_share)
    places = pieces.sparkSession.sparkContext.broadcast(best_plan(counts, capacity).places())
    dealt = pieces.withColumn("_share", F.pmod(F.xxhash64(*order), F.lit(shares)))
    before = dealt.groupBy("length", "_share").agg(F.count("*").alias("_n"))
    so_far = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("length", "_share", F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_share").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1).join(before, ["length", "_share"])
    names = pieces.columns
    ranked = ranked.select(*names, (F.col("_rank") + F.col("_before")).alias("_rank"))

    def deal(batches):
        for batch in batches:
            length = np.asarray(batch.column("length"))
            rank = np.asarray(batch.column("_rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length).tolist():
                at = np.flatnonzero(length == value)
                first, base, off = places.value[value]
                k = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at] = base[k] + rank[at] - first[k]
                offset[at] = off[k]
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)],
                                             [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(deal, f"{fields}, sequence_id bigint, offset bigint")
