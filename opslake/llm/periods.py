"""Maximal periodic runs of words, found on a harmonic grid and measured on a recompressed grammar.

Recompression alternates two steps. Block compression replaces a maximal stretch of one symbol by a symbol for (symbol,
times); pair compression deals the symbols into left and right ones and replaces each left symbol before a right one by a
symbol for the pair. Both look at the symbols only, so equal texts are cut alike wherever they stand, and how far two
places agree shows in a few symbols a level. The sequence of every level is kept, so all lookups of a block of documents
are made together.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm.blocks import blocks, covered, mix

#: Candidates whose extensions are looked up together.
TOGETHER = 500_000
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


@dataclass
class Level:
    """Symbols of one level and how the next one groups them: its element of each symbol, and its first symbol and size."""

    symbols: np.ndarray
    up: np.ndarray | None = None
    first: np.ndarray | None = None
    size: np.ndarray | None = None

    def mirrored(self) -> "Level":
        if self.up is None:
            return Level(self.symbols[::-1])
        return Level(self.symbols[::-1], (len(self.first) - 1 - self.up)[::-1],
                     (len(self.symbols) - self.first - self.size)[::-1], self.size[::-1])


def numbered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each (a, b), the same for equal ones."""
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    out = np.empty(len(a), np.int64)
    out[order] = np.cumsum(np.append(False, (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
    return out


def grouped(symbols: np.ndarray, head: np.ndarray, second: np.ndarray | None = None) -> tuple[Level, np.ndarray]:
    """The level with its groups, which begin at ``head``, and the next level's symbols: one for each (first symbol, size),
    or for each (first symbol, ``second``)."""
    first = np.flatnonzero(head)
    level = Level(symbols, np.cumsum(head) - 1, first, np.diff(np.append(first, len(symbols))))
    return level, numbered(symbols[first], level.size if second is None else second[first])


class Grammar:
    """Run-length grammar of a sequence of symbols whose first and last occur nowhere else."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[Level] = []
        salt = 0
        while len(np.unique(symbols)) < len(symbols):
            # Blocks: groups of one symbol, told apart by their size.
            level, symbols = grouped(symbols, np.append(True, symbols[1:] != symbols[:-1]))
            self.levels.append(level)
            # Pairs: -1 stands for a symbol that stays alone. The side of a symbol is a bit of its hash.
            salt += 1
            right = mix(symbols.astype(np.uint64), salt * 0x9E3779B97F4A7C15 % (1 << 64)) >> np.uint64(63) == 1
            pair = ~right[:-1] & right[1:]
            level, symbols = grouped(symbols, np.append(True, ~pair), np.append(np.where(pair, symbols[1:], -1), -1))
            self.levels.append(level)
        self.levels.append(Level(symbols))
        self.mirror = [level.mirrored() for level in self.levels]

    def after(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols from x on equal those from y on; x and y differ."""
        return agreement(self.levels, x, y)

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols before x equal those before y; both are above 0."""
        last = len(self.levels[0].symbols) - 1
        return agreement(self.mirror, last - (x - 1), last - (y - 1))


def agreement(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the common stretch from x and from y, by climbing to the first level that shows a difference and back.

    While neither place is inside a group, both climb. Inside one, the rest of the group is compared first: of a block
    the shorter rest, of a pair one symbol; local consistency makes both places begin a group then, or differ.
    """
    begin, x, y = x, x.copy(), y.copy()
    alive = np.arange(len(x))
    stopped: list[np.ndarray] = []
    for level in levels:
        a, b = x[alive], y[alive]
        if level.up is None:
            stopped.append(alive)
            break
        p, q = level.up[a], level.up[b]
        inside = (level.first[p] != a) | (level.first[q] != b)
        rest_a, rest_b = level.first[p] + level.size[p] - a, level.first[q] + level.size[q] - b
        equal = level.symbols[a] == level.symbols[b]
        step = np.where(inside & equal, np.minimum(rest_a, rest_b), 0)
        # A pair's right symbol, or a block's rest, ends on both sides at once, or they differ behind the shorter one.
        stop = inside & (~equal | (rest_a != rest_b))
        x[alive], y[alive] = a + step, b + step
        stopped.append(alive[stop])
        alive = alive[~stop]
        x[alive], y[alive] = level.up[x[alive]], level.up[y[alive]]
    low = np.zeros(0, np.int64)
    for depth in range(len(stopped) - 1, -1, -1):
        level = levels[depth]
        if len(low):
            a, b = level.first[x[low]], level.first[y[low]]
            m, n = level.size[x[low]], level.size[y[low]]
            # Groups that begin alike and differ: pairs in their second symbol, blocks in their size.
            step = np.where(level.symbols[a] == level.symbols[b], np.where(m == n, 1, np.minimum(m, n)), 0)
            x[low], y[low] = a + step, b + step
        low = np.concatenate([low, stopped[depth]])
    return x - begin


def grid_candidates(symbols: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods): multiples of each period q at which four symbols, q apart, are equal.

    A stretch of 4 q symbols holds four multiples of q, so each run with period q holds such a place. All periods
    together have about n log n multiples.
    """
    places, periods, held = [], [], 0
    for q in range(1, longest // 4 + 1):
        grid = symbols[::q]
        same = grid[1:] == grid[:-1]
        hit = np.flatnonzero(same[2:] & same[1:-1] & same[:-2])
        if len(hit):
            places.append(hit * q)
            periods.append(np.full(len(hit), q))
            held += len(hit)
            if held >= TOGETHER:
                yield np.concatenate(places), np.concatenate(periods)
                places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def measured(grammar: Grammar, place: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Rows start, end, period: the widest stretch around each place that has the period."""
    return np.stack([place - grammar.before(place, place + period), place + period + grammar.after(place, place + period), period])


def find_runs(symbols: np.ndarray, least: int = 6) -> np.ndarray:
    """Rows start, end, period of all maximal runs of at least ``least`` symbols and four times their smallest period, by
    start and period.

    Documents stand between negative symbols, each of which occurs once.
    """
    bounds = np.flatnonzero(symbols < 0)
    found = [np.zeros((3, 0), np.int64)]
    for place, period in grid_candidates(symbols, int(np.diff(bounds).max()) - 1):
        doc = np.searchsorted(bounds, place, "right")
        whole = doc == np.searchsorted(bounds, place + 3 * period, "right")
        if not whole.any():
            continue
        place, period = place[whole], period[whole]
        # The grammar is that of the documents with candidates.
        held = np.zeros(len(bounds), bool)
        held[doc[whole] - 1] = True
        inner = np.repeat(held, np.diff(np.append(bounds, len(symbols))))
        inner[bounds[-1]] = True
        shift = np.cumsum(~inner)
        grammar = Grammar(symbols[inner])
        local = place - shift[place]
        # The first of neighbouring places answers for all that its run reaches; the others are looked up then.
        fresh = np.append(True, (period[1:] != period[:-1]) | (place[1:] != place[:-1] + period[:-1]))
        runs = measured(grammar, local[fresh], period[fresh])
        rest = np.flatnonzero(local + 3 * period >= runs[1][np.cumsum(fresh) - 1])
        runs = np.concatenate([runs, measured(grammar, local[rest], period[rest])], axis=1)
        runs[:2] += shift[inner][runs[0]]
        found.append(runs[:, runs[1] - runs[0] >= np.maximum(least, 4 * runs[2])])
    start, end, period = np.concatenate(found, axis=1)
    # A multiple of a run's period gives the same stretch; the smallest is the run's own.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[:len(start)]
    runs = np.stack([start, end, period])[:, new]
    return runs[:, np.lexsort((runs[2], runs[0]))]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 6) -> DataFrame:
    """doc_id, n_words, runs, collapsed: the maximal periodic runs of each text, by start and period, and the text without
    their repeats.

    Words are runs without ASCII white space. A run is a stretch of at least ``least`` words and four times its smallest
    period that no neighbouring word extends. ``collapsed`` holds the words that are in no run behind its first period,
    joined by one space. A null or empty text has no words, no runs and an empty ``collapsed``. Rows are independent:
    repeated rows and null ids give a row each. Other columns are not read. Words are compared as bytes, not as hashes.
    """
    def find(batches):
        for batch, block in blocks(batches):
            ids: dict[bytes, int] = defaultdict()
            ids.default_factory = ids.__len__
            words = [t.split() for t in block.texts]
            n = np.array([len(w) for w in words], np.int64)
            base = np.cumsum(n + 1) - n
            # -1, -2, ... stand before, between and behind the documents.
            symbols = np.full(int(n.sum()) + len(n) + 1, -1, np.int64)
            symbols[base + n] = -2 - np.arange(len(n))
            for w, at in zip(words, base.tolist()):
                symbols[at:at + len(w)] = np.fromiter(map(ids.__getitem__, w), np.int64, len(w))
            start, end, period = find_runs(symbols, least)
            gone = covered(len(symbols), start + period, end - start - period)
            doc = np.searchsorted(base, start, "right") - 1
            cut = np.searchsorted(doc, np.arange(len(n) + 1))
            collapsed = []
            for i, (w, at) in enumerate(zip(words, base.tolist())):
                if cut[i] < cut[i + 1]:
                    w = [w[k] for k in np.flatnonzero(~gone[at:at + len(w)]).tolist()]
                collapsed.append(b" ".join(w))
            items = pa.StructArray.from_arrays(
                [pa.array(start - base[doc]), pa.array(end - start), pa.array(period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), items),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        find, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equals the first. Null without runs."""
    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best))


def with_periods(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text: of each tenth document by the crc32 of its id, the end is made periodic.

    With h the crc32, g = floor(h / 10) and n words, a = g % n, p = 1 + floor((n - a) / (3 + g % 8)): each word i >= a
    becomes word a + (i - a) % p. Changed texts are joined by one space. A null id changes nothing.
    """
    h = F.crc32(F.col(doc_id).cast("string"))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    cut = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), (h / 10).cast("bigint").alias("g"),
                      F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.greatest(F.size("words"), F.lit(0)))
    a = (F.col("g") % F.greatest("n", F.lit(1))).cast("int")
    left = F.col("n") - a
    p = (1 + F.floor(left / (3 + F.col("g") % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil(left / p).cast("int"))), F.lit(1), left)
    made = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return cut.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))
