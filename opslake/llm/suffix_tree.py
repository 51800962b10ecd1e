"""Language model scores from a probabilistic suffix tree over words.

States are contexts of up to ``depth`` words. A context is kept if the next symbols after it diverge enough from those after
its suffix (without its oldest word); its distribution gives the frequent next symbols their discounted share and the
others the rest, in proportion to the suffix's distribution; the root's is the smoothed distribution of single tokens. A
text is scored with the longest kept suffix of what precedes each token.

Every count is over the whole corpus and is summed by shuffles of packed arrays. What is shared with all tasks has a
bound: only words, contexts and next symbols with at least ``least_share`` of all tokens are in it, so at most
1 / least_share for each depth. Rarer words only matter through the root; a join brings their counts to the documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm.blocks import Block, blocks
from opslake.llm.marks import keyed
from opslake.session import use_shared_checkpoints

END_HASH = 0x0123456789ABCDEF
FILTER_BITS = 26
PACKED = "bucket int, keys binary, counts binary"


class Lookup:
    """Places of keys in a sorted array; a bitmap turns most absent ones away first."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        cell = self.cells(keys)
        np.bitwise_or.at(self.bits, cell >> 3, (1 << (cell & 7)).astype(np.uint8))

    @staticmethod
    def cells(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """-1 where a key is absent."""
        out = np.full(len(wanted), -1, np.int64)
        if len(self.keys):
            cell = self.cells(wanted)
            maybe = np.flatnonzero((self.bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1)
            at = np.minimum(np.searchsorted(self.keys, wanted[maybe]), len(self.keys) - 1)
            hit = self.keys[at] == wanted[maybe]
            out[maybe[hit]] = at[hit]
        return out


@dataclass
class Layer:
    """Contexts of one length with their frequent next symbols."""

    keys: np.ndarray  # context << 32 | next symbol, sorted
    counts: np.ndarray
    chance: np.ndarray  # of each entry under the longest kept context
    suffix: np.ndarray  # of each entry's words: the entry of the layer below without the oldest word
    kept: np.ndarray  # by context
    rest: np.ndarray  # by context: factor of the suffix's chance for other symbols
    find: Lookup = field(init=False)

    def __post_init__(self):
        self.find = Lookup(self.keys)


@dataclass
class Tree:
    """Frequent words by hash, totals, and the layers for contexts of 1, 2, ... words."""

    words: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int
    starts: int
    layers: list[Layer] = field(default_factory=list)

    def root(self, count):
        return (count + 0.5) / (self.total + 0.5 * (self.distinct + 1))

    def grow(self, keys: np.ndarray, counts: np.ndarray, discount: float, least: float) -> None:
        """Adds the layer of contexts one word longer, from the counts of their frequent next symbols."""
        context, symbol = keys >> 32, keys & 0xFFFFFFFF
        if not self.layers:
            seen = np.append(self.counts, self.starts).astype(float)
            suffix, below = symbol, self.root(self.counts[symbol])
        else:
            last = self.layers[-1]
            seen = last.counts.astype(float)
            suffix = last.find(last.suffix[context] << 32 | symbol)
            below = last.chance[suffix]
        n = len(seen)
        share = (counts - discount) / seen[context]
        explicit = np.bincount(context, weights=counts, minlength=n)
        left = 1 - np.bincount(context, weights=share, minlength=n)
        left_below = 1 - np.bincount(context, weights=below, minlength=n)
        entries = np.bincount(context, minlength=n)
        good = (entries > 0) & (left > 0) & (left_below > 1e-12)
        rest = np.where(good, left, 1) / np.where(good, left_below, 1)
        gain = np.bincount(context, weights=counts * np.log(share / below), minlength=n)
        gain = gain + (seen - explicit) * np.log(rest) - entries * np.log(np.maximum(seen, 1)) / 2
        kept = good & (gain >= least * seen)
        self.layers.append(Layer(keys, counts, np.where(kept[context], share, below), suffix, kept, rest))


class Tokens:
    """Tokens of a block as numbers of frequent words (-1: another word), each document closed by its end."""

    def __init__(self, block: Block, tree: Tree | None):
        words = block.words(lower=True)
        self.n = words.count + 1
        self.end = np.cumsum(self.n) - 1
        self.first = self.end - words.count
        self.hash = np.full(self.n.sum(), END_HASH, np.uint64)
        body = np.ones(len(self.hash), bool)
        body[self.end] = False
        self.hash[body] = words.hashes()
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        if tree is not None:
            found, place = np.unique(self.hash, return_inverse=True)
            at = np.minimum(np.searchsorted(tree.words, found), max(len(tree.words) - 1, 0))
            known = tree.words[at] == found if len(tree.words) else np.zeros(len(found), bool)
            self.word = np.where(known, at, -1)[place]
            self.start = len(tree.words)

    def before(self, numbers: np.ndarray, at_start: int) -> np.ndarray:
        """The number at the token before, within the document."""
        out = np.empty_like(numbers)
        out[1:] = numbers[:-1]
        out[self.first] = at_start
        return out

    def entries(self, tree: Tree) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each layer, the context of every token and the entry of context and token."""
        out, numbers, at_start = [], self.word, self.start
        for layer in tree.layers:
            context = self.before(numbers, at_start)
            both = np.flatnonzero((context >= 0) & (self.word >= 0))
            numbers, at_start = np.full(len(self.word), -1, np.int64), -1
            numbers[both] = layer.find(context[both] << 32 | self.word[both])
            out.append((context, numbers))
        return out


def counted(docs: DataFrame, keys_of, buckets: int, least: int) -> DataFrame:
    """key, n: how often each key occurs, if at least ``least`` times; keys are summed in tasks before they are sent."""
    def local(batches):
        held, size = [], 0

        def send():
            keys, n = (np.concatenate(x) for x in zip(*held))
            held.clear()
            found, place = np.unique(keys, return_inverse=True)
            total = np.bincount(place, weights=n).astype(np.uint32)
            bucket = (found.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(32)).astype(np.int64) % buckets
            by = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[by], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), *(pa.array([x[by[cut[b]:cut[b + 1]]].tobytes() for b in full], pa.binary())
                                               for x in (found, total))], ["bucket", "keys", "counts"])

        for _, block in blocks(batches):
            keys = np.unique(keys_of(block), return_counts=True)
            if len(keys[0]):
                held.append((keys[0].view(np.int64), keys[1]))
                size += len(keys[0])
            if size > 2_000_000:
                yield send()
                size = 0
        if held:
            yield send()

    def add(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for b, keys, n in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(b, []).append((np.frombuffer(keys, np.int64), np.frombuffer(n, np.uint32)))
        for parts in held.values():
            keys, n = (np.concatenate(x) for x in zip(*parts))
            found, place = np.unique(keys, return_inverse=True)
            total = np.bincount(place, weights=n).astype(np.int64)
            keep = total >= least
            yield pa.RecordBatch.from_arrays([pa.array(found[keep]), pa.array(total[keep])], ["key", "n"])

    return docs.select("text").mapInArrow(local, PACKED).repartition("bucket").mapInArrow(add, "key bigint, n bigint")


def learn(train: DataFrame, depth: int, least_share: float, context_share: float, discount: float, divergence: float
          ) -> tuple[Tree, DataFrame]:
    """The tree, and the stored counts of all words."""
    spark = train.sparkSession
    buckets = max(8, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    vocabulary = counted(train, lambda block: Tokens(block, None).hash, buckets, 1).checkpoint()
    total, distinct = vocabulary.agg(F.sum("n"), F.count("*")).first()
    total = total or 0
    ends = vocabulary.where(F.col("key") == END_HASH).first()
    # At most 1 / least_share words have so large a share.
    least = max(2, int(np.ceil(total * least_share)))
    common = vocabulary.where(F.col("n") >= least).toArrow()
    words = common["key"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    tree = Tree(words[order], common["n"].to_numpy()[order], total, distinct, ends.n if ends else 0)
    for level in range(depth):
        shared = spark.sparkContext.broadcast(tree)
        enough = max(8, int(np.ceil(total * context_share)))
        seen = np.append(tree.counts, tree.starts) if not level else tree.layers[-1].counts
        able = spark.sparkContext.broadcast(seen >= enough)

        def keys_of(block, level=level, shared=shared, able=able):
            tokens = Tokens(block, shared.value)
            if level:
                _, numbers = tokens.entries(shared.value)[-1]
                context = tokens.before(numbers, -1)
            else:
                context = tokens.before(tokens.word, tokens.start)
            both = np.flatnonzero((context >= 0) & (tokens.word >= 0))
            both = both[able.value[context[both]]]
            return context[both] << 32 | tokens.word[both]

        # At most 1 / least_share entries have so large a share.
        entries = counted(train, keys_of, buckets, least).toArrow()
        keys = entries["key"].to_numpy()
        order = np.argsort(keys)
        tree.grow(keys[order], entries["n"].to_numpy()[order], discount, divergence)
        if not len(keys):
            break
    return tree, vocabulary


def score_texts(docs: DataFrame, learns: Column, doc_id: str = "doc_id", text: str = "text", depth: int = 2,
                least_share: float = 2.5e-7, context_share: float = 4e-6, discount: float = 0.75,
                divergence: float = 0.01) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``learns`` tells the rows to learn from (null: no). Tokens are words in ASCII lower case, then one end. Both scores are
    sums of log10: ``base_score`` of the smoothed single tokens, ``score`` of the tree; a word that was not learned has the
    smoothed chance of one unknown token in both. A null or empty text is its end alone. Without learned rows both scores
    are 0 for each token. Repeated rows and null ids are kept and counted as they stand. Other columns are not read.
    """
    use_shared_checkpoints(docs.sparkSession)
    named = keyed(docs, doc_id, text)
    train = docs.where(F.coalesce(learns, F.lit(False))).select(F.col(text).alias("text"))
    tree, vocabulary = learn(train, depth, least_share, context_share, discount, divergence)
    shared = docs.sparkSession.sparkContext.broadcast(tree)

    def score(batches):
        tree: Tree = shared.value
        root = np.log10(tree.root(np.append(tree.counts, 0)))
        layers = [(np.log10(x.chance), x.kept, np.log10(x.rest)) for x in tree.layers]
        for batch, block in blocks(batches):
            tokens = Tokens(block, tree)
            n_docs, common = len(block.texts), tokens.word >= 0
            # A rare word has chance 1 here; the join multiplies in its own.
            base = np.where(common, root[tokens.word], 0.0)
            chance = base.copy()
            for (context, entry), (of_entry, kept, rest) in zip(tokens.entries(tree), layers):
                at = np.flatnonzero(context >= 0)
                at = at[kept[context[at]]]
                chance[at] = np.where(entry[at] >= 0, of_entry[entry[at]], rest[context[at]] + chance[at])
            rare = np.flatnonzero(~common)
            key, first, times = np.unique(
                (tokens.hash[rare] ^ (tokens.doc[rare].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))),
                return_index=True, return_counts=True)
            by = np.argsort(first)
            first, times = rare[first[by]], times[by]
            ends = np.searchsorted(tokens.doc[first], np.arange(n_docs + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(tokens.n), pa.array(np.bincount(tokens.doc[common], minlength=n_docs)),
                 pa.array(np.bincount(tokens.doc, weights=base, minlength=n_docs)),
                 pa.array(np.bincount(tokens.doc, weights=chance, minlength=n_docs)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens.hash[first].view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32)))],
                ["k", "h", "doc_id", "n_tokens", "n_known", "base", "score", "rare", "times"])

    kind = docs.schema[doc_id].dataType.simpleString()
    scored = named.select("k", "h", "doc_id", "text").mapInArrow(
        score, f"k bigint, h bigint, doc_id {kind}, n_tokens bigint, n_known bigint, base double, score double, "
               "rare array<bigint>, times array<int>").checkpoint()
    each = scored.select("k", "h", F.posexplode(F.arrays_zip("rare", "times")).alias("at", "r")).select(
        "k", "h", "at", F.col("r.rare").alias("key"), F.col("r.times").alias("times"))
    chance = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / (tree.total + 0.5 * (tree.distinct + 1)))
    # Rows that repeat id and text bring the same words once each; every one of them needs them once.
    rows = F.count_if(F.col("at") == 0)
    rest = each.join(vocabulary, "key", "left").groupBy("k", "h").agg(
        (F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)) / rows).cast("bigint").alias("more_known"),
        (F.sum(F.col("times") * chance) / rows).alias("more"))
    return scored.drop("rare", "times").join(rest, ["k", "h"], "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tree.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))
