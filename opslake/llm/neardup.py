"""Near-duplicate documents: consistent weighted samples of TF-IDF shingles, banded, verified by weighted Jaccard.

Weights are term frequency times inverse document frequency; document frequencies come from a count-min sketch of fixed
size over the whole corpus. Improved consistent weighted sampling draws, for each of its hash functions, one shingle
with a quantised weight; two documents draw the same with the probability of their weighted Jaccard similarity.
Documents that share a band are compared with a leader of the band, not with each other: the similarity's distance is a
metric, so whoever is far from the leader cannot be near its copies, and whoever is in one class need not be compared.
What these two rules leave open meets on rare shingles: two texts can only reach the threshold if the first shingle they
share, rarest first, leaves both of them weight enough behind it. Each shingle's texts meet first one or two of them that
have most of their weight behind it, which brings the copies of one text into a class; all pairs that still meet are verified.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.blocks import Block, blocks, mix, prefix_hash, span_hash
from opslake.llm.components import components
from opslake.llm.marks import keyed, rows_as
from opslake.llm.sketch import ROWS, cells
from opslake.session import use_shared_checkpoints, use_text_batches

POOL_BITS = 14
#: Added to the share of documents that hold a shingle before its inverse is taken. Rare shingles then weigh alike, so
#: that the copies of a text do not make its own shingles light, and those of boilerplate weigh a fraction of them.
SHARE_FLOOR = 0.1
#: Parts of a sketch row that are merged apart.
SLICES = 16
#: Elements of the sampling matrix that are worked on at once.
CHUNK = 40_000
#: Bytes of text that are shingled at once, and pairs that are compared at once.
BLOCK, PAIRS = 1 << 20, 500
#: Room for rounding in the bounds of candidates; whoever passes is verified.
SLACK = 1e-6
#: Nodes of a key that are compared with each other at once.
KEY_BLOCK = 500
#: Texts of a key that have a lead of their own.
LED = 8
#: Keys that come before a row's own and that it carries.
EARLIER_KEYS = 32


def shingles(block: Block, size: int):
    """Distinct shingles of every document with their counts, in document order, and the words of the block.

    A document of fewer words than a shingle has one of all its words.
    """
    words = block.words(lower=True)
    hashes = words.hashes()
    prefix = prefix_hash(hashes)
    many = np.where(words.count > 0, np.maximum(words.count - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(many)), many)
    start = words.first[doc] + np.arange(len(doc)) - (np.cumsum(many) - many)[doc]
    end = np.minimum(start + size, (words.first + words.count)[doc])
    shingle = span_hash(prefix, start, end)
    _, first, times = np.unique(mix(shingle + doc.astype(np.uint64) * np.uint64(ROWS[1])), return_index=True,
                                return_counts=True)
    order = np.argsort(first)
    first, times = first[order], times[order]
    return words, prefix, shingle[first], doc[first], times


def frequencies(docs: DataFrame, text: str, size: int, bits: int):
    """Broadcast (number of documents, count-min rows of document frequencies); len(ROWS) * 2**bits numbers."""
    def count(batches):
        totals, n = [np.zeros(1 << bits, np.int64) for _ in ROWS], 0
        for _, block in blocks(batches, text, BLOCK):
            n += len(block.texts)
            _, _, shingle, _, _ = shingles(block, size)
            for row, total in enumerate(totals):
                total += np.bincount(cells(shingle, row, bits), minlength=len(total))
        if n:
            parts = [(row, i, n, part.astype(np.int32).tobytes())
                     for row, total in enumerate(totals) for i, part in enumerate(np.split(total, SLICES))]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*parts), (
                pa.int32(), pa.int32(), pa.int64(), pa.binary()))], ["row", "slice", "n", "totals"])

    def merge(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        counted: dict[tuple[int, int], int] = {}
        for batch in batches:
            for row, i, n, total in zip(*(c.to_pylist() for c in batch.columns)):
                sums[row, i] = sums.get((row, i), 0) + np.frombuffer(total, np.int32).astype(np.int64)
                counted[row, i] = counted.get((row, i), 0) + n
        for (row, i), total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([row], pa.int32()), pa.array([i], pa.int32()), pa.array([counted[row, i]], pa.int64()),
                 pa.array([total.tobytes()])], ["row", "slice", "n", "totals"])

    schema = "row int, slice int, n bigint, totals binary"
    found, n = [np.zeros(1 << bits, np.int64) for _ in ROWS], 0
    merged = docs.select(text).mapInArrow(count, schema).repartition("row", "slice").mapInArrow(merge, schema)
    for r in merged.toLocalIterator():
        total, n = np.frombuffer(r.totals, np.int64), r.n
        found[r.row][r.slice * len(total):(r.slice + 1) * len(total)] = total
    return docs.sparkSession.sparkContext.broadcast((n, found))


def weights(shingle: np.ndarray, times: np.ndarray, known) -> np.ndarray:
    n, rows = known
    bits = len(rows[0]).bit_length() - 1
    df = np.minimum.reduce([total[cells(shingle, row, bits)] for row, total in enumerate(rows)])
    return times * np.log1p(1 / (df / n + SHARE_FLOOR))


@lru_cache(maxsize=1)
def pools(hashes: int, seed: int):
    """Random r, beta and log c of the sampling for each hash; an element finds its own by two parts of its hash."""
    draw = np.random.default_rng(seed)
    shape = (1 << POOL_BITS, hashes)
    return (draw.gamma(2, 1, shape).astype(np.float32), draw.random(shape, np.float32),
            np.log(draw.gamma(2, 1, shape)).astype(np.float32))


def samples(shingle: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, hashes: int, seed: int) -> np.ndarray:
    """Consistent weighted sample of each document and hash, as the bits of its smallest value.

    The value of an element depends on its random numbers and its quantised weight only, so documents share the value
    if they share both.
    """
    r, beta, log_c = pools(hashes, seed)
    mask = np.uint64((1 << POOL_BITS) - 1)
    one = (shingle & mask).astype(np.int64)
    two = (shingle >> np.uint64(64 - POOL_BITS)).astype(np.int64)
    log_w = np.log(weight).astype(np.float32)
    least = np.full((n_docs, hashes), np.inf, np.float32)
    for a in range(0, len(doc), CHUNK):
        part = slice(a, a + CHUNK)
        rate, shift = r[one[part]], beta[one[part]]
        level = np.floor(log_w[part, None] / rate + shift)
        value = log_c[two[part]] - rate * (level - shift + np.float32(1))
        d = doc[part]
        head = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
        least[d[head]] = np.minimum(least[d[head]], np.minimum.reduceat(value, head, axis=0))
    return least.view(np.uint32)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Similarity of two sets of (sorted shingles, weights)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared)) if len(both) else 0.0


def signed(docs: DataFrame, size: int, bands: int, rows: int, seed: int, known) -> DataFrame:
    """k, h, doc_id, node (hash of the words), bands; node and bands are null for texts without words."""
    def sign(batches):
        for batch, block in blocks(batches, most=BLOCK):
            words, prefix, shingle, doc, times = shingles(block, size)
            first, last = words.first, words.first + words.count
            node = np.stack([span_hash(prefix, first, last, salt) for salt in (1, 2)], axis=1).astype(">u8")
            drawn = samples(shingle, doc, weights(shingle, times, known.value), len(block.texts), bands * rows, seed)
            parts = drawn.astype(np.uint64).reshape(-1, bands, rows)
            key = np.zeros(parts.shape[:2], np.uint64)
            for row in range(rows):
                key = mix(key * np.uint64(31) + parts[:, :, row])
            key = mix(key + np.arange(bands, dtype=np.uint64) * np.uint64(ROWS[0])).view(np.int64)
            empty = words.count == 0
            ends = pa.array(np.arange(0, key.size + 1, bands), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(key.ravel()))
            keep = pa.array(~empty)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([x.tobytes() for x in node], pa.binary(), mask=empty),
                 pc.if_else(keep, lists, pa.scalar(None, lists.type))], ["k", "h", "doc_id", "node", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(sign, f"k bigint, h bigint, doc_id {kind}, node binary, bands array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame, size: int, known) -> DataFrame:
    """node, leader, similarity of the given pairs."""
    def compare(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PAIRS):
                yield compared(batch.slice(at, PAIRS))

    def compared(batch):
        sets: dict[bytes, tuple] = {}
        wanted = {}
        for name, text in (("node", "text"), ("leader", "leader_text")):
            wanted.update(zip(batch.column(name).to_pylist(), batch.column(text).to_pylist()))
        names = pa.RecordBatch.from_arrays(
            [pa.array(wanted.keys(), pa.binary()), pa.array(wanted.values(), pa.string())], ["node", "text"])
        for part, block in blocks([names], most=BLOCK):
            _, _, shingle, doc, times = shingles(block, size)
            weight = weights(shingle, times, known.value)
            cut = np.searchsorted(doc, np.arange(len(block.texts) + 1))
            for node, a, b in zip(part.column(0).to_pylist(), cut, cut[1:]):
                order = np.argsort(shingle[a:b])
                sets[node] = shingle[a:b][order], weight[a:b][order]
        node, leader = batch.column("node").to_pylist(), batch.column("leader").to_pylist()
        similar = [weighted_jaccard(sets[x], sets[y]) for x, y in zip(node, leader)]
        return pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("leader"), pa.array(similar, pa.float64())],
            ["node", "leader", "similarity"])

    led = texts.select(F.col("node").alias("leader"), F.col("text").alias("leader_text"))
    return pairs.join(texts, "node").join(led, "leader").select("node", "leader", "text", "leader_text").mapInArrow(
        compare, "node binary, leader binary, similarity double")


def led(live: DataFrame, salt: int) -> DataFrame:
    """Distinct (node, leader) of every key, the leader being the node with the smallest salted hash."""
    leader = live.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(salt)).alias("at"), "node")).alias("l"))
    return live.join(leader.select("key", F.col("l.node").alias("leader")), "key").where("node <> leader")


def prefixes(mine: DataFrame, size: int, threshold: float, known, sketch_bits: int) -> DataFrame:
    """Where texts (node, label, text) meet: rows of key (a shingle), total and after.

    Shingles are in one order for all texts, rarest among them first. ``after`` is the weight of a text from the shingle
    on, ``total`` that of all. Similar texts of totals A and B share a weight of t / (1 + t) * (A + B) at least, so that
    much is behind the first shingle they share, in both, and at least t of the weight of each.
    """
    rarity = frequencies(mine, "text", size, sketch_bits)
    least = threshold * (1 - SLACK)

    def meet(batches):
        for batch, block in blocks(batches, most=BLOCK):
            _, _, shingle, doc, times = shingles(block, size)
            weight = weights(shingle, times, known.value)
            rows = rarity.value[1]
            bits = len(rows[0]).bit_length() - 1
            df = np.minimum.reduce([total[cells(shingle, row, bits)] for row, total in enumerate(rows)])
            order = np.lexsort((shingle, df, doc))
            shingle, doc, weight, df = shingle[order], doc[order], weight[order], df[order]
            total = np.bincount(doc, weights=weight, minlength=len(block.texts))
            after = np.cumsum(total)[doc] - np.cumsum(weight) + weight
            # The sketch never counts too few: a shingle counted once is in no other text.
            at = np.flatnonzero((df > 1) & (after >= least * total[doc]))
            place = pa.array(doc[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(place), batch.column("label").take(place), pa.array(total[doc[at]]),
                 pa.array(after[at]), pa.array(shingle[at].view(np.int64))], ["node", "label", "total", "after", "key"])

    return mine.mapInArrow(meet, "node binary, label binary, total double, after double, key bigint")


def labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """Rows of nodes with the label of their class; a node that has none is its own."""
    return rows.join(label.select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))


def enough(threshold: float, total: str, other: str):
    """The weight that two similar texts share at least."""
    return threshold / (1 + threshold) * (1 - SLACK) * (F.col(total) + F.col(other))


def banded(pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """The distinct pairs (node, leader) whose nodes share a band; ``keys`` are the bands of every node."""
    pairs = pairs.select(F.least("node", "leader").alias("node"), F.greatest("node", "leader").alias("leader")).distinct()
    return pairs.join(keys, "node").join(keys.toDF("leader", "leader_keys"), "leader").where(
        F.arrays_overlap("keys", "leader_keys")).select("node", "leader").checkpoint()


def met_rows(rows: DataFrame) -> DataFrame:
    """The rows whose key has several labels, with two leads: of the key, and of a part of about ``LED`` of its texts.

    A lead is the text with the largest share of its weight behind the key.
    """
    lead = F.max(F.struct((F.col("after") / F.col("total")).alias("share"), "node", "label", "total", "after"))
    several = rows.groupBy("key").agg(
        lead.alias("lead"), F.min("label").alias("low"), F.max("label").alias("high"), F.ceil(F.count("*") / LED).alias("parts")).where("low < high")
    met = rows.join(several.drop("low", "high"), "key").withColumn("part", F.pmod(F.xxhash64("key", "node"), "parts")).drop("parts").checkpoint()
    return met.join(met.groupBy("key", "part").agg(lead.alias("second")), ["key", "part"])


def lead_pairs(met: DataFrame, threshold: float) -> DataFrame:
    """(node, leader) of met rows that may be similar to one of their leads: two for each row at most."""
    met = met.select("node", "label", "total", "after", F.explode(F.array("lead", "second")).alias("lead"))
    least = enough(threshold, "total", "lead.total")
    return met.where((F.col("label") != F.col("lead.label")) & (F.col("after") >= least) & (F.col("lead.after") >= least)).select(
        "node", F.col("lead.node").alias("leader"))


def rare_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """(node, leader) of nodes that share a key, have different labels and may be similar.

    Of a key's nodes, those of its most frequent label meet the others, and the others meet each other: the members of one
    class do not meet. Two nodes that share an earlier key met there and do not meet again; a row carries the last
    EARLIER_KEYS of those on which its text can meet. Both sides are divided into blocks of ``KEY_BLOCK`` nodes, and each
    block of one meets each of the other.
    """
    tops = rows.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("labels"), F.sum("n").alias("n")).where("labels > 1").select(
        "key", F.col("top.label").alias("top"), F.ceil(F.col("top.n") / KEY_BLOCK).alias("cuts"),
        F.ceil((F.col("n") - F.col("top.n")) / KEY_BLOCK).alias("splits"))
    earlier = Window.partitionBy("node").orderBy(F.desc("after"), "key").rowsBetween(-EARLIER_KEYS, -1)
    met = rows.join(tops, "key").withColumn("before", F.collect_list("key").over(earlier)).checkpoint()
    zero, side = F.lit(0).cast("bigint"), F.col("label") == F.col("top")
    dealt = F.pmod(F.xxhash64("node"), F.when(side, F.col("cuts")).otherwise(F.col("splits")))
    # Side 0: the key's top label against the others. Side 1: the others among themselves.
    one = met.select("key", "node", "label", "total", "after", "before", F.when(side, 0).otherwise(1).alias("side"), dealt.alias("cut"),
                     F.explode(F.sequence(zero, F.col("splits") - 1)).alias("split"))
    two = met.where(~side).select(
        "key", F.col("node").alias("leader"), F.col("label").alias("leader_label"), F.col("total").alias("leader_total"),
        F.col("after").alias("leader_after"), F.col("before").alias("leader_before"), dealt.alias("split"),
        F.inline(F.concat(
            F.transform(F.sequence(zero, F.col("cuts") - 1), lambda i: F.struct(F.lit(0).alias("side"), i.alias("cut"))),
            F.transform(F.sequence(zero, F.col("splits") - 1), lambda i: F.struct(F.lit(1).alias("side"), i.alias("cut"))))))
    wanted = enough(threshold, "total", "leader_total")
    return one.join(two, ["key", "side", "cut", "split"]).where(
        (F.col("label") != F.col("leader_label")) & ((F.col("side") == 0) | (F.col("node") < F.col("leader")))
        & (F.col("after") >= wanted) & (F.col("leader_after") >= wanted)
        & ~F.arrays_overlap("before", "leader_before")).select("node", "leader")


def merged(label: DataFrame, found: DataFrame) -> DataFrame:
    """Node and label, after links (node, leader) have joined classes. The classes are the nodes of that graph."""
    for end in ("node", "leader"):
        found = found.join(label.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")), end, "left").withColumn(
            f"{end}_label", F.coalesce(f"{end}_label", end))
    joined = components(found.select(F.col("node_label").alias("a"), F.col("leader_label").alias("b")).checkpoint())
    lone = joined.join(label.select(F.col("node")), "node", "left_anti").select("node", "label")
    moved = label.join(joined.toDF("label", "root"), "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    return moved.unionByName(lone).checkpoint()


def links(members: DataFrame, texts: DataFrame, size: int, threshold: float, known, sketch_bits: int) -> DataFrame:
    """Node and label of its class, where verified links join all similar nodes of a band, directly or through others.

    First every node of a band is compared with one leader. What that leaves open, in classes of their own, meets on rare
    shingles: first with leads of each, then in all pairs that may be similar.
    """
    far = 1 - 2 * (1 - threshold)
    asked = led(members, 0).checkpoint()
    sims = verified(asked.select("node", "leader").distinct(), texts, size, known).checkpoint()
    found = sims.where(F.col("similarity") >= threshold).select("node", "leader").checkpoint()
    label = components(found, "node", "leader")
    seen = asked.join(sims, ["node", "leader"]).withColumn("match", F.col("similarity") >= threshold)
    seen = seen.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # Whoever is far from the leader is no neighbour of its matches; those matter only to nodes in between.
    state = seen.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.max(~F.col("match") & (F.col("similarity") >= far)).alias("grey"), F.count_if(~F.col("match")).alias("open"))
    live = seen.join(state.where("low < high AND (grey OR open > 1)"), "key").where(
        ~F.col("match") | F.col("grey")).select("key", "node").checkpoint()
    keys = live.groupBy("node").agg(F.collect_set("key").alias("keys")).checkpoint()
    mine = labelled(keys.select("node"), label).join(texts, "node").checkpoint()
    met = met_rows(prefixes(mine, size, threshold, known, sketch_bits).checkpoint()).checkpoint()
    for step in ("lead", "rest"):
        if step == "lead":
            pairs = lead_pairs(met, threshold)
        else:
            pairs = rare_pairs(labelled(met.drop("label", "lead", "second", "part"), label).checkpoint(), threshold)
        new = verified(banded(pairs, keys), texts, size, known).where(F.col("similarity") >= threshold)
        label = merged(label, new.select("node", "leader"))
    return label


def classes(docs: DataFrame, doc_id: str, text: str, size: int, threshold: float, bands: int, rows: int,
            sketch_bits: int, seed: int) -> DataFrame:
    """k, h, doc_id, class_id, class_size, first (the smallest k, h of its class) of every row."""
    use_shared_checkpoints(docs.sparkSession)
    use_text_batches(docs.sparkSession)
    known = frequencies(docs, text, size, sketch_bits)
    named = keyed(docs, doc_id, text)
    each = signed(named, size, bands, rows, seed, known).checkpoint()
    nodes = each.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct("k", "h")).alias("r"), F.min("doc_id").alias("id"), F.count("*").alias("n"),
        F.first("bands").alias("bands")).checkpoint()
    exploded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = exploded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = exploded.join(shared, "key").checkpoint()
    involved = members.select("node").distinct().join(nodes.select("node", "r.k", "r.h"), "node")
    texts = named.select("k", "h", "text").join(involved, ["k", "h"]).groupBy("node").agg(
        F.first("text").alias("text")).checkpoint()
    label = links(members, texts, size, threshold, known, sketch_bits)
    named_nodes = labelled(nodes.drop("bands"), label)
    total = named_nodes.groupBy("label").agg(
        F.min("id").alias("class_id"), F.sum("n").alias("class_size"), F.min("r").alias("least"))
    found = named_nodes.select("node", "label").join(total, "label").drop("label")
    alone = F.col("node").isNull()
    return each.drop("bands").join(found, "node", "left").select(
        "k", "h", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("bigint")).alias("class_size"),
        (alone | (F.struct("k", "h") == F.col("least"))).alias("first"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
                    threshold: float = 0.8, bands: int = 14, rows: int = 3, sketch_bits: int = 16, seed: int = 11
                    ) -> DataFrame:
    """doc_id, class_id, class_size of every row: the smallest id of its class of near duplicates, and its rows.

    Words are lower-cased (ASCII) and split at ASCII white space. Rows with equal words are copies and share a class, so
    repeated rows do. A null or empty text, or one of white space, has no words and is a class of its own. Two texts are
    linked if the weighted Jaccard similarity of their TF-IDF shingles of ``size`` words is at least ``threshold`` and
    they share a band; at 0.8 the bands miss 4 links in 100,000. class_id is null if no row of the class has an id. Other
    columns are not read.
    """
    return classes(docs, doc_id, text, size, threshold, bands, rows, sketch_bits, seed).drop("k", "h", "first")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8,
               bands: int = 14, rows: int = 3, sketch_bits: int = 16, seed: int = 11) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the one with the smallest id stays, with all columns.

    Of rows that repeat id and text one stays; texts without words all stay.
    """
    kept = classes(docs, doc_id, text, size, threshold, bands, rows, sketch_bits, seed).where("first").select("k", "h")
    whole = keyed(rows_as(docs, "_row"), doc_id, text, "_row")
    return whole.select("k", "h", "_row").join(kept.distinct(), ["k", "h"]).dropDuplicates(["k", "h"]).select("_row.*")
