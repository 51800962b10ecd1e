"""Quality classifier on supervised subword embeddings.

Words, pairs of neighbours and character n-grams are hashed into one table of learned vectors. A document is the mean
of its vectors; a softmax layer over it gives the class. Training is plain numpy stochastic gradient descent on a
bounded sample of labelled rows. As the softmax layer is linear, a feature's share of the score is one number, and
a whole text is scored by sums of those.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.blocks import Block, blocks, encoded, mix, powers, prefix_hash, span_hash, BASE

GRAMS = (2, 3, 4, 5)
WORD_SALT, PAIR_SALT, SAME_SALT = 11, 12, 13
SCHEMA = "doc_id {}, score double, predicted int"


def subwords(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of distinct words: the word and its character n-grams with word ends; with the word of each."""
    block = Block([b"^" + t + b"$" for t in texts])
    prefix = prefix_hash(block.data)
    at, size = block.starts, block.sizes
    ids, owner = [span_hash(prefix, at, block.ends, WORD_SALT)], [np.arange(len(texts))]
    for n in GRAMS:
        many = np.maximum(size - n + 1, 0)
        word = np.repeat(np.arange(len(texts)), many)
        start = at[word] + np.arange(len(word)) - (np.cumsum(many) - many)[word]
        ids.append(span_hash(prefix, start, start + n))
        owner.append(word)
    return (np.concatenate(ids) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(owner)


def pairs(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Feature of each word with the next one; a word that repeats itself is the same feature for all words."""
    a, b = hashes[:-1], hashes[1:]
    joint = mix(a * np.uint64(3) + b * BASE, PAIR_SALT)
    joint[a == b] = mix(np.array([1], np.uint64), SAME_SALT)[0]
    return (joint >> np.uint64(64 - bits)).astype(np.int64)


def features(block: Block, bits: int):
    """Distinct words with their features, and for every place its word, document and pair feature."""
    words = block.words()
    hashes = words.hashes()
    _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    ids, owner = subwords([words.text(i) for i in first], bits)
    same = words.doc[:-1] == words.doc[1:]
    return words, len(first), ids, owner, place, pairs(hashes, bits)[same], words.doc[:-1][same]


class Model:
    """Vectors of the features, output layer and bias of two classes."""

    def __init__(self, bits: int, dims: int, seed: int):
        draw = np.random.default_rng(seed)
        self.bits = bits
        self.vectors = draw.uniform(-1 / dims, 1 / dims, (1 << bits, dims)).astype(np.float32)
        self.out = np.zeros((2, dims), np.float32)
        self.bias = np.zeros(2, np.float32)

    def train(self, texts: list[bytes], labels: np.ndarray, epochs: int, rate: float, seed: int) -> None:
        bags = []
        for text in texts:
            _, n, ids, owner, place, pair, _ = features(Block([text]), self.bits)
            times = np.concatenate([np.bincount(place, minlength=n)[owner], np.ones(len(pair), np.int64)])
            found, at = np.unique(np.concatenate([ids, pair]), return_inverse=True)
            bags.append((found, (np.bincount(at, weights=times) / max(times.sum(), 1)).astype(np.float32)))
        draw, steps, done = np.random.default_rng(seed), epochs * len(bags), 0
        for _ in range(epochs):
            for i in draw.permutation(len(bags)):
                found, share = bags[i]
                pace, done = rate * (1 - done / steps), done + 1
                mean = share @ self.vectors[found]
                logits = self.out @ mean + self.bias
                p = np.exp(logits - logits.max())
                p /= p.sum()
                p[labels[i]] -= 1
                back = p @ self.out
                self.out -= pace * np.outer(p, mean)
                self.bias -= pace * p
                self.vectors[found] -= pace * np.outer(share, back)

    def weights(self) -> tuple[np.ndarray, float]:
        """Share of each feature in the log odds of class 1, and the bias."""
        return self.vectors @ (self.out[1] - self.out[0]), float(self.bias[1] - self.bias[0])


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, doc_id: str, text: str, label: str):
    """At most ``rows`` whole texts of ``docs`` that have a label (smallest hashes), and their labels."""
    marked = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("k")).agg(F.max(label).alias("y"))
    known = docs.select(F.col(doc_id).alias("k"))
    picked = marked.join(known, "k", "left_semi").orderBy(F.xxhash64("k", F.lit(7)), "k").limit(rows)
    keyed = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"))
    table = keyed.join(F.broadcast(picked), "k").toArrow()
    order = np.argsort(table["k"].to_numpy(), kind="stable")
    texts = encoded(table["t"].combine_chunks())
    return [texts[i] for i in order], table["y"].to_numpy()[order]


def classify(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id",
             text: str = "text", cut: float = 0.3, sample_rows: int = 4_000, bits: int = 18,
             dims: int = 8, epochs: int = 10, rate: float = 0.7, seed: int = 5) -> DataFrame:
    """doc_id, score of class 1 (0 to 1), predicted (score at least ``cut``) for every whole text of ``docs``.

    Learns from the whole texts of at most ``sample_rows`` documents of ``train_docs`` that have a label; labels other than 0 and 1 are ignored, a
    document labelled twice has its larger label. A null or empty text has the score of the bias; without any label
    every score is 0.5. Repeated rows and null ids are kept; other columns are not read.
    """
    texts, y = labelled_sample(train_docs, labels, sample_rows, doc_id, text, label)
    model = Model(bits, dims, seed)
    if len(texts):
        model.train(texts, y, epochs, rate, seed)
    shared = docs.sparkSession.sparkContext.broadcast(model.weights())

    def score(batches):
        weights, bias = shared.value
        for batch, block in blocks(batches, text):
            n_docs = len(block.texts)
            words, n, ids, owner, place, pair, pair_doc = features(block, bits)
            by_word = np.bincount(owner, weights=weights[ids], minlength=n)[place]
            size = np.bincount(owner, minlength=n)[place]
            total = np.bincount(words.doc, weights=by_word, minlength=n_docs)
            total += np.bincount(pair_doc, weights=weights[pair], minlength=n_docs)
            many = np.bincount(words.doc, weights=size, minlength=n_docs) + np.bincount(pair_doc, minlength=n_docs)
            odds = np.clip(total / np.maximum(many, 1) + bias, -700, 700)
            p = 1 / (1 + np.exp(-odds))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= cut).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(score, SCHEMA.format(kind))
