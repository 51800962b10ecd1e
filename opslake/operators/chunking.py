"""Chunk tables from documents. A chunk's key is (doc_id, chunk_index)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from opslake.functions import text as tx
from opslake.functions.batches import parts


def _unfold(documents: DataFrame, chunks: Column) -> DataFrame:
    """One row per chunk, with the number of chunks of its document.

    The outer form keeps the optimizer from adding a filter that would cut every text a second time.
    """
    return documents.select("doc_id", chunks.alias("_c")).select(
        "doc_id", F.size("_c").alias("n_chunks"), F.posexplode_outer("_c").alias("chunk_index", "text")
    ).where(F.col("chunk_index").isNotNull())


def chunk_words(documents: DataFrame, size: int = 128, overlap: int = 32, min_words: int = 1) -> DataFrame:
    """Windows of ``size`` words; the last windows may repeat words of earlier ones."""
    step = max(1, size - overlap)
    cut = F.transform(
        F.sequence(F.lit(0), F.size("_w") - 1, F.lit(step)),
        lambda start: F.array_join(F.slice("_w", start + 1, size), " "))
    split = documents.select("doc_id", tx.words(F.col("text")).alias("_w")).where(F.size("_w") >= max(1, min_words))
    return _unfold(split.select("doc_id", "_w"), cut)


def chunk_fixed(documents: DataFrame, size: int = 10, min_words: int = 1) -> DataFrame:
    """Consecutive groups of words, for documents with at least ``min_words``."""
    return chunk_words(documents, size, 0, min_words)


def chunk_chars(documents: DataFrame, size: int = 500, overlap: int = 50) -> DataFrame:
    """Windows of characters; a text that fits into one stays whole."""
    if overlap >= size:
        raise ValueError("the overlap must be smaller than the chunk")
    body, step = F.col("text"), size - overlap
    cut = F.when(F.length(body) <= size, F.array(body)).otherwise(F.transform(
        F.sequence(F.lit(0), F.length(body) - 1, F.lit(step)),
        lambda start: F.substring(body, start + 1, F.lit(size))))
    return _unfold(documents.where(body.isNotNull()), cut)


def split_sentences(documents: DataFrame) -> DataFrame:
    parts = F.filter(F.transform(F.split("text", r"\."), lambda s: F.trim(s)), lambda s: s != "")
    return _unfold(documents, parts)


@F.pandas_udf(ArrayType(StringType()))
def _unique_word_chunks(texts: pd.Series, limit: pd.Series) -> pd.Series:
    def fold(text: str, most: int) -> list[str]:
        done, current, seen = [], [], set()
        for word in (text or "").split():
            if word not in seen and len(seen) == most:
                done.append(" ".join(current))
                current, seen = [], set()
            current.append(word)
            seen.add(word)
        return done + [" ".join(current)] if current else done

    return pd.Series([fold(t, int(n)) for t, n in zip(texts, limit)])


def chunk_unique_words(documents: DataFrame, most: int = 512) -> DataFrame:
    """Chunks that end before a word would be the next distinct one past the limit.

    Where a chunk ends depends on all words before it, so one Arrow-batched function walks each text.
    """
    return _unfold(documents, _unique_word_chunks("text", F.lit(most)))


SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def pack_sentences(text: str, most: int, overlap: int) -> list[str]:
    """Whole sentences packed up to ``most`` words; the next chunk repeats about ``overlap`` words."""
    chunks: list[str] = []
    current: list[tuple[str, int]] = []
    fresh = 0
    for sentence in SENTENCE_END.split((text or "").strip()):
        length = len(sentence.split())
        if not length:
            continue
        if fresh and sum(n for _, n in current) + length > most:
            chunks.append(" ".join(s for s, _ in current))
            kept: list[tuple[str, int]] = []
            while overlap and len(kept) < len(current):
                previous = current[len(current) - 1 - len(kept)]
                if sum(n for _, n in kept) + previous[1] > overlap:
                    break
                kept.insert(0, previous)
            current, fresh = (kept if sum(n for _, n in kept) + length <= most else []), 0
        current.append((sentence, length))
        fresh += 1
    return chunks + [" ".join(s for s, _ in current)] if fresh else chunks


def chunk_sentences(documents: DataFrame, most: int = 100, overlap: int = 0) -> DataFrame:
    """Whole sentences up to ``most`` words; a longer sentence stands alone."""
    @F.arrow_udf(ArrayType(StringType()))
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in parts(batch):
                yield pa.array([pack_sentences(t, most, overlap) for t in texts.to_pylist()], pa.list_(pa.string()))

    return _unfold(documents, cut("text"))


def chunk_ids(chunks: DataFrame, source: str) -> DataFrame:
    """Chunks with a document id that depends only on the source name."""
    return chunks.withColumn("document_id", F.sha2(F.col(source).cast("string"), 256)).withColumn(
        "chunk_id", F.concat_ws(":", "document_id", "chunk_index"))


def chunk_neighbours(chunks: DataFrame) -> DataFrame:
    """Index of the previous and the next chunk; null at the ends.

    The chunkers number from 0 without gaps and keep the count, so no window is needed.
    """
    at = F.col("chunk_index")
    return chunks.withColumn("previous_chunk_id", F.when(at > 0, at - 1)).withColumn(
        "next_chunk_id", F.when(at + 1 < F.col("n_chunks"), at + 1))
