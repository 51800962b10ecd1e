"""Cleaning, filtering, stacking, counting and grouping of a text corpus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslake.functions import text as tx
from opslake.functions.quantiles import exact_quantiles
from opslake.operators.ordered import top_per_key


def filter_length(corpus: DataFrame, min_chars: int = tx.MIN_PARAGRAPH, more_words_than: int = 5) -> DataFrame:
    body = F.col("text")
    return corpus.where((F.trim(body) != "") & (F.length(body) >= min_chars) & (tx.word_count(body) > more_words_than))


def drop_self_named(corpus: DataFrame) -> DataFrame:
    same = F.col("text").eqNullSafe(F.col("name")) | F.col("text").eqNullSafe(F.col("type"))
    return corpus.where(~same)


def drop_numeric_rows(corpus: DataFrame) -> DataFrame:
    """Without rows of digits and punctuation only, and without rows holding at most one word."""
    return corpus.where(~tx.is_numeric_row(F.col("text")) & (tx.letter_words(F.col("text")) > 1))


def exact_dedup(corpus: DataFrame, order: str = "doc_id") -> DataFrame:
    """One row per text, the first by ``order``.

    The copies are settled on (hash, id) pairs in a partial aggregate, so a text that fills a
    third of the corpus costs one row per map task. Texts themselves are moved only for the kept ids.
    """
    keep = corpus.groupBy(F.sha2("text", 256).alias("_h")).agg(F.min(order).alias(order))
    return corpus.join(keep.select(order), order, "left_semi")


def union_corpus(parts: list[DataFrame]) -> DataFrame:
    """Files with differing column names as one corpus of url, type, name and text."""
    named = [p.withColumnsRenamed({"title": "name", "typeName": "type"}) for p in parts]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    return stacked.select("url", "type", F.coalesce("name", F.lit("-")).alias("name"), "text")


def union_documents(manuals: DataFrame, incidents: DataFrame) -> DataFrame:
    """Manuals and incident reports as one document table with a source tag."""
    left = manuals.select("id", F.coalesce("title", F.lit("")).alias("title"), F.col("content").alias("text"),
                          "device_id", "severity", F.lit("manual").alias("source"))
    right = incident_documents(incidents)
    return left.unionByName(right)


def incident_documents(incidents: DataFrame) -> DataFrame:
    """Incident text: title, description and, where there is one, the resolution."""
    body = F.concat(
        "title", F.lit(". "), "description",
        F.when(F.coalesce("resolution", F.lit("")) != "", F.concat(F.lit(" Resolution: "), "resolution")).otherwise(""))
    return incidents.select(F.col("incident_id").cast("string").alias("id"), "title", body.alias("text"),
                            "device_id", "severity", F.lit("incident").alias("source"))


def payload(documents: DataFrame, width: int = 1000) -> DataFrame:
    """Document rows with the text cut to the width a search payload stores."""
    return documents.withColumn("text", F.left("text", F.lit(width)))


def union_hits(documents: DataFrame, chunks: DataFrame, query: str, limit: int) -> DataFrame:
    """Title matches, then chunk matches, as one tagged result."""
    needle = F.lit(query.lower())
    titles = documents.where(F.lower("title").contains(needle)).select(
        F.lit("document").alias("kind"), F.lit(0).alias("_k"), F.col("doc_id"), F.lit(-1).alias("chunk_index"),
        F.col("title").alias("content"))
    bodies = chunks.where(F.lower("content").contains(needle)).select(
        F.lit("chunk").alias("kind"), F.lit(1).alias("_k"), "doc_id", "chunk_index", "content")
    return titles.unionByName(bodies).orderBy("_k", "doc_id", "chunk_index").limit(limit).drop("_k")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.col("rows").desc(), column)


def distinct_counts(corpus: DataFrame) -> DataFrame:
    """Distinct urls, names and lower-cased words. Words are made distinct per document first."""
    columns = corpus.agg(F.countDistinct("url").alias("urls"), F.countDistinct("name").alias("names"))
    found = corpus.select(F.explode_outer(F.array_distinct(tx.words(F.lower("text")))).alias("w"))
    return columns.withColumn("words", found.agg(F.countDistinct("w")).scalar())


def describe_lengths(corpus: DataFrame) -> DataFrame:
    """Count, mean, deviation and quartiles of words per document."""
    counted = corpus.select(tx.word_count(F.col("text")).alias("n"))
    basics = counted.agg(
        F.count("n").alias("count"), F.avg("n").alias("mean"), F.stddev_samp("n").alias("std"),
        F.min("n").alias("min"), F.max("n").alias("max"))
    quartiles = exact_quantiles(counted, [], F.col("n"), {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    row = quartiles.select(F.struct("q25", "q50", "q75")).scalar()
    return basics.withColumns({q: row[q] for q in ("q25", "q50", "q75")})


def profile(corpus: DataFrame) -> DataFrame:
    """Characters, words, sentence marks and mean word length of every document."""
    body, n = F.col("text"), tx.word_count(F.col("text"))
    letters = F.length(F.regexp_replace(body, r"\s+", ""))
    return corpus.select(
        "doc_id", F.length(body).alias("chars"), n.alias("words"),
        F.greatest(F.regexp_count(body, F.lit("[.!?]")), F.lit(1)).alias("sentences"),
        F.round(letters / F.greatest(n, F.lit(1)), 2).alias("avg_word_len"))


def profile_total(per_document: DataFrame) -> DataFrame:
    return per_document.agg(
        F.count(F.lit(1)).alias("documents"), F.sum("chars").alias("chars"), F.sum("words").alias("words"),
        F.sum("sentences").alias("sentences"))


def unique_words(corpus: DataFrame) -> DataFrame:
    return corpus.select("doc_id", F.size(F.array_distinct(tx.words(F.col("text")))).alias("unique_words"))


def build_vocab(corpus: DataFrame, min_count: int = 10, size: int = 100_000, drop_pieces: bool = True) -> DataFrame:
    """Frequent words behind the special tokens, numbered from 0; ties go by the word."""
    counts = corpus.select(F.explode_outer(tx.words(F.lower("text"))).alias("token")).where(
        F.col("token").isNotNull()).groupBy("token").agg(
        F.count(F.lit(1)).alias("frequency")).where(F.col("frequency") >= min_count)
    if drop_pieces:
        counts = counts.where(~F.col("token").contains("##"))
    head = len(tx.SPECIAL_TOKENS)
    best = counts.orderBy(F.col("frequency").desc(), "token").limit(size - head)
    # At most ``size`` rows are left, so numbering them in one task is bounded.
    rank = F.row_number().over(Window.orderBy(F.col("frequency").desc(), "token"))
    numbered = best.select("token", (rank + (head - 1)).alias("token_id"), "frequency")
    specials = F.array(*[
        F.struct(F.lit(t).alias("token"), F.lit(i).alias("token_id"), F.lit(0).cast("long").alias("frequency"))
        for i, t in enumerate(tx.SPECIAL_TOKENS)])
    return corpus.sparkSession.range(1).select(F.inline(specials)).unionByName(numbered)


def vocabulary(corpus: DataFrame) -> DataFrame:
    return corpus.select(F.explode_outer(F.array_distinct(tx.words(F.lower("text")))).alias("token")).where(
        F.col("token").isNotNull()).distinct()


def vocab_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Tokens of one vocabulary that the other does not have."""
    return left.select("token").subtract(right.select("token"))


def apply_canonical(corpus: DataFrame, mapping: DataFrame, column: str = "name") -> DataFrame:
    """Labels replaced by their standard form (variant, canonical) where one is given."""
    forms = mapping.select(F.col("variant").alias("_variant"), "canonical")
    return corpus.join(forms, F.col(column) == F.col("_variant"), "left").withColumn(
        column, F.coalesce("canonical", F.col(column))).drop("_variant", "canonical")


def sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    return df.where(tx.share_below(F.col(key), fraction, seed))


def split_train_val(df: DataFrame, key: str, fraction: float = 0.8, seed: int = 0) -> DataFrame:
    inside = tx.share_below(F.col(key), fraction, seed)
    return df.withColumn("split", F.when(inside, "train").otherwise("val"))


def balance_labels(pairs: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """At most ``n`` rows per (query, label), picked by the hash of their key."""
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return top_per_key(pairs, ["query", "label"], [shuffled, F.col(key)], n)
