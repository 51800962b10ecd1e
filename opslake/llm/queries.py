"""One query for each operator, with production parameters over the whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.llm import (
    decontam, fertility, langid, lexical, lines, neardup, packing, periods, quality, substrings, suffix, suffix_tree,
    token_counts)
from opslake.session import use_shared_checkpoints


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = suffix_tree.score_texts(table(spark, sf_dir, "documents"), share(5) != 1)
    return scored.withColumn("held_out", share(5) == 1)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, docs.where(share(3) != 1))
    return found.select("doc_id", (share(3) == 1).alias("held_out"), "lang_pred", "score", "phrase_rate")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix.remove_earlier(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_shared_checkpoints(spark)
    pieces = packing.encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    stored = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")).checkpoint()
    return packing.pack(stored)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.classify(docs, docs.where(share(5) != 0), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (share(5) == 0).alias("held_out"), "score", "predicted")


def op8_tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.fertility_rules(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(periods.with_periods(table(spark, sf_dir, "documents")))
    best = found.withColumn("best", periods.strongest(F.col("runs")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda r: F.concat(r, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.remove_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_tree_lm, op2_language_id, op3_token_counts, op4_suffix_dedup, op5_minhash_neardup, op6_best_fit_packing,
    op7_quality_classifier, op8_tokenizer_fertility, op9_substring_dedup, op10_decontamination, op11_periodic_runs,
    op12_line_dedup, op13_lexical_search)}
ORACLES: dict[str, str] = {
    "op10_decontamination": decontam.SQL, "op12_line_dedup": lines.SQL, "op13_lexical_search": lexical.SQL}
