"""From raw documents to packed sequences: five stages, each one of the operators of ``opslake.llm``.

Every stage but the last takes and gives rows with the columns of ``documents``; the last gives the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.llm import decontam, langid, neardup, packing, suffix
from opslake.session import shared_dir, use_shared_checkpoints


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are in no language."""
    return langid.keep_languages(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    return neardup.keep_first(docs)


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts 100-byte strings that start earlier out of the texts and counts the characters anew."""
    return suffix.cut_texts(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a part of the benchmark."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences of 2048."""
    use_shared_checkpoints(spark)
    pieces = packing.encode_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")).checkpoint())


STAGES = [("language_id", language), ("minhash_neardup", near_duplicates), ("suffix_dedup", repeated_bytes),
          ("decontamination", benchmark), ("best_fit_packing", sequences)]

#: SQL cannot express the stages; tests/llm/test_models.py and tests/llm/test_pipeline.py hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are stored in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stored = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(stored)
        docs = spark.read.parquet(stored)
    return docs
