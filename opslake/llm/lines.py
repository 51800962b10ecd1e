"""Removal of lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm.marks import LEAST
from opslake.session import use_shared_checkpoints

WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys with more than this share of all counted lines go through a shared table, so that it has at most 1 / HOT_SHARE rows.
HOT_SHARE = 1e-4


def normalised(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def line_keys(docs: DataFrame, doc_id: str, text: str, least_chars: int) -> DataFrame:
    """k, h, x, y, places: a row for each distinct key of a document, with its lines' numbers from 0.

    k and h name the document by id (a null is the smallest) and text, x and y the key by 2 x 64 bits of hash.
    """
    named = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LEAST).cast("bigint")).alias("k"),
                        F.xxhash64(F.col(doc_id), F.col(text)).alias("h"), F.col(text).alias("text"))
    lines = named.select("k", "h", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    return (lines.select("k", "h", "place", normalised(F.col("line")).alias("key")).where(F.char_length("key") >= least_chars)
            .select("k", "h", "place", F.xxhash64("key").alias("x"), F.xxhash64(F.lit(1), "key").alias("y")))


def shared_lines(lines: DataFrame, least_docs: int) -> DataFrame:
    """x, y, n, first: keys of at least so many documents, with the number of lines and the smallest document."""
    if least_docs == 2:  # two ids are two documents; no distinct count is needed
        found = lines.groupBy("x", "y").agg(F.count("*").alias("n"), F.min("k").alias("first"), F.max("k").alias("last"))
        return found.where("first < last").drop("last")
    # Spark counts (key, document) by both first, so that no task holds a key's documents.
    found = lines.groupBy("x", "y").agg(F.count("*").alias("n"), F.min("k").alias("first"), F.count_distinct("k").alias("docs"))
    return found.where(F.col("docs") >= least_docs).drop("docs")


def remove_lines(docs: DataFrame, least_docs: int = 2, least_chars: int = 10, doc_id: str = "doc_id", text: str = "text"
                 ) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text: the texts without lines that at least ``least_docs`` documents hold.

    Texts are split at line feeds. Lines are compared without ASCII white space at the ends and with A-Z in lower case; only
    keys of at least ``least_chars`` characters count. The document with the smallest id keeps all its lines of a key; a
    null id is smaller than any other. A null or empty text is one empty line. Rows with one id are one document: they do
    not take lines from each other. Keys are compared by 128 bits of hash. Other columns are not read.
    """
    use_shared_checkpoints(docs.sparkSession)
    lines = line_keys(docs, doc_id, text, least_chars)
    shared = shared_lines(lines, least_docs).checkpoint()
    total = shared.agg(F.sum("n")).head()[0] or 0
    # Lines of very frequent keys are told from the others without a shuffle: there are at most 1 / HOT_SHARE such keys,
    # so all tasks may share them, and no remaining key can fill a task.
    hot = F.col("n") > total * HOT_SHARE
    frequent = F.broadcast(shared.where(hot).select("x", "y", F.col("first").alias("first_hot")))
    rare = shared.where(~hot).select("x", "y", "first")
    # A told line goes through the join with a key of its own, which no other line has, instead of a second scan.
    told = lines.join(frequent, ["x", "y"], "left").withColumn(
        "x", F.when(F.col("first_hot").isNull(), F.col("x")).otherwise(F.xxhash64("k", "h", "place")))
    dropped = told.join(rare, ["x", "y"], "left").where(F.coalesce("first_hot", "first") < F.col("k"))
    places = dropped.groupBy("k", "h").agg(F.collect_set("place").alias("dropped"))
    texts = docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LEAST).cast("bigint")).alias("k"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("h"), F.col(doc_id).alias("doc_id"),
        F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1).alias("lines"))
    n_lines = F.size("lines")
    # array_except finds the places that stay in one pass over both lists.
    stay = F.array_except(F.sequence(F.lit(0), n_lines - 1), "dropped")
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.col("lines")[i]))
    return texts.join(places, ["k", "h"], "left").select(
        "doc_id", n_lines.cast("bigint").alias("n_lines"), F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("bigint").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept_text"))


#: The query of op12 in DuckDB's SQL.
SQL = r"""
WITH lines AS (
    SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
shared AS (SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT l.*, s.first IS NOT NULL AND s.first < l.doc_id AS gone FROM lines l LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
