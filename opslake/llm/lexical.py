"""Ranked lexical search: documents with one bag of searched terms are scored once and expanded afterwards."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.blocks import blocks
from opslake.llm.marks import LEAST
from opslake.session import shared_dir

#: Bytes of item texts that all tasks share at once; more items are asked in parts.
PART_BYTES = 8 << 20
#: Items and classes whose scores are computed together.
ITEM_BLOCK, CLASS_BLOCK = 256, 1024
#: Bytes of a text that are split into words at once.
SLICE_BYTES = 1 << 20
#: Sums below are exact in doubles.
EXACT = float(1 << 53)
#: Digits, letters (upper-case ones as lower-case) and all bytes of non-ASCII characters stay; others separate terms.
TABLE = bytes(b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in order, in lists of about SLICE_BYTES."""
    data = text.translate(TABLE)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def item_parts(items: DataFrame, item_id: str, text: str, most: int) -> list[DataFrame]:
    """The items in parts by a hash of the id, each of at most so many bytes unless it is one item."""
    sized = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"),
                         F.coalesce(F.octet_length(text), F.lit(0)).alias("size"))
    total, largest = sized.agg(F.sum("size"), F.max("size")).head()
    n = 1 if not total else max(1, math.ceil(total / most))
    while n > 1 or (total or 0) > most:
        dealt = sized.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(n))).agg(F.sum("size").alias("size"))
        if dealt.agg(F.max("size")).head()[0] <= max(most, largest):
            break
        n *= 2
    return [sized.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i).select("item_id", "text") for i in range(n)]


def bags(docs: DataFrame, vocabulary, doc_id: str, text: str) -> DataFrame:
    """k, n, bag: each document's number of terms and its (term, occurrences) pairs of the vocabulary, as int32, by term."""
    def count(batches):
        known = vocabulary.value
        for batch, block in blocks(batches):
            n, packed = [], []
            for t in block.texts:
                total, held = 0, Counter()
                for words in terms(t):
                    total += len(words)
                    held.update(words)
                n.append(total)
                pairs = sorted((known[w], c) for w, c in held.items() if w in known)
                packed.append(np.array(pairs, np.int32).tobytes() if pairs else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(packed, pa.binary())], ["k", "n", "bag"])

    return docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LEAST).cast("bigint")).alias("k"), F.col(text).alias("text")
                       ).mapInArrow(count, "k bigint, n bigint, bag binary")


def document_counts(stored: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""
    def partial(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for bag in batch.column(0).to_pylist():
                total[np.frombuffer(bag, np.int32)[::2]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "df"])

    summed = stored.where("bag is not null").select("bag").mapInArrow(partial, "term bigint, df bigint").groupBy("term").agg(F.sum("df"))
    df = np.zeros(size, np.int64)
    for term, n in summed.toLocalIterator():
        df[term] = n
    return df


def item_blocks(asked: list[tuple[int, dict[int, int]]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(item numbers, terms, occurrences of each term in each item) of up to ITEM_BLOCK items."""
    out = []
    for at in range(0, len(asked), ITEM_BLOCK):
        part = asked[at:at + ITEM_BLOCK]
        used = np.unique(np.array([t for _, bag in part for t in bag], np.int64))
        times = np.zeros((len(used), len(part)))
        for column, (_, bag) in enumerate(part):
            times[np.searchsorted(used, list(bag)), column] = list(bag.values())
        out.append((np.array([i for i, _ in part], np.int64), used, times))
    return out


def best_classes(classes: DataFrame, shared, top: int) -> DataFrame:
    """item, score, k, h: of each task the classes that can hold an item's ``top`` documents, named by first document and hash."""
    def score(batches):
        asked, weight = shared.value
        # The bound on a score follows from the bound of the saturated count, which is below 1,000,000.
        exact = [float((times * (weight[used, None] * 1e6)).sum(axis=0).max()) < EXACT if len(used) else True
                 for _, used, times in asked]
        best = [(np.zeros(0, np.int64),) * 4 for _ in asked]
        for batch in batches:
            for a in range(0, batch.num_rows, CLASS_BLOCK):
                part = batch.slice(a, CLASS_BLOCK)
                k, h, m = (np.asarray(part.column(c)) for c in range(3))
                bag = part.column(3).to_pylist()
                pairs = np.frombuffer(b"".join(bag), np.int32).reshape(-1, 2).astype(np.int64)
                row = np.repeat(np.arange(len(bag)), [len(b) // 8 for b in bag])
                term, tf = pairs.T
                value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
                for x, (numbers, used, times) in enumerate(asked):
                    at = np.minimum(np.searchsorted(used, term), len(used) - 1)
                    hit = used[at] == term
                    dense = np.zeros((len(bag), len(used)), float if exact[x] else np.int64)
                    dense[row[hit], at[hit]] = value[hit]
                    scores = (dense @ times.astype(dense.dtype)).astype(np.int64)
                    best[x] = foremost(best[x], scores, numbers, k, h, top)
        for columns in best:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["item", "score", "k", "h"])

    return classes.select("k", "h", "m", "bag").mapInArrow(score, "item bigint, score bigint, k bigint, h bigint")


def foremost(best, scores: np.ndarray, numbers: np.ndarray, k: np.ndarray, h: np.ndarray, top: int):
    """The best rows so far with those of the new scores that are among an item's ``top``, by score and first document."""
    least = np.ones(scores.shape[1], np.int64)
    if len(scores) > top:
        least = np.maximum(least, np.partition(scores, len(scores) - top, axis=0)[len(scores) - top])
    row, column = np.nonzero(scores >= least)
    rows = [np.concatenate(pair) for pair in zip(best, (numbers[column], scores[row, column], k[row], h[row]))]
    order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
    item = rows[0][order]
    return [c[order][np.arange(len(item)) - np.searchsorted(item, item) < top] for c in rows]


def search_part(docs: DataFrame, items: DataFrame, top: int, doc_id: str, text: str) -> DataFrame:
    """``ranked_search`` for items whose texts all tasks can share."""
    spark = docs.sparkSession
    rows = items.collect()
    known: dict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    asked = []
    for number, row in enumerate(rows):
        bag = Counter(known[w] for words in terms((row.text or "").encode()) for w in words)
        if bag:
            asked.append((number, dict(bag)))
    known = dict(known)
    path = shared_dir(spark, "bags")
    bags(docs, spark.sparkContext.broadcast(known), doc_id, text).write.parquet(path)
    stored = spark.read.parquet(path)
    n_docs, n_terms = stored.agg(F.expr("count_if(n > 0)"), F.coalesce(F.sum("n"), F.lit(0))).head()
    df = document_counts(stored, len(known))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    # A class: one bag and one m. Grouping by the bag itself verifies what its hash, the first key, brings together.
    named = stored.where("bag is not null").select(
        F.xxhash64("bag").alias("h"), F.expr(f"100 - 75 + (75 * n * {n_docs}L) div {max(1, n_terms)}L").alias("m"), "bag", "k")
    classes = named.groupBy("h", "m", "bag").agg(F.min("k").alias("k"))
    shared = spark.sparkContext.broadcast((item_blocks(asked), weight))
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), "k", "h")
    path = shared_dir(spark, "classes")
    best_classes(classes, shared, top).withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= top).select(
        "item", "score", "h", F.col("k").alias("first")).write.parquet(path)
    chosen = spark.read.parquet(path)
    # Of each chosen class the ``top`` smallest ids; tasks drop further members before the shuffle.
    by_id = Window.partitionBy("h", "m", "bag").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    members = named.join(chosen.select("h").distinct(), "h", "left_semi").select(
        "h", "k", F.first("k").over(by_id).alias("first"), F.row_number().over(by_id).alias("place")).where(F.col("place") <= top)
    ranked = chosen.join(members, ["h", "first"]).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], items.select(F.lit(0).alias("item"), "item_id").schema)
    back = F.when(F.col("k") != LEAST, F.col("k")).cast(docs.schema[doc_id].dataType)
    return ranked.join(ids, "item").select("item_id", "rank", back.alias("doc_id"), "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 10, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", most: int = PART_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item with a score above 0; equal ones by ascending id.

    Terms are runs of ASCII digits and letters, in lower case, and of characters beyond ASCII. A term weighs
    floor(1000 ln((2 N + 2) / (2 df + 1))), where N documents have terms and df hold this one. With n terms in a document
    of N that have L together, m = 25 + 75 n N div L; a term that occurs tf times in it gives its weight times
    1000000000 tf div (1000 tf + 8 m), once for each time the item holds it.

    Null and empty texts have no terms: such documents count nowhere, such items have no rows. Repeated documents are
    documents of their own; a null id stands before all others. Items that share an id are ranked apart. Other columns
    are not read. Items beyond ``most`` bytes are asked in parts, each of them over all documents.
    """
    parts = item_parts(items, item_id, item_text, most)
    return reduce(DataFrame.unionByName, [search_part(docs, part, top, doc_id, text) for part in parts])


#: The query of op13 in DuckDB's SQL.
SQL = r"""
WITH found AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM documents),
asked AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark) GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM found GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
shapes AS (SELECT doc_id, 100 - 75 + (75 * n * docs) // terms AS m FROM sizes, whole),
held AS (SELECT doc_id, term, count(*) AS tf FROM found WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM held GROUP BY term), whole),
scores AS (
    SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN shapes USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
