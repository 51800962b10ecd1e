"""Keyword, excerpt and hybrid search for a table of queries."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from opslake.functions import text as tx
from opslake.operators.ordered import distinct_on, top_per_key
from opslake.operators.vectors import nearest

try:
    import ahocorasick
except ImportError:  # then the search stays a column expression
    ahocorasick = None

# Up to this many queries and characters travel as literals inside the scan; more take the join below.
LITERAL_QUERIES = 2_000
LITERAL_CHARS = 200_000
# Up to this many are plain column expressions; more are matched in one pass per text.
EXPRESSION_QUERIES = 16
GRAM = 3

# Token budget and the (nearest, keyword hits) settings tried in turn; None is no limit.
TOKEN_BUDGET = 30_000
SCHEDULE = [(20, None), (15, 10), (10, 5), (5, 5)]


def keyword_search(corpus: DataFrame, queries: DataFrame, key: str = "doc_id",
                   literal_queries: int = LITERAL_QUERIES) -> DataFrame:
    """(query_id, query, document columns) of every document that contains the query, ignoring case.

    Equal rows of the query table are asked once; documents with a null or repeated key are found like all others. A
    short query table is checked for size and becomes literals, so the search is a narrow pass over the corpus: a
    column expression for a handful of queries, one automaton for more. A longer table is matched through character
    grams. The way never changes the rows.
    """
    asked = queries.where(F.length("query") > 0).select(
        "query_id", "query", F.lower("query").alias("needle")).distinct()
    rows, chars = asked.agg(F.count("*"), F.coalesce(F.sum(F.length("query")), F.lit(0))).first()
    if rows > literal_queries or chars > LITERAL_CHARS:
        return _search_by_grams(corpus, asked.drop("needle"), key)
    few = asked.collect()
    if not few:
        none = F.lit(None)
        return corpus.limit(0).select(none.cast(asked.schema["query_id"].dataType).alias("query_id"),
                                      none.cast("string").alias("query"), *corpus.columns)
    kind = asked.schema["query_id"].dataType
    rows = F.array(*[F.struct(F.lit(r.query_id).cast(kind).alias("query_id"), F.lit(r.query).alias("query"),
                              F.lit(r.needle).alias("needle")) for r in few])
    low = F.lower("text")
    if len(few) > EXPRESSION_QUERIES and ahocorasick is not None:
        found = F.transform(_matcher([r.needle for r in few])(low), lambda i: F.get(rows, i))
    else:
        found = F.filter(rows, lambda q: low.contains(q["needle"]))
    hits = corpus.select(*corpus.columns, F.explode_outer(found).alias("_q")).where(F.col("_q").isNotNull())
    return hits.select("_q.query_id", "_q.query", *corpus.columns)


def _matcher(needles: list[str]):
    """Positions of the needles a text contains, all found in one pass over the text."""
    @F.pandas_udf(ArrayType(IntegerType()))
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        places: dict[str, list[int]] = {}
        for place, needle in enumerate(needles):
            places.setdefault(needle, []).append(place)
        automaton = ahocorasick.Automaton()
        for needle, at in places.items():
            automaton.add_word(needle, at)
        automaton.make_automaton()
        for texts in batches:
            yield texts.map(lambda t: sorted({p for _, at in automaton.iter(t) for p in at}), na_action="ignore")

    return find


def _grams(lowered: Column, n: int = GRAM) -> Column:
    """Distinct character n-grams; a shorter string is its own gram, and a text also yields its shorter ones."""
    chars = F.split(lowered, "")
    last = F.size(chars) - (n - 1)
    return F.array_distinct(F.transform(
        F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(*[F.element_at(chars, i + k) for k in range(n)])))


def _search_by_grams(corpus: DataFrame, queries: DataFrame, key: str) -> DataFrame:
    """Containment through an equi-join: a text holding the query holds each of its grams.

    Every query is looked up under its rarest gram, so common grams gather few queries, and the
    match is verified on the whole text.
    """
    low = F.lower("query")
    asked = queries.withColumn("_needle", low)
    # A hash of key and text names a document, so that null and repeated keys neither vanish nor multiply.
    corpus_rows = corpus.withColumn("_h", F.xxhash64(F.col(key), F.col("text")))
    sizes = [1, 2, GRAM]
    text_grams = F.array_distinct(F.flatten(F.array(*[_grams(F.col("_low"), n) for n in sizes])))
    query_grams = F.when(F.length("_needle") >= GRAM, _grams(F.col("_needle"))).otherwise(F.array("_needle"))
    wanted = asked.select("query_id", "query", "_needle", F.explode(query_grams).alias("gram"))
    held = corpus_rows.select("_h", F.lower("text").alias("_low")).select(
        "_h", F.explode_outer(text_grams).alias("gram")).join(wanted.select("gram").distinct(), "gram", "left_semi")
    frequency = held.groupBy("gram").agg(F.count(F.lit(1)).alias("_documents"))
    rarest = distinct_on(wanted.join(frequency, "gram"), ["query_id", "query"], [F.col("_documents"), F.col("gram")])
    pairs = held.join(rarest.select("gram", "query_id", "query", "_needle"), "gram").drop("gram").distinct()
    return pairs.join(corpus_rows, "_h").where(F.lower("text").contains(F.col("_needle"))).select(
        "query_id", "query", *corpus.columns)


def excerpt_search(documents: DataFrame, queries: DataFrame, width: int = 280, limit: int = 5) -> DataFrame:
    """First matching line of up to ``limit`` documents per query.

    A query without any match gets the first document with score 0.1.
    """
    hits = keyword_search(documents, queries)
    matching = F.filter(F.split("text", "\n"), lambda line: F.lower(line).contains(F.lower("query")))
    excerpt = F.left(F.coalesce(F.get(matching, 0), F.col("text")), F.lit(width))
    best = top_per_key(hits.select("query_id", "query", "doc_id", excerpt.alias("excerpt"), F.lit(1.0).alias("score")),
                       ["query_id"], [F.col("doc_id")], limit)
    first = documents.agg(F.min_by(F.struct("doc_id", F.left("text", F.lit(width)).alias("excerpt")), "doc_id")).scalar()
    missed = queries.join(hits.select("query_id").distinct(), "query_id", "left_anti").select(
        "query_id", "query", first["doc_id"].alias("doc_id"), first["excerpt"].alias("excerpt"),
        F.lit(0.1).alias("score"))
    return best.unionByName(missed)


def hybrid_search(queries: DataFrame, corpus: DataFrame, k: int = 20, threshold: float | None = 0.75,
                  keyword_limit: int | None = None) -> DataFrame:
    """Keyword hits in corpus order, then vector hits by score; one row per (text, url, name) and query.

    ``queries`` has query_id, query and vector; ``corpus`` has doc_id, url, name, text and vector.
    ``part`` 0 is a keyword hit, 1 a vector hit; (part, place, doc_id) is the rank order.
    """
    plain = corpus.select("doc_id", "url", "name", "text")
    words = keyword_search(plain, queries.select("query_id", tx.clean_query(F.col("query")).alias("query")))
    if keyword_limit is not None:
        words = top_per_key(words, ["query_id"], [F.col("doc_id")], keyword_limit)
    by_word = words.select("query_id", "doc_id", "url", "name", "text", F.lit(0).alias("part"),
                           F.col("doc_id").cast("double").alias("place"))
    distinct_texts = corpus.where(F.col("vector").isNotNull()).select("doc_id", "text", "vector")
    near = nearest(queries.select("query_id", "vector"),
                   first_texts(distinct_texts).select(F.col("doc_id").alias("id"), "vector"), k, threshold=threshold)
    by_vector = near.join(plain, near["id"] == plain["doc_id"]).select(
        "query_id", "doc_id", "url", "name", "text", F.lit(1).alias("part"), (-F.col("score")).alias("place"))
    both = by_word.unionByName(by_vector)
    # Copies are settled on a hash of the passage, first hit kept.
    keyed = both.withColumn("_passage", F.sha2(F.to_json(F.struct("text", "url", "name")), 256))
    return distinct_on(keyed, ["query_id", "_passage"],
                       [F.col("part"), F.col("place"), F.col("doc_id")]).drop("_passage")


def first_texts(corpus: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows holding the first occurrence of their text in corpus order."""
    keep = corpus.groupBy(F.sha2("text", 256).alias("_h")).agg(F.min(key).alias(key))
    return corpus.join(keep.select(key), key, "left_semi")


def fit_budget(hits: DataFrame, tokens: Column, budget: int = TOKEN_BUDGET, band_rows: int = 10_000) -> DataFrame:
    """Leading hits of every query whose running token count stays within the budget.

    Hits are ordered by (part, place, doc_id). Ranks come from an aggregate per band of document
    ids for the keyword part, so a query that matches a third of the corpus is not sorted as one
    group: token totals per band are summed first, and only bands that can still fit are ordered.
    """
    band = F.when(F.col("part") == 0, F.floor(F.col("doc_id") / band_rows)).otherwise(F.lit(0)).cast("long")
    costed = hits.withColumn("tokens", tokens).withColumn("_band", band)
    totals = costed.groupBy("query_id", "part", "_band").agg(F.sum("tokens").alias("_t"))
    earlier = Window.partitionBy("query_id").orderBy("part", "_band").rowsBetween(Window.unboundedPreceding, -1)
    spent = totals.select("query_id", "part", "_band", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_spent"))
    open_bands = spent.where(F.col("_spent") <= budget)
    here = Window.partitionBy("query_id", "part", "_band").orderBy("place", "doc_id").rowsBetween(
        Window.unboundedPreceding, 0)
    placed = costed.join(open_bands, ["query_id", "part", "_band"]).withColumn(
        "running_tokens", F.col("_spent") + F.sum("tokens").over(here))
    return placed.where(F.col("running_tokens") <= budget).drop("_band", "_spent")


def schedule_budget(candidates: list[tuple[int, DataFrame]], tokens: Column, budget: int = TOKEN_BUDGET) -> DataFrame:
    """Per query the first candidate setting whose hits fit the budget.

    ``candidates`` are (setting number, hits) in the order tried. A query none of them fits keeps
    the last setting and is flagged.
    """
    numbered = [hits.withColumn("setting", F.lit(no)).withColumn("tokens", tokens) for no, hits in candidates]
    stacked = numbered[0]
    for more in numbered[1:]:
        stacked = stacked.unionByName(more)
    last = candidates[-1][0]
    sums = stacked.groupBy("query_id", "setting").agg(F.sum("tokens").alias("total_tokens"),
                                                      F.count(F.lit(1)).alias("hits"))
    fits = F.min(F.when(F.col("total_tokens") <= budget, F.col("setting")))
    chosen = sums.groupBy("query_id").agg(F.coalesce(fits, F.lit(last)).alias("setting"))
    return sums.join(chosen, ["query_id", "setting"]).withColumn("over_budget", F.col("total_tokens") > budget)
