"""Queries over vectors, search and the chunk graph."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from opslake import inputs as src
from opslake.functions import text as tx
from opslake.functions import vector as vec
from opslake.operators import chunking, graph, search, sessions, vectors
from opslake.plans.catalog import VIEWS, WORDS, oracle, query

VIEWS["scores"] = (["query_vectors", "corpus_vectors"], """
    SELECT query_id, id, collection, round(list_cosine_similarity(q, v), 6) AS score,
           round(list_inner_product(q, v), 6) AS dot, -round(list_distance(q, v) ** 2, 6) AS l2
    FROM query_vectors, corpus_vectors""")
VIEWS["keyword_hits"] = (["terms", "corpus"], """
    SELECT query_id, query, doc_id, url, name, text FROM terms JOIN corpus ON contains(lower(text), lower(query))
    WHERE length(query) > 0""")
VIEWS["search_queries"] = (["terms", "item_vectors"], """
    SELECT t.query_id, trim(regexp_replace(t.query, '[\\d!?.,;]*$', '')) AS query FROM terms t JOIN item_vectors v
        ON v.query_id = t.query_id""")
VIEWS["hybrid"] = (["terms", "search_queries", "item_vectors", "corpus_vectors", "corpus"], """
    SELECT query_id, doc_id, url, name, text, part, place FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id, text, url, name ORDER BY part, place, doc_id) AS rn FROM (
            SELECT q.query_id, c.doc_id, c.url, c.name, c.text, 0 AS part, CAST(c.doc_id AS DOUBLE) AS place
            FROM search_queries q JOIN corpus c ON contains(lower(c.text), lower(q.query))
            UNION ALL
            SELECT query_id, doc_id, url, name, text, 1, -score FROM (
                SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS place_no FROM (
                    SELECT q.query_id, c.*, round(list_cosine_similarity(q.q, v.v), 6) AS score
                    FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS copy
                          FROM corpus JOIN corpus_vectors ON id = doc_id) c
                    JOIN corpus_vectors v ON v.id = c.doc_id, item_vectors q JOIN terms t ON t.query_id = q.query_id
                    WHERE c.copy = 1)
                WHERE score >= 0.2) WHERE place_no <= 20)) WHERE rn = 1""")


def ranked(score: str, k: int, where: str = "TRUE", source: str = "scores") -> str:
    return f"""SELECT query_id, id, s AS score, rn AS rank FROM (
        SELECT query_id, id, {score} AS s, row_number() OVER (PARTITION BY query_id ORDER BY {score} DESC, id) AS rn
        FROM {source} WHERE {where}) WHERE rn <= {k}"""


HIT = "query_id id score:r rank:i"


def docs(spark, sf):
    return src.table(spark, sf, "documents")


def chunks(spark, sf):
    return chunking.chunk_words(docs(spark, sf))


# Vectors

BYTES = ("list_transform(range(0, {n}), lambda i: CAST('0x' || substr(sha256({text}), CAST(i * 2 + 1 AS BIGINT), 2) "
         "AS INTEGER) / 255.0e0)")


@query("hash_embed", oracle("doc_id raw first:r last:r", f"""
    SELECT doc_id, array_to_string(list_transform(list_slice(raw, 1, 16),
               lambda x: CAST(CAST(round(x * 255) AS INTEGER) AS VARCHAR)), ',') AS raw,
           raw[1] / sqrt(list_inner_product(raw, raw)) AS first, raw[32] / sqrt(list_inner_product(raw, raw)) AS last
    FROM (SELECT doc_id, {BYTES.format(n=32, text='text')} AS raw FROM documents)"""))
def _(spark, sf):
    unit, raw = vec.hash_embed(F.col("text")), vec.hash_embed(F.col("text"), 16, unit=False)
    embedded = docs(spark, sf).select("doc_id", unit.alias("unit"), raw.alias("raw"))
    return embedded.select(
        "doc_id", F.transform("raw", lambda x: F.round(x * 255).cast("int")).alias("raw"),
        F.element_at("unit", 1).alias("first"), F.element_at("unit", 32).alias("last"))


@query("embed_batch", oracle("doc_id first:r norm:r", f"""
    SELECT doc_id, CAST(raw[1] / sqrt(list_inner_product(raw, raw)) AS FLOAT) AS first, 1.0e0 AS norm
    FROM (SELECT doc_id, {BYTES.format(n=32, text='text')} AS raw FROM documents)"""))
def _(spark, sf):
    embed = vec.model_embed(vec.hash_encoder)
    rows = docs(spark, sf).select("doc_id", embed("text").alias("embedding"))
    norm = F.round(F.sqrt(vec.dot(F.col("embedding"), F.col("embedding"))), 5)
    return rows.select("doc_id", F.element_at("embedding", 1).alias("first"), norm.alias("norm"))


@query("cosine", oracle("id similarity:r", """
    SELECT a.vec_id AS id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""))
def _(spark, sf):
    rows = src.table(spark, sf, "embeddings")
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return rows.join(after, "vec_id").select(
        F.col("vec_id").alias("id"), vec.cosine(F.col("embedding"), F.col("other")).alias("similarity"))


@query("topk_cosine", oracle(HIT, ranked("score", 5, "score >= 0.2"), "scores"))
def _(spark, sf):
    return vectors.nearest(src.query_vectors(spark, sf), src.corpus_vectors(spark, sf), 5, threshold=0.2)


@query("rank_dot", oracle(HIT, ranked("dot", 50), "scores"))
def _(spark, sf):
    return vectors.nearest(src.query_vectors(spark, sf), src.corpus_vectors(spark, sf), 50, metric="dot")


@query("topk_cosine_distinct", oracle(HIT, ranked("score", 20, "score >= 0.2 AND id IN (SELECT min(d.doc_id) FROM "
       "documents d JOIN corpus_vectors v ON v.id = d.doc_id GROUP BY d.text)"), "scores"))
def _(spark, sf):
    texts = docs(spark, sf).select("doc_id", "text")
    known = src.corpus_vectors(spark, sf).join(texts, F.col("id") == F.col("doc_id"))
    first = search.first_texts(known).select("id", "vector")
    return vectors.nearest(src.query_vectors(spark, sf), first, 20, threshold=0.2)


@query("topk_l2", oracle(HIT, ranked("l2", 15), "scores"))
def _(spark, sf):
    return vectors.nearest(src.query_vectors(spark, sf), src.corpus_vectors(spark, sf), 15, metric="l2")


@query("topk_l2_sources", oracle("query_id sources:a", f"""
    SELECT query_id, list_sort(list(DISTINCT 'label-' || CAST(collection AS VARCHAR))) AS sources
    FROM ({ranked('l2', 15)}) JOIN corpus_vectors USING (id) GROUP BY query_id""", "scores"))
def _(spark, sf):
    rows = src.corpus_vectors(spark, sf)
    hits = vectors.nearest(src.query_vectors(spark, sf), rows, 15, metric="l2")
    named = rows.withColumn("source", F.concat(F.lit("label-"), F.col("collection").cast("string")))
    return vectors.nearest_sources(hits, named, "source")


@query("payload_filter", oracle(HIT, ranked("score", 5, "collection = 3"), "scores"))
def _(spark, sf):
    rows = vectors.within_collection(src.corpus_vectors(spark, sf), 3)
    return vectors.nearest(src.query_vectors(spark, sf), rows, 5)


@query("upsert_vectors", oracle("id collection:i first:r", """
    SELECT id, CASE WHEN id % 5 = 0 THEN 99 ELSE collection END AS collection,
           CASE WHEN id % 5 = 0 THEN -v[1] ELSE v[1] END AS first FROM corpus_vectors
    UNION ALL SELECT 1000000 + query_id, 99, q[1] FROM query_vectors""", "corpus_vectors", "query_vectors"))
def _(spark, sf):
    store = src.corpus_vectors(spark, sf)
    changed = store.where("id % 5 = 0").withColumn("collection", F.lit(99)).withColumn(
        "vector", F.transform("vector", lambda x: -x))
    new = src.query_vectors(spark, sf).select(
        (F.col("query_id") + 1_000_000).alias("id"), "vector", F.lit(99).alias("collection"))
    rows = vectors.upsert_vectors(store, changed.unionByName(new))
    return rows.select("id", "collection", F.element_at("vector", 1).alias("first"))


@query("index_status", oracle("collection:i points:i vectors:i", """
    SELECT label AS collection, count(*) AS points, count(embedding) AS vectors FROM embeddings GROUP BY 1"""))
def _(spark, sf):
    stored = src.table(spark, sf, "embeddings").select(F.col("label").alias("collection"), F.col("embedding").alias("vector"))
    return vectors.index_status(stored)


@query("ann_candidates")
def _(spark, sf):
    return vectors.ann_candidates(src.query_vectors(spark, sf), src.corpus_vectors(spark, sf), 10)


# Search

@query("clean_query", oracle("query_id query", """
    SELECT item_id AS query_id, trim(regexp_replace(text, '[\\d!?.,;]*$', '')) AS query FROM benchmark"""))
def _(spark, sf):
    return src.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), tx.clean_query(F.col("text")).alias("query"))


@query("keyword_search", oracle("query_id query doc_id", "SELECT * FROM keyword_hits", "keyword_hits"))
def _(spark, sf):
    return search.keyword_search(src.corpus(spark, sf), src.search_terms(spark, sf)).select(
        "query_id", "query", "doc_id")


@query("excerpt_search", oracle("query_id query doc_id excerpt score:r", """
    SELECT query_id, query, doc_id, left(coalesce(list_filter(string_split(text, chr(10)),
               lambda l: contains(lower(l), lower(query)))[1], text), 280) AS excerpt, 1.0e0 AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS rn FROM keyword_hits) WHERE rn <= 5
    UNION ALL SELECT query_id, query, (SELECT min(doc_id) FROM documents),
                     (SELECT left(arg_min(text, doc_id), 280) FROM documents), 0.1e0
    FROM terms WHERE query_id NOT IN (SELECT query_id FROM keyword_hits)""", "keyword_hits"))
def _(spark, sf):
    return search.excerpt_search(docs(spark, sf), src.search_terms(spark, sf))


def hybrid(spark, sf, k=20, keyword_limit=None):
    asked = src.search_terms(spark, sf).join(src.item_vectors(spark, sf), "query_id")
    embedded = src.corpus_vectors(spark, sf).select(F.col("id").alias("doc_id"), "vector")
    corpus = src.corpus(spark, sf).join(embedded, "doc_id", "left")
    return search.hybrid_search(asked, corpus, k, threshold=0.2, keyword_limit=keyword_limit)


@query("hybrid_search", oracle("query_id doc_id part:i place:r", "SELECT * FROM hybrid", "hybrid"))
def _(spark, sf):
    return hybrid(spark, sf).select("query_id", "doc_id", "part", "place")


FITTING = f"""SELECT * FROM (SELECT *, sum(tokens) OVER (PARTITION BY query_id ORDER BY part, place, doc_id
        ROWS UNBOUNDED PRECEDING) AS running_tokens FROM (SELECT *, len({WORDS}) AS tokens FROM hybrid))
    WHERE running_tokens <= 3000"""


def fitting(spark, sf):
    return search.fit_budget(hybrid(spark, sf), tx.word_count(F.col("text")), 3000)


@query("token_budget", oracle("query_id doc_id tokens:i running_tokens:i", FITTING, "hybrid"))
def _(spark, sf):
    return fitting(spark, sf).select("query_id", "doc_id", "tokens", "running_tokens")


def setting(number: int, k: int, limit: str) -> str:
    """Hits of one setting: keyword hits up to the limit, vector hits up to k, one per passage."""
    return f"""SELECT {number} AS setting, query_id, sum(tokens) AS total_tokens, count(*) AS hits FROM (
        SELECT DISTINCT query_id, doc_id, len({WORDS}) AS tokens FROM (
            SELECT * FROM (SELECT q.query_id, c.doc_id, c.text, row_number() OVER (
                PARTITION BY q.query_id ORDER BY c.doc_id) AS n
                FROM search_queries q JOIN corpus c ON contains(lower(c.text), lower(q.query))) WHERE n <= {limit}
            UNION ALL
            SELECT * FROM (SELECT query_id, doc_id, text, row_number() OVER (
                    PARTITION BY query_id ORDER BY score DESC, doc_id) AS n FROM (
                SELECT q.query_id, c.doc_id, c.text, round(list_cosine_similarity(q.q, c.v), 6) AS score
                FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS copy
                      FROM corpus JOIN corpus_vectors ON id = doc_id) c, item_vectors q JOIN terms t
                    ON t.query_id = q.query_id WHERE c.copy = 1)
                WHERE score >= 0.2) WHERE n <= {k})) GROUP BY query_id"""


STEPS = " UNION ALL ".join(setting(i, k, str(n or 1000000000)) for i, (k, n) in enumerate(search.SCHEDULE))


@query("token_budget_steps", oracle("query_id setting:i total_tokens:i hits:i over_budget:b", f"""
    SELECT s.*, total_tokens > 4000 AS over_budget FROM ({STEPS}) s JOIN (
        SELECT query_id, coalesce(min(setting) FILTER (WHERE total_tokens <= 4000), 3) AS setting
        FROM ({STEPS}) GROUP BY query_id) USING (query_id, setting)""",
    "terms", "search_queries", "corpus", "item_vectors", "corpus_vectors"))
def _(spark, sf):
    tried = [(i, hybrid(spark, sf, k, n).select("query_id", "text")) for i, (k, n) in enumerate(search.SCHEDULE)]
    return search.schedule_budget(tried, tx.word_count(F.col("text")), 4000)


@query("prompt_build", oracle("query_id prompt", f"""
    SELECT query_id, 'User Query: ' || any_value(q.query) || chr(10) || chr(10) || 'Retrieved Text Passages:' || chr(10)
        || chr(10) || string_agg('Document Name: ' || name || chr(10) || 'Text: ' || text || chr(10) || 'URL: ' || url
        || chr(10) || repeat('-', 50) || chr(10), '' ORDER BY part, place, doc_id) AS prompt
    FROM ({FITTING}) JOIN search_queries q USING (query_id) GROUP BY query_id""", "hybrid"))
def _(spark, sf):
    # What fits the budget is bounded, so the rank within a query is too.
    order = Window.partitionBy("query_id").orderBy("part", "place", "doc_id")
    hits = fitting(spark, sf).withColumn("rank", F.row_number().over(order))
    asked = src.search_terms(spark, sf).select("query_id", tx.clean_query(F.col("query")).alias("query"))
    return sessions.build_prompts(hits.join(asked, "query_id"))


@query("source_context", oracle("query_id context", """
    SELECT query_id, string_agg('[Source: ' || CAST(id AS VARCHAR) || ']' || chr(10) || text, chr(10) || chr(10)
        ORDER BY rn) AS context FROM (
        SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rn FROM scores)
    JOIN documents ON doc_id = id WHERE rn <= 3 GROUP BY query_id""", "scores"))
def _(spark, sf):
    hits = vectors.nearest(src.query_vectors(spark, sf), src.corpus_vectors(spark, sf), 3)
    texts = docs(spark, sf).select(F.col("doc_id").alias("id"), "text")
    return sessions.build_source_context(hits.join(texts, "id").withColumn("source_id", F.col("id").cast("string")))


# Chunk graph

@query("adjacent_pairs", oracle("doc_id src:i dst:i type", """
    SELECT a.doc_id, a.chunk_index AS src, b.chunk_index AS dst,
           CASE WHEN b.chunk_index > a.chunk_index THEN 'NEXT' ELSE 'PREVIOUS' END AS type
    FROM chunks a JOIN chunks b ON a.doc_id = b.doc_id AND abs(a.chunk_index - b.chunk_index) = 1""", "chunks"))
def _(spark, sf):
    return graph.adjacent_pairs(chunks(spark, sf))


@query("same_doc_pairs", oracle("doc_id n_chunks:i n_pairs:i", """
    SELECT a.doc_id, count(DISTINCT a.chunk_index) AS n_chunks, count(b.chunk_index) AS n_pairs
    FROM chunks a LEFT JOIN chunks b ON a.doc_id = b.doc_id AND a.chunk_index < b.chunk_index GROUP BY a.doc_id""",
    "chunks"))
def _(spark, sf):
    return graph.same_document(chunks(spark, sf))


@query("build_chunk_graph", oracle("doc_id src:i dst:i type", """
    SELECT a.doc_id, a.chunk_index AS src, b.chunk_index AS dst,
           CASE WHEN b.chunk_index > a.chunk_index THEN 'NEXT' ELSE 'PREVIOUS' END AS type
    FROM chunks a JOIN chunks b ON a.doc_id = b.doc_id AND abs(a.chunk_index - b.chunk_index) = 1
    UNION ALL SELECT doc_id, chunk_index, NULL, 'SAME_DOCUMENT' FROM chunks""", "chunks"))
def _(spark, sf):
    return graph.build_graph(chunks(spark, sf))[1]


@query("graph_summary", oracle("type n:i", """
    SELECT 'Chunk' AS type, count(*) AS n FROM chunks UNION ALL SELECT 'SAME_DOCUMENT', count(*) FROM chunks
    UNION ALL SELECT unnest(['NEXT', 'PREVIOUS']), (SELECT sum(n_chunks - 1) FROM (
        SELECT doc_id, count(*) AS n_chunks FROM chunks GROUP BY 1))""", "chunks"))
def _(spark, sf):
    return graph.graph_summary(*graph.build_graph(chunks(spark, sf)))


def seeds(spark, sf):
    return chunks(spark, sf).where("chunk_index = 2").select("doc_id", "chunk_index")


EXPANDED = """SELECT a.doc_id, a.chunk_index AS seed, b.chunk_index, md5(b.text) AS text_hash FROM chunks a
    JOIN chunks b ON a.doc_id = b.doc_id WHERE a.chunk_index = 2 AND {}"""
NEAR = "doc_id seed:i chunk_index:i text_hash"


@query("expand_next", oracle(NEAR, EXPANDED.format("b.chunk_index BETWEEN 3 AND 4"), "chunks"))
def _(spark, sf):
    rows = graph.expand(seeds(spark, sf), chunks(spark, sf), 2, "next")
    return rows.select("doc_id", "seed", "chunk_index", F.md5("text").alias("text_hash"))


@query("expand_previous", oracle(NEAR, EXPANDED.format("b.chunk_index BETWEEN 0 AND 1"), "chunks"))
def _(spark, sf):
    rows = graph.expand(seeds(spark, sf), chunks(spark, sf), 2, "previous")
    return rows.select("doc_id", "seed", "chunk_index", F.md5("text").alias("text_hash"))


@query("expand_same_document", oracle(NEAR, EXPANDED.format("b.chunk_index <> 2"), "chunks"))
def _(spark, sf):
    rows = graph.expand_same_document(seeds(spark, sf), chunks(spark, sf))
    return rows.select("doc_id", "seed", "chunk_index", F.md5("text").alias("text_hash"))


@query("graph_reach", """
    WITH RECURSIVE one AS (SELECT DISTINCT 'P' || CAST(l_partkey AS VARCHAR) AS src, 'S' || CAST(l_suppkey AS VARCHAR) AS dst,
                                  l_partkey FROM lineitem),
    edges AS (SELECT src, dst FROM one UNION SELECT dst, src FROM one),
    walk AS (SELECT DISTINCT src AS seed, src AS node, 0 AS distance FROM one WHERE l_partkey % 20 = 0
             UNION SELECT seed, dst, distance + 1 FROM walk JOIN edges ON src = node WHERE distance < 2)
    SELECT seed, node, CAST(min(distance) AS BIGINT) AS distance FROM walk GROUP BY seed, node HAVING min(distance) > 0""")
def _(spark, sf):
    """Parts and suppliers by the order lines that bring them together: a graph of branches and cycles. Every twentieth part asks."""
    lines = src.table(spark, sf, "lineitem")
    part = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    one = lines.select(part.alias("src"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("dst"))
    edges = one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return graph.reach(lines.where("l_partkey % 20 = 0").select(part.alias("src")), edges, 2)


@query("graph_context", oracle("query_id doc_id context:a siblings:i", f"""
    SELECT t.query_id, t.doc_id, list_sort(list(c.chunk_index)) AS context, any_value(n.n) - 1 AS siblings
    FROM (SELECT * FROM (SELECT query_id, doc_id, chunk_index, row_number() OVER (
              PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_index) AS rn
          FROM (SELECT q.query_id, c.doc_id, c.chunk_index, round(list_cosine_similarity(q.e, c.e), 6) AS score
                FROM (SELECT query_id, {BYTES.format(n=32, text='query')} AS e FROM terms) q,
                     (SELECT doc_id, chunk_index, {BYTES.format(n=32, text='text')} AS e FROM chunks) c))
          WHERE rn = 1) t
    JOIN chunks c ON c.doc_id = t.doc_id AND c.chunk_index BETWEEN t.chunk_index - 2 AND t.chunk_index + 2
    JOIN (SELECT doc_id, count(*) AS n FROM chunks GROUP BY 1) n ON n.doc_id = t.doc_id
    GROUP BY t.query_id, t.doc_id""", "terms", "chunks"))
def _(spark, sf):
    # Ids are texts of fixed width, so their order is that of (document, chunk).
    nodes = chunks(spark, sf)
    key = F.concat(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit(":"), F.lpad(F.col("chunk_index").cast("string"), 10, "0"))
    corpus = nodes.select(key.alias("id"), vec.hash_embed(F.col("text")).alias("vector"))
    asked = src.search_terms(spark, sf).select("query_id", vec.hash_embed(F.col("query")).alias("vector"))
    part = F.split("id", ":")
    top = vectors.nearest(asked, corpus, 1).select(
        "query_id", part[0].cast("bigint").alias("doc_id"), part[1].cast("int").alias("chunk_index"))
    return graph.graph_context(top, nodes)
