"""Queries over the text corpus: sets, cleaning, counting, chunking, page extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslake import inputs as src
from opslake.functions import text as tx
from opslake.operators import chunking, corpus as cp, fuzzy, ordered, similar
from opslake.plans.catalog import WORDS, oracle, query
from opslake.sources import files, pages

SPACED = "trim(regexp_replace(replace(text, chr(160), ' '), '\\s+', ' ', 'g'))"


def docs(spark, sf):
    return src.table(spark, sf, "documents")


def manuals(spark, sf):
    """Manuals made of documents; every third one has its body under another name, as older files do."""
    return docs(spark, sf).select(
        F.concat(F.lit("m"), F.col("doc_id").cast("string")).alias("id"),
        F.concat(F.lit("Manual "), F.col("source")).alias("title"), F.col("text").alias("content"),
        F.lit(None).cast("string").alias("device_id"), F.lit("low").alias("severity"))


INCIDENT_DOCS = """
    SELECT CAST(incident_id AS VARCHAR) AS id, title, title || '. ' || description || CASE
               WHEN coalesce(resolution, '') <> '' THEN ' Resolution: ' || resolution ELSE '' END AS text,
           device_id, severity, 'incident' AS source FROM incidents"""


# Sets, distinct rows, samples

@query("union_docs", oracle("id title text_hash device_id severity source", f"""
    SELECT id, title, md5(text) AS text_hash, device_id, severity, source FROM (
        SELECT 'm' || CAST(doc_id AS VARCHAR) AS id, 'Manual ' || source AS title, text, NULL AS device_id,
               'low' AS severity, 'manual' AS source FROM documents UNION ALL {INCIDENT_DOCS})""", "incidents"))
def _(spark, sf):
    rows = cp.union_documents(manuals(spark, sf), src.incidents(spark, sf))
    return rows.select("id", "title", F.md5("text").alias("text_hash"), "device_id", "severity", "source")


@query("compose_incident_text", oracle("id title text device_id severity source",
                                       f"SELECT * REPLACE (left(text, 1000) AS text) FROM ({INCIDENT_DOCS})",
                                       "incidents"))
def _(spark, sf):
    return cp.payload(cp.incident_documents(src.incidents(spark, sf)))


@query("union_corpus", oracle("url type name text_hash", """
    SELECT url, type, CASE WHEN doc_id % 2 = 1 AND doc_id % 5 = 0 THEN '-' ELSE name END AS name, md5(text) AS text_hash
    FROM corpus""", "corpus"))
def _(spark, sf):
    rows = src.corpus(spark, sf)
    even = rows.where("doc_id % 2 = 0").select("url", "type", "name", "text", F.lit("valid").alias("status"))
    odd = rows.where("doc_id % 2 = 1").select(
        "url", F.col("type").alias("typeName"), F.when(F.col("doc_id") % 5 != 0, F.col("name")).alias("title"), "text")
    return cp.union_corpus([even, odd]).select("url", "type", "name", F.md5("text").alias("text_hash"))


@query("union_hits", oracle("kind doc_id chunk_index:i content", """
    SELECT * FROM (
        SELECT 'document' AS kind, doc_id, -1 AS chunk_index, name AS content FROM corpus
        WHERE contains(lower(name), 'src1') UNION ALL
        SELECT 'chunk', doc_id, chunk_index, text FROM chunks WHERE contains(lower(text), 'src1'))
    ORDER BY kind DESC, doc_id, chunk_index LIMIT 50""", "corpus", "chunks"))
def _(spark, sf):
    chunks = chunking.chunk_words(docs(spark, sf)).withColumnRenamed("text", "content")
    return cp.union_hits(src.corpus(spark, sf).withColumnRenamed("name", "title"), chunks, "SRC1", 50)


@query("distinct_rows", oracle("lang source text_hash", """
    SELECT DISTINCT lang, source, md5(text) AS text_hash FROM documents"""))
def _(spark, sf):
    return docs(spark, sf).select("lang", "source", F.md5("text").alias("text_hash")).dropDuplicates()


@query("distinct_on", oracle("doc_id source", """
    SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY text, source ORDER BY doc_id) AS rn
    FROM documents) WHERE rn = 1"""))
def _(spark, sf):
    hashed = docs(spark, sf).select("doc_id", "source", F.sha2("text", 256).alias("text_hash"))
    return ordered.distinct_on(hashed, ["text_hash", "source"], [F.col("doc_id")]).select("doc_id", "source")


SHARE = "CAST(('0x' || left(md5('{seed}:' || CAST({key} AS VARCHAR)), 8)) AS BIGINT) / 4294967296.0e0"


@query("sample_frac", oracle("event_id", f"SELECT event_id FROM events WHERE {SHARE.format(seed=42, key='event_id')} < 0.01"))
def _(spark, sf):
    return cp.sample(src.table(spark, sf, "events").select("event_id"), "event_id", 0.01, 42)


@query("split_train_val", oracle("doc_id split", f"""
    SELECT doc_id, CASE WHEN {SHARE.format(seed=0, key='doc_id')} < 0.8 THEN 'train' ELSE 'val' END AS split
    FROM documents"""))
def _(spark, sf):
    return cp.split_train_val(docs(spark, sf).select("doc_id"), "doc_id")


@query("balance_labels", oracle("doc_id query label:r", """
    SELECT doc_id, query, label FROM (
        SELECT l.doc_id, d.lang AS query, l.quality AS label, row_number() OVER (
            PARTITION BY d.lang, l.quality ORDER BY md5('3:' || CAST(l.doc_id AS VARCHAR)), l.doc_id) AS rn
        FROM labels l JOIN documents d ON d.doc_id = l.doc_id) WHERE rn <= 20"""))
def _(spark, sf):
    from opslake.operators import sessions
    pairs = sessions.training_pairs(docs(spark, sf), src.table(spark, sf, "labels"))
    return cp.balance_labels(pairs.drop("text"), "doc_id", 20, 3)


TOKENS = "SELECT DISTINCT unnest(list_filter(string_split_regex(lower(text), '\\s+'), lambda w: w <> '')) AS token FROM documents"


@query("vocab_diff", oracle("token", f"""
    {TOKENS} WHERE lang = 'de' EXCEPT {TOKENS} WHERE lang = 'en'"""))
def _(spark, sf):
    rows = docs(spark, sf)
    return cp.vocab_diff(cp.vocabulary(rows.where("lang = 'de'")), cp.vocabulary(rows.where("lang = 'en'")))


# Counts

@query("value_counts", oracle("source rows:i", "SELECT source, count(*) AS rows FROM documents GROUP BY 1"))
def _(spark, sf):
    return cp.value_counts(docs(spark, sf), "source")


@query("distinct_counts", oracle("urls:i names:i words:i", f"""
    SELECT count(DISTINCT url) AS urls, count(DISTINCT name) AS names, (SELECT count(*) FROM ({TOKENS})) AS words
    FROM corpus""", "corpus"))
def _(spark, sf):
    return cp.distinct_counts(src.corpus(spark, sf))


@query("describe_lengths", oracle("count:i mean:r std:r min:i max:i q25:r q50:r q75:r", f"""
    SELECT count(*) AS count, avg(n) AS mean, stddev_samp(n) AS std, min(n) AS min, max(n) AS max,
           quantile_cont(n, 0.25) AS q25, quantile_cont(n, 0.5) AS q50, quantile_cont(n, 0.75) AS q75
    FROM (SELECT len({WORDS}) AS n FROM documents)"""))
def _(spark, sf):
    return cp.describe_lengths(src.corpus(spark, sf))


@query("corpus_profile", oracle("doc_id chars:i words:i sentences:i avg_word_len:r", f"""
    SELECT doc_id, length(text) AS chars, n AS words,
           greatest(length(text) - length(regexp_replace(text, '[.!?]', '', 'g')), 1) AS sentences,
           round(CAST(length(regexp_replace(text, '\\s+', '', 'g')) AS DOUBLE) / greatest(n, 1) + 1e-12, 2) AS avg_word_len
    FROM (SELECT *, len({WORDS}) AS n FROM documents)"""))
def _(spark, sf):
    return cp.profile(docs(spark, sf))


@query("unique_words", oracle("doc_id unique_words:i", f"""
    SELECT doc_id, len(list_distinct({WORDS})) AS unique_words FROM documents"""))
def _(spark, sf):
    return cp.unique_words(docs(spark, sf))


@query("build_vocab", oracle("token token_id:i frequency:i", """
    SELECT token, 4 + row_number() OVER (ORDER BY frequency DESC, token) AS token_id, frequency FROM (
        SELECT token, count(*) AS frequency FROM (SELECT unnest(list_filter(
            string_split_regex(lower(text), '\\s+'), lambda w: w <> '')) AS token FROM documents)
        WHERE NOT contains(token, '##') GROUP BY token HAVING count(*) >= 10)
    UNION ALL SELECT * FROM (VALUES ('[PAD]', 0, 0), ('[UNK]', 1, 0), ('[CLS]', 2, 0), ('[SEP]', 3, 0), ('[MASK]', 4, 0))
    """))
def _(spark, sf):
    return cp.build_vocab(docs(spark, sf))


# Cleaning

@query("clean_whitespace", oracle("doc_id text", f"SELECT doc_id, {SPACED} AS text FROM documents"))
def _(spark, sf):
    return docs(spark, sf).select("doc_id", tx.clean_whitespace(F.col("text")).alias("text"))


@query("normalize_unicode", oracle("doc_id nfc_hash bare_hash", """
    SELECT doc_id, md5(nfc_normalize(text)) AS nfc_hash, md5(strip_accents(lower(text))) AS bare_hash FROM documents"""))
def _(spark, sf):
    return docs(spark, sf).select(
        "doc_id", F.md5(tx.normalize(F.col("text"))).alias("nfc_hash"),
        F.md5(tx.strip_accents(F.col("text"))).alias("bare_hash"))


MARKED = "text || ' [' || CAST(doc_id AS VARCHAR) || '] ___ a_b'"


@query("strip_markers", oracle("doc_id text", f"""
    SELECT doc_id, regexp_replace(regexp_replace({MARKED}, '\\[\\d+\\]', '', 'g'), '_{{2,}}', '', 'g') AS text
    FROM documents"""))
def _(spark, sf):
    marked = F.concat("text", F.lit(" ["), F.col("doc_id").cast("string"), F.lit("] ___ a_b"))
    return docs(spark, sf).select("doc_id", tx.strip_markers(marked).alias("text"))


@query("keep_alphabet", oracle("doc_id text", """
    SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^a-zA-ZəƏıIöÖüÜğĞçÇşŞ]', ' ', 'g'), ' +', ' ', 'g')) AS text
    FROM documents"""))
def _(spark, sf):
    return docs(spark, sf).select("doc_id", tx.keep_alphabet(F.col("text")).alias("text"))


@query("drop_short_words", oracle("doc_id text", f"""
    SELECT doc_id, array_to_string(list_filter({WORDS}, lambda w: length(w) > 2), ' ') AS text FROM documents"""))
def _(spark, sf):
    return docs(spark, sf).select("doc_id", tx.drop_short_words(F.col("text")).alias("text"))


STOPWORDS = [*tx.EXTRA_STOPWORDS, "the", "and", "of", "to", "in", "que", "de", "la", "der", "die"]


@query("drop_stopwords", oracle("doc_id text", f"""
    SELECT doc_id, array_to_string(list_filter({WORDS}, lambda w: w NOT IN (
        {', '.join(f"'{w}'" for w in STOPWORDS)})), ' ') AS text FROM documents"""))
def _(spark, sf):
    return docs(spark, sf).select("doc_id", tx.drop_stopwords(F.col("text"), STOPWORDS).alias("text"))


@query("lower_cols", oracle("doc_id name type text", """
    SELECT doc_id, lower(name) AS name, lower(type) AS type, lower(text) AS text FROM corpus""", "corpus"))
def _(spark, sf):
    return src.corpus(spark, sf).select("doc_id", *[tx.lower(F.col(c)).alias(c) for c in ("name", "type", "text")])


@query("filter_length", oracle("doc_id", f"""
    SELECT doc_id FROM documents WHERE trim(text) <> '' AND length(text) >= 33 AND len({WORDS}) > 5"""))
def _(spark, sf):
    return cp.filter_length(docs(spark, sf)).select("doc_id")


def with_headings(spark, sf):
    """Corpus in which some rows hold nothing but their own name or type, or numbers."""
    body = (F.when(F.col("doc_id") % 11 == 0, F.col("name")).when(F.col("doc_id") % 13 == 0, F.col("type"))
            .when(F.col("doc_id") % 17 == 0, F.concat(F.col("doc_id").cast("string"), F.lit(" – 12.5, 7")))
            .when(F.col("doc_id") % 19 == 0, F.lit("12 total 7")).otherwise(F.col("text")))
    return src.corpus(spark, sf).withColumn("text", body)


HEADINGS = """SELECT * REPLACE (CASE WHEN doc_id % 11 = 0 THEN name WHEN doc_id % 13 = 0 THEN type
    WHEN doc_id % 17 = 0 THEN CAST(doc_id AS VARCHAR) || ' – 12.5, 7' WHEN doc_id % 19 = 0 THEN '12 total 7'
    ELSE text END AS text) FROM corpus"""


@query("drop_self_named", oracle("doc_id", f"""
    SELECT doc_id FROM ({HEADINGS}) WHERE text IS DISTINCT FROM name AND text IS DISTINCT FROM type""", "corpus"))
def _(spark, sf):
    return cp.drop_self_named(with_headings(spark, sf)).select("doc_id")


@query("drop_numeric_rows", oracle("doc_id", f"""
    SELECT doc_id FROM ({HEADINGS}) WHERE NOT regexp_full_match(text, '[\\d\\s.,–-]*')
        AND len(regexp_extract_all(text, '\\p{{L}}+')) > 1""", "corpus"))
def _(spark, sf):
    return cp.drop_numeric_rows(with_headings(spark, sf)).select("doc_id")


@query("exact_dedup", oracle("doc_id text_hash", """
    SELECT min(doc_id) AS doc_id, md5(text) AS text_hash FROM documents GROUP BY text"""))
def _(spark, sf):
    return cp.exact_dedup(docs(spark, sf)).select("doc_id", F.md5("text").alias("text_hash"))


def product_labels(spark, sf):
    return src.table(spark, sf, "part").select(F.concat_ws(" ", "p_type", "p_name", "p_brand").alias("label"))


@query("fuzzy_groups", oracle("label representative score:i", """
    SELECT label, representative, CAST(round(100 * (1 - CAST(levenshtein(label, representative) AS DOUBLE)
               / greatest(length(label), length(representative)))) AS BIGINT) AS score
    FROM (WITH RECURSIVE labels AS (SELECT DISTINCT p_name AS label FROM part),
          links AS (SELECT a.label AS l, b.label AS r FROM labels a JOIN labels b ON a.label <> b.label AND round(100 * (
                        1 - CAST(levenshtein(a.label, b.label) AS DOUBLE)
                        / greatest(length(a.label), length(b.label)))) >= 80),
          reach AS (SELECT label, label AS other FROM labels
                    UNION SELECT reach.label, links.r FROM reach JOIN links ON links.l = reach.other)
          SELECT label, min(other) AS representative FROM reach GROUP BY label)"""))
def _(spark, sf):
    return fuzzy.fuzzy_groups(src.table(spark, sf, "part").select(F.col("p_name").alias("label")), 80)


@query("fuzzy_pairs", oracle("a b score:i", """
    SELECT * FROM (SELECT a.label AS a, b.label AS b, CAST(round(100 * (1 - CAST(levenshtein(a.label, b.label) AS DOUBLE)
               / greatest(length(a.label), length(b.label)))) AS BIGINT) AS score
        FROM (SELECT DISTINCT concat_ws(' ', p_type, p_name, p_brand) AS label FROM part) a
        JOIN (SELECT DISTINCT concat_ws(' ', p_type, p_name, p_brand) AS label FROM part) b ON a.label < b.label)
    WHERE score >= 90"""))
def _(spark, sf):
    return fuzzy.similar_pairs(product_labels(spark, sf), 90)


@query("near_dup_docs", oracle("doc_id representative score:r", f"""
    WITH RECURSIVE cut AS (SELECT doc_id, {WORDS.replace("(text", "(lower(coalesce(text, ''))")} AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), chr(10)) AS s
        FROM cut, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    alike AS (SELECT l, r, CAST(shared AS DOUBLE) / (a.n + b.n - shared) AS score
              FROM (SELECT x.doc_id AS l, y.doc_id AS r, count(*) AS shared
                    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
              JOIN sizes a ON a.doc_id = l JOIN sizes b ON b.doc_id = r),
    reach AS (SELECT doc_id, doc_id AS other FROM documents
              UNION SELECT reach.doc_id, r FROM reach JOIN alike ON l = other WHERE score >= 0.8)
    SELECT doc_id, representative, CASE WHEN doc_id = representative THEN 1.0e0 ELSE coalesce(score, 0.0e0) END AS score
    FROM (SELECT doc_id, min(other) AS representative FROM reach GROUP BY doc_id)
    LEFT JOIN alike ON l = doc_id AND r = representative"""))
def _(spark, sf):
    return similar.near_duplicates(docs(spark, sf))


@query("apply_canonical", oracle("doc_id name", """
    SELECT doc_id, CASE WHEN source IN ('src1', 'src2', 'src3') THEN 'Gazette ' || source ELSE source END AS name
    FROM documents"""))
def _(spark, sf):
    rows = src.corpus(spark, sf)
    mapping = rows.select(F.col("name").alias("variant")).distinct().where(
        F.col("variant").isin("src1", "src2", "src3")).withColumn(
        "canonical", F.concat(F.lit("Gazette "), F.col("variant")))
    return cp.apply_canonical(rows, mapping).select("doc_id", "name")


# Chunks

@query("chunk_words", oracle("doc_id chunk_index:i text", "SELECT * FROM chunks", "chunks"))
def _(spark, sf):
    return chunking.chunk_words(docs(spark, sf)).select("doc_id", "chunk_index", "text")


@query("chunk_chars", oracle("doc_id chunk_index:i text", """
    SELECT doc_id, i AS chunk_index, CASE WHEN length(text) <= 500 THEN text ELSE substr(text, CAST(i * 450 + 1 AS BIGINT), 500) END AS text
    FROM (SELECT doc_id, text, unnest(range(0, CASE WHEN length(text) <= 500 THEN 1
              ELSE CAST(ceil(length(text) / 450.0) AS BIGINT) END)) AS i FROM documents)"""))
def _(spark, sf):
    return chunking.chunk_chars(docs(spark, sf)).select("doc_id", "chunk_index", "text")


@query("chunk_fixed", oracle("doc_id chunk_index:i text", f"""
    SELECT doc_id, i AS chunk_index, array_to_string(list_slice(words, i * 100 + 1, i * 100 + 100), ' ') AS text
    FROM (SELECT doc_id, words, unnest(range(0, CAST(ceil(len(words) / 100.0) AS BIGINT))) AS i
          FROM (SELECT doc_id, {WORDS} AS words FROM documents) WHERE len(words) >= 400)"""))
def _(spark, sf):
    return chunking.chunk_fixed(docs(spark, sf), 100, 400).select("doc_id", "chunk_index", "text")


@query("split_sentences", oracle("doc_id chunk_index:i text", """
    SELECT doc_id, unnest(range(0, len(parts))) AS chunk_index, unnest(parts) AS text FROM (
        SELECT doc_id, list_filter(list_transform(string_split(text, '.'), lambda s: trim(s)), lambda s: s <> '') AS parts
        FROM documents)"""))
def _(spark, sf):
    return chunking.split_sentences(docs(spark, sf)).select("doc_id", "chunk_index", "text")


@query("chunk_unique_words", f"""
    WITH RECURSIVE cut AS (SELECT doc_id, w FROM (SELECT doc_id, {WORDS} AS w FROM documents) WHERE len(w) > 0),
    placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM cut),
    -- before[i]: the place of the same word before place i, 0 for its first one
    linked AS (SELECT doc_id, list(p ORDER BY i) AS before FROM (
                   SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id, word ORDER BY i), 0) AS p FROM placed) GROUP BY doc_id),
    ended AS (SELECT doc_id, w, before FROM cut JOIN linked USING (doc_id)),
    -- a chunk from s ends before the 65th place whose word is new since s
    walk AS (SELECT doc_id, 0 AS chunk_index, CAST(1 AS BIGINT) AS s, coalesce(list_filter(range(1, len(w) + 1),
                    lambda i: before[i] < 1)[65], len(w) + 1) AS e FROM ended
             UNION ALL SELECT doc_id, chunk_index + 1, e, coalesce(list_filter(range(e, len(w) + 1),
                    lambda i: before[i] < e)[65], len(w) + 1) FROM walk JOIN ended USING (doc_id) WHERE e <= len(w))
    SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, array_to_string(w[s:e - 1], ' ') AS text
    FROM walk JOIN ended USING (doc_id)""")
def _(spark, sf):
    return chunking.chunk_unique_words(docs(spark, sf), 64).select("doc_id", "chunk_index", "text")


def packed_sentences(most: int, overlap: int) -> str:
    """SQL of sentences packed up to ``most`` words, each chunk from sentence a, new ones from f, up to b."""
    until = f"greatest({{f}}, len(list_filter(cum, lambda c: c <= coalesce(cum[{{a}} - 1], 0) + {most})))"
    return f"""
    WITH RECURSIVE parts AS (
        SELECT doc_id, list_filter(string_split(regexp_replace(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda t: len({WORDS.replace("(text", "(t")}) > 0) AS s FROM documents),
    sized AS (SELECT doc_id, s, list_transform(s, lambda t: len({WORDS.replace("(text", "(t")})) AS n FROM parts WHERE len(s) > 0),
    summed AS (SELECT doc_id, s, n, list_transform(range(1, len(n) + 1), lambda i: CAST(list_sum(n[1:i]) AS BIGINT)) AS cum FROM sized),
    walk AS (
        SELECT doc_id, 0 AS chunk_index, CAST(1 AS BIGINT) AS a, {until.format(f="1", a="1")} AS b FROM summed
        UNION ALL
        SELECT doc_id, chunk_index, a, {until.format(f="f", a="a")} FROM (
            SELECT doc_id, chunk_index, f, cum,
                   CASE WHEN cum[f - 1] - coalesce(cum[k - 1], 0) + n[f] > {most} THEN f ELSE k END AS a
            FROM (SELECT doc_id, chunk_index + 1 AS chunk_index, b + 1 AS f, cum, n,
                         -- the kept end of the chunk before: as many whole sentences as the overlap allows
                         greatest(a, CASE WHEN cum[b] <= {overlap} THEN 1
                             ELSE len(list_filter(cum, lambda c: c < cum[b] - {overlap})) + 2 END) AS k
                  FROM walk JOIN summed USING (doc_id) WHERE b < len(n))))
    SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, array_to_string(s[a:b], ' ') AS text
    FROM walk JOIN summed USING (doc_id)"""


@query("chunk_sentences", packed_sentences(100, 0))
def _(spark, sf):
    return chunking.chunk_sentences(docs(spark, sf)).select("doc_id", "chunk_index", "text")


@query("chunk_overlap_sentences", packed_sentences(512, 64))
def _(spark, sf):
    return chunking.chunk_sentences(docs(spark, sf), 512, 64).select("doc_id", "chunk_index", "text")


@query("chunk_ids", oracle("chunk_id document_id", """
    SELECT sha256('doc://' || CAST(doc_id AS VARCHAR)) || ':' || CAST(chunk_index AS VARCHAR) AS chunk_id,
           sha256('doc://' || CAST(doc_id AS VARCHAR)) AS document_id FROM chunks""", "chunks"))
def _(spark, sf):
    chunks = chunking.chunk_words(docs(spark, sf)).withColumn(
        "url", F.concat(F.lit("doc://"), F.col("doc_id").cast("string")))
    return chunking.chunk_ids(chunks, "url").select("chunk_id", "document_id")


@query("chunk_neighbours", oracle("doc_id chunk_index:i previous_chunk_id:i next_chunk_id:i", """
    SELECT doc_id, chunk_index, lag(chunk_index) OVER w AS previous_chunk_id, lead(chunk_index) OVER w AS next_chunk_id
    FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index)""", "chunks"))
def _(spark, sf):
    return chunking.chunk_neighbours(chunking.chunk_words(docs(spark, sf))).select(
        "doc_id", "chunk_index", "previous_chunk_id", "next_chunk_id")


# Pages

@query("extract_paragraphs")
def _(spark, sf):
    return pages.extract_paragraphs(src.table(spark, sf, "pages"))


@query("first_section")
def _(spark, sf):
    body = pages.Selector(container="body", container_class=None, paragraph_classes=None, skip_style=None)
    return pages.first_section(src.table(spark, sf, "pages"), [pages.ARTICLE, body])


# Work lists

@query("skip_done", oracle("doc_id", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"))
def _(spark, sf):
    return files.skip_done(docs(spark, sf).select("doc_id"), src.table(spark, sf, "labels"), "doc_id")


@query("prune_empty_docs", oracle("doc_id kept:b", f"""
    SELECT doc_id, len({WORDS}) >= 400 AS kept FROM documents"""))
def _(spark, sf):
    rows = docs(spark, sf)
    kept, removed = files.prune_empty(rows, chunking.chunk_fixed(rows, 100, 400), "doc_id")
    return kept.select("doc_id", F.lit(True).alias("kept")).unionByName(
        removed.select("doc_id", F.lit(False).alias("kept")))
