"""Chunkers, page extraction, search and label groups against hand-made or brute-force results."""

import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from opslake.functions import batches
from opslake.functions import text as tx
from opslake.operators import chunking, corpus, fuzzy, search
from opslake.sources import pages


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def chunks_of(df):
    return [r.text for r in df.orderBy("doc_id", "chunk_index").collect()]


def test_word_chunks(spark):
    words = [f"w{i}" for i in range(300)]
    got = chunks_of(chunking.chunk_words(docs(spark, " ".join(words), "", "  "), 100, 20))
    assert [c.split()[0] for c in got] == ["w0", "w80", "w160", "w240"]
    assert len(got[-1].split()) == 60


def test_char_chunks(spark):
    assert chunks_of(chunking.chunk_chars(docs(spark, "short text"))) == ["short text"]
    got = chunks_of(chunking.chunk_chars(docs(spark, "x" * 1000), 100, 20))
    assert len(got) == 13 and all(len(c) <= 100 for c in got)


def test_unique_word_chunks(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(n)) for n in (0, 1, 7, 60)]

    def brute(text):
        out, cur = [], []
        for w in text.split():
            if len(set(cur) | {w}) > 4:
                out.append(" ".join(cur))
                cur = []
            cur.append(w)
        return out + ([" ".join(cur)] if cur else [])

    assert chunks_of(chunking.chunk_unique_words(docs(spark, *texts), 4)) == [c for t in texts for c in brute(t)]


def test_sentence_chunks(spark):
    text = "One two three. Four five! Six seven eight nine ten eleven. Twelve? Thirteen."
    assert chunks_of(chunking.chunk_sentences(docs(spark, text, ""), 5)) == [
        "One two three. Four five!", "Six seven eight nine ten eleven.", "Twelve? Thirteen."]
    assert chunks_of(chunking.chunk_sentences(docs(spark, "a b. c d. e f."), 4, 2)) == ["a b. c d.", "c d. e f."]


def test_cleaning(spark):
    row = docs(spark, " a b \n  c [12] __ d_e ").select(
        tx.clean_whitespace(F.col("text")).alias("a"), tx.strip_markers(F.col("text")).alias("b"),
        tx.clean_query(F.lit("labour law 12?!")).alias("q"), tx.normalize(F.lit("é")).alias("n"),
        tx.strip_accents(F.lit("ÉÀ")).alias("s")).first()
    assert row.a == "a b c [12] __ d_e" and "[12]" not in row.b and "__" not in row.b and "d_e" in row.b
    assert (row.q, row.n, row.s) == ("labour law", "é", "ea")


PAGE = """<html><head><title> The  Act </title><style>p{}</style></head><body>
<div class="WordSection1"><p class="MsoNormal">A first paragraph that is long enough&nbsp;to keep.</p>
<p class="MsoNormal">short</p><p class="Other">A paragraph of another class, long enough to be kept.</p>
<table><tr><td><p class="MsoNormal">A paragraph inside a table, long enough to be kept.</p></td></tr></table>
<div style="border-bottom:double gray 1pt"><p class="Mecelle">A paragraph in the styled block, long enough.</p></div>
<p class="Mecelle">A second paragraph that is <b>long</b> enough to keep.<script>x("<p>")</script></p>
<p class="MsoNormal">A first paragraph that is long enough to keep.</p></div>
<p class="MsoNormal">A paragraph outside any section that is long enough.</p></body></html>"""


def test_page_paragraphs(spark):
    rows = spark.createDataFrame([(1, "u", PAGE), (2, "v", "<p class='MsoNormal'>no section at all here</p>"), (3, "w", None)],
                                 "page_id long, url string, html string")
    got = pages.extract_paragraphs(rows, pages.Selector()).orderBy("pos").collect()
    assert [r.text for r in got] == ["A first paragraph that is long enough to keep.",
                                     "A second paragraph that is long enough to keep."]
    assert {r.title for r in got} == {"The Act"}


def test_first_section(spark):
    rows = spark.createDataFrame([(1, "u", "<div class='Section3'><p>Law</p><p>Code</p><p>Body</p></div>")],
                                 "page_id long, url string, html string")
    order = [pages.Selector(container_class=c, paragraph_classes=None) for c in ("WordSection1", "Section1", "Section3")]
    got = pages.first_section(rows, order).collect()
    assert {(r.document_name, r.document_type) for r in got} == {("Law", "Code")} and len(got) == 3


def test_keyword_paths_agree(spark, monkeypatch):
    rng = random.Random(2)
    alphabet = ["alpha", "Beta", "gamma", "déjà", "x", "propulsion", "of"]
    texts = [" ".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(60)]
    terms = ["a", "propulsion", "BETA gamma", "ma d", "zzz", "déjà x", "of", "o"]
    corpus_rows = docs(spark, *texts)
    queries = spark.createDataFrame(list(enumerate(terms)), "query_id long, query string")
    want = {(q, d) for q, term in enumerate(terms) for d, t in enumerate(texts) if term.lower() in t.lower()}

    def found(**options):
        return {(r.query_id, r.doc_id) for r in search.keyword_search(corpus_rows, queries, **options).collect()}

    assert found() == want
    assert found(literal_queries=3) == want
    monkeypatch.setattr(search, "EXPRESSION_QUERIES", 2)
    assert found() == want


def test_excerpt_and_fallback(spark):
    rows = docs(spark, "intro\nThe Propulsion unit.\nend", "nothing here")
    queries = spark.createDataFrame([(1, "propulsion"), (2, "absent")], "query_id long, query string")
    got = {r.query_id: r for r in search.excerpt_search(rows, queries).collect()}
    assert (got[1].excerpt, got[1].score) == ("The Propulsion unit.", 1.0)
    assert (got[2].doc_id, got[2].score) == (0, 0.1)


def test_budget_ignores_bands(spark):
    rows = [(1, d, 0, float(d), "w " * (d % 5 + 1)) for d in range(200)] + [(1, 500 + i, 1, -1.0 / (i + 1), "w") for i in range(5)]
    hits = spark.createDataFrame(rows, "query_id long, doc_id long, part int, place double, text string")
    got = {r.doc_id: r.running_tokens for r in search.fit_budget(hits, tx.word_count(F.col("text")), 100, band_rows=7).collect()}
    want, total = {}, 0
    for _, d, _, _, t in sorted(rows, key=lambda r: (r[2], r[3], r[1])):
        total += len(t.split())
        if total <= 100:
            want[d] = total
    assert got == want


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_similar_pairs_miss_nothing(spark):
    rng = random.Random(3)
    bases = ["".join(rng.choice("abc ") for _ in range(rng.randint(3, 40))) for _ in range(25)]
    labels = set(bases) | {"a", "ab", "abc", "b"}
    for base in bases:
        for _ in range(4):
            s = list(base)
            for _ in range(rng.randint(1, 4)):
                i = rng.randrange(len(s))
                s[i:i + 1] = rng.choice([[], ["d"], [s[i], "e"]])
                s = s or ["z"]
            labels.add("".join(s))
    rows = spark.createDataFrame([(x,) for x in labels], "label string")
    for threshold in (90, 80, 60):
        want = set()
        for a in labels:
            for b in labels:
                # Half points round up, in whole numbers to keep clear of float noise.
                longer = max(len(a), len(b))
                if a < b and 1000 * (longer - edit(a, b)) >= (10 * threshold - 5) * longer:
                    want.add((a, b))
        got = {(r.a, r.b) for r in fuzzy.similar_pairs(rows, threshold).collect()}
        assert got == want


def test_groups_follow_chains(spark):
    rows = spark.createDataFrame([("aaaaaaaaaa1",), ("aaaaaaaaaa12",), ("aaaaaaaaaa123",), ("other",), ("other",)], "label string")
    got = {r.label: r.representative for r in fuzzy.fuzzy_groups(rows, 90).collect()}
    assert got == {"aaaaaaaaaa1": "aaaaaaaaaa1", "aaaaaaaaaa12": "aaaaaaaaaa1", "aaaaaaaaaa123": "aaaaaaaaaa1", "other": "other"}


def test_vocabulary_order(spark):
    got = corpus.build_vocab(docs(spark, "b b a a c ##x ##x ##x"), min_count=2).orderBy("token_id").collect()
    assert [r.token for r in got] == [*tx.SPECIAL_TOKENS, "a", "b"]
    assert re.fullmatch(r"\d+", str(got[-1].token_id))


def test_both_ways_of_keyword_search_give_the_same_rows(spark):
    rows = [(1, "Alpha beta"), (1, "alpha BETA gamma"), (None, "beta alpha beta"), (2, None), (1, "Alpha beta")]
    corpus_rows = spark.createDataFrame(rows, "doc_id bigint, text string")
    queries = spark.createDataFrame([(1, "alpha beta"), (2, "a"), (2, "a"), (3, "gamma"), (4, "")], "query_id int, query string")

    def found(**options):
        return sorted(map(str, search.keyword_search(corpus_rows, queries, **options).collect()))

    assert found() == found(literal_queries=0) and len(found()) == 4 + 4 + 1


def test_many_labels_in_a_chain_settle(spark):
    labels = spark.createDataFrame([(f"{i:03}",) for i in range(70)], "label string")
    pairs = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(69)], "a string, b string")
    assert {r.representative for r in fuzzy.connected(labels, pairs).collect()} == {"000"}


def test_a_batch_is_worked_on_in_parts(spark, monkeypatch):
    texts = ["a" * 300_000, None, "", "b" * 3_000_000, "c"] + ["d" * 400_000] * 9
    got = list(batches.parts(pa.array(texts)))
    assert [t for p in got for t in p.to_pylist()] == texts
    assert max(sum(len(t or "") for t in p.to_pylist()) for p in got) <= 3_000_000 + (1 << 20) and len(got) >= 5
    assert [p.to_pylist() for p in batches.parts(pa.array([], pa.string()))] == [[]]
    for used in (chunking, pages):
        monkeypatch.setattr(used, "parts", lambda column: batches.parts(column, 1_000))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    assert {r.doc_id: r.text for r in chunking.chunk_sentences(docs).collect()} == {i: t for i, t in enumerate(texts) if t}
    html = [None if t is None else f"<title>{len(t)}</title><article><p>{t}</article>" for t in texts]
    rows = spark.createDataFrame([(i, "u", h) for i, h in enumerate(html)], "page_id long, url string, html string").coalesce(1)
    for found in (pages.extract_paragraphs(rows, min_chars=1), pages.first_section(rows, [pages.ARTICLE])):
        assert {r.page_id: r.text for r in found.collect()} == {i: t for i, t in enumerate(texts) if t}
