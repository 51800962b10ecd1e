"""Periodic runs, line dedup and ranked lexical search against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import math
import numpy as np
import pytest

from llm import cases
from opslake.llm import lexical, lines, periods, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return cases.awkward(spark).cache()


def plain_runs(w, least=6):
    """(start, length, period) of the runs of a list, by comparing every word with the one a period on."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_of_small_alphabets():
    draw = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(draw.randint(1, 4)):
            w, letters = [], draw.choice([1, 2, 3, 8])
            for _ in range(draw.randint(0, 4)):
                w += [draw.randrange(letters) for _ in range(draw.randint(1, 9))] * draw.choice([1, 2, 4, 5, 9])
                w = w[:len(w) - draw.randint(0, 3)] if w and draw.random() < .5 else w
            texts.append(w)
        symbols, want = [-1], []
        for i, w in enumerate(texts):
            want += [(len(symbols) + s, n, q) for s, n, q in plain_runs(w)]
            symbols += [*w, -2 - i]
        start, end, period = periods.find_runs(np.array(symbols, np.int64))
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == want


def test_grammar_measures_agreement_both_ways():
    draw = random.Random(2)
    symbols = [draw.randrange(2) for _ in range(60)] * 3 + [0] * 40 + [draw.randrange(3) for _ in range(80)]
    symbols = np.array([-1, *symbols, -2])
    grammar = periods.Grammar(symbols)
    x, y = np.triu_indices(len(symbols) - 1, 1)
    x, y = x[x > 0], y[x > 0]
    after, before = grammar.after(x, y), grammar.before(x, y)
    for i, j, a, b in zip(x.tolist(), y.tolist(), after.tolist(), before.tolist()):
        assert (symbols[i:i + a] == symbols[j:j + a]).all() and symbols[i + a] != symbols[j + a]
        assert (symbols[i - b:i] == symbols[j - b:j]).all() and symbols[i - b - 1] != symbols[j - b - 1]


def test_a_long_text_of_one_word_and_runs_beyond_a_batch(monkeypatch):
    symbols = np.concatenate([[-1], np.zeros(30_000, np.int64), [-2], np.tile(np.arange(7), 500), [-3]])
    want = [[1, 30_002], [30_001, 33_502], [1, 7]]
    assert periods.find_runs(symbols).tolist() == want
    monkeypatch.setattr(periods, "TOGETHER", 1000)
    assert periods.find_runs(symbols).tolist() == want


def test_runs_of_awkward_rows(spark, docs):
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periods.periodic_runs(docs).collect())
    want = Counter()
    for i, t in cases.collected(docs):
        w = cases.words(t)
        found = plain_runs(w)
        want[i, len(w), tuple(found), plain_collapsed(w, found)] += 1
    assert got == want and any(key[2] for key in got)
    assert periods.periodic_runs(cases.nothing(spark)).count() == 0


def test_periodic_query_against_plain(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert got.keys() == texts.keys() and any(r.n_runs for r in got.values())
    for i, t in texts.items():
        w = cases.words(t)
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        found = plain_runs(w)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapsed(w, found).encode()).hexdigest()


def plain_lines(rows, least_docs=2, least_chars=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    order = lambda i: (i is not None, i or 0)
    holders = defaultdict(set)
    for i, t in rows:
        for line in t.split("\n"):
            holders[key(line)].add(order(i))
    out = Counter()
    for i, t in rows:
        cut = t.split("\n")
        kept = [x for x in cut if len(key(x)) < least_chars or len(holders[key(x)]) < least_docs or min(holders[key(x)]) == order(i)]
        out[i, len(cut), len(cut) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.mark.parametrize("least_docs", [2, 3])
@pytest.mark.parametrize("share", [1e-4, 0.2, 0.0])
def test_lines_of_awkward_rows(spark, docs, least_docs, share, monkeypatch):
    monkeypatch.setattr(lines, "HOT_SHARE", share)  # no, some and all keys through the shared table
    extra = [(20, "A shared LINE of text\nown line number one\n  a Shared line of text\t"), (21, "\x0ba shared line of text \r\nshort\nshort"),
             (22, "x\n\na shared line of text\n"), (19, "é shared line"), (23, "É shared line\né shared line"), (23, "é shared line")]
    rows = docs.select("doc_id", "text", "k", "h").unionByName(spark.createDataFrame(
        [(i, t, "x", "y") for i, t in extra], "doc_id bigint, text string, k string, h string"))
    got = Counter(tuple(r) for r in lines.remove_lines(rows, least_docs).collect())
    assert got == plain_lines(cases.collected(rows), least_docs)
    assert sum(k[2] for k in got) >= 2
    assert lines.remove_lines(cases.nothing(spark)).count() == 0


def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_search(rows, items, top):
    """Counter of (item, rank, doc, score) rows."""
    bags = [(i, Counter(plain_terms(t))) for i, t in rows]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    out = Counter()
    for item, text in items:
        asked = Counter(plain_terms(text))
        weights = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(w in b for _, b in bags) + 1))) for w in asked}
        scored = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // n_terms
            score = sum(c * weights[w] * (1_000_000_000 * b[w] // (1000 * b[w] + 8 * m)) for w, c in asked.items())
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1):
            out[item, rank, i, -score] += 1
    return out


@pytest.mark.parametrize("most", [lexical.PART_BYTES, 40])
def test_search_of_awkward_rows(spark, docs, most, monkeypatch):
    monkeypatch.setattr(lexical, "SLICE_BYTES", 100)
    monkeypatch.setattr(lexical, "CLASS_BLOCK", 4)
    monkeypatch.setattr(lexical, "ITEM_BLOCK", 2)
    asked = [(1, cases.prose(2, 20)), (2, "word Word, WORD the"), (3, None), (4, "  ...  "), (5, "unheard-of"), (None, "the 12 é ñ 日本語"),
             (6, "the"), (6, cases.prose(3, 30, "fr")), (7, "12 345 ab" + "é" * 300)]
    items = spark.createDataFrame([(i, t, "x", "y") for i, t in asked], "item_id bigint, text string, k string, bag string")
    got = Counter(tuple(r) for r in lexical.ranked_search(docs, items, 4, most=most).select("item_id", "rank", "doc_id", "score").collect())
    assert got == plain_search(cases.collected(docs), asked, 4)
    empty = cases.nothing(spark)
    assert lexical.ranked_search(empty, items).count() == 0
    assert lexical.ranked_search(docs, empty.selectExpr("doc_id as item_id", "text")).count() == 0


def test_search_expands_copies_by_id(spark):
    rows = [(i, "shared words of a copy" if i % 3 else f"other words {i}") for i in range(60, 0, -1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    items = spark.createDataFrame([(1, "copy words")], "item_id bigint, text string")
    got = [(r.rank, r.doc_id) for r in lexical.ranked_search(docs, items).orderBy("rank").collect()]
    assert got == list(enumerate([i for i in range(1, 60) if i % 3][:10], 1))


def test_long_sums_are_exact():
    best = [np.zeros(0, np.int64)] * 4
    scores = np.array([[5], [7], [7], [0], [9]])
    kept = lexical.foremost(best, scores, np.array([3]), np.array([4, 9, 2, 1, 8]), np.arange(5), 3)
    assert [c.tolist() for c in kept] == [[3, 3, 3], [9, 7, 7], [8, 2, 9], [4, 2, 1]]
