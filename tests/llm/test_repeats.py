"""Suffix dedup, substring dedup, near duplicates, connected components and the sketch."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from llm import cases
from opslake.llm import blocks, components, neardup, sketch, substrings, suffix
from opslake.llm.marks import LEAST

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return cases.awkward(spark).cache()


def test_window_hashes_and_anchors():
    data = np.frombuffer(b"abcdefabcdef" * 3, np.uint8)
    h = blocks.window_hash(data, 4)
    assert (h[:6] == h[6:12]).all() and len(set(h[:6].tolist())) == 6
    place = blocks.anchors(h, 5)
    assert all(h[p] == h[i:i + 5].min() and p == i + int(np.argmin(h[i:i + 5])) for i, p in enumerate(place))


def test_words_of_a_block():
    texts = [b"", b" a  bc\n", b"\t", "é x\x0by".encode()]
    words = blocks.Block(texts).words()
    assert words.count.tolist() == [len(t.split()) for t in texts]
    assert [words.text(i) for i in range(len(words.start))] == [w for t in texts for w in t.split()]


def test_sketch_of_a_small_corpus_is_sent_in_few_bytes(spark):
    """2 * 2**27 bits are 32 MB; the driver holds and sends them packed, and tasks have them whole."""
    table = spark.createDataFrame([(i, f"a{i % 9} b{i} c") for i in range(300)], "doc_id bigint, text string")
    shared = sketch.count_min(table, "text", lambda block: block.words().hashes(), 27)
    with open(shared._path, "rb") as sent:
        assert len(sent.read()) < 1_000_000
    sizes = spark.sparkContext.parallelize([0], 1).map(lambda _: [len(row) for row in shared.value]).first()
    assert sizes == [1 << 24] * len(sketch.ROWS)


def test_sketch_loses_nothing(spark):
    texts = [f"{i % 70} {i}" for i in range(100)]
    table = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for bits in (6, 12):
        found = sketch.count_min(table, "text", lambda block: block.words().hashes(), bits).value
        words = blocks.Block([t.encode() for t in texts]).words()
        h = words.hashes()
        twice = np.array([n > 1 for n in map(Counter(h.tolist()).get, h.tolist())])
        assert sketch.seen_twice(found, h, bits)[twice].all()


def test_filter_passes_few_keys_that_occur_once(spark):
    """20,000 anchors of one place each in 4,096 cells a row, and 150 of two: the share that passes is near the true one."""
    draw = np.random.default_rng(6)
    once = ["".join(map(chr, draw.integers(97, 123, 8))) for _ in range(20_000)]
    twice = [f"twice{i}" for i in range(150)]
    texts = [" ".join(once[i::40] + twice[i % 2::2]) for i in range(40)]
    texts = [t if i < 4 else " ".join(w for w in t.split() if "twice" not in w) for i, t in enumerate(texts)]
    table = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)

    def anchors_of(block):
        return np.minimum(block.words().hashes(), block.words().hashes(salt=9))

    found = sketch.count_min(table, "text", anchors_of, 12).value
    h = np.unique(anchors_of(blocks.Block([t.encode() for t in texts])))
    assert len(h) > 20_000
    passed = sketch.seen_twice(found, h, 12).sum()
    assert 150 <= passed < 150 + 0.02 * len(h)


def test_equal_segments_are_one_and_lone_ones_are_left_out():
    """Segments of 15 strings of 50 bytes: equal ones have one first, and only varied anchors are kept."""
    draw = np.random.default_rng(3)
    length, lead, column, count = 50, 14, 0, 15
    variants = [draw.integers(97, 99, lead + length).astype(np.uint8) for _ in range(40)]
    for v in range(1, 20, 2):  # ten pairs share an anchor and differ elsewhere
        variants[v][lead:lead + suffix.GRAM] = variants[v - 1][lead:lead + suffix.GRAM]
    pick = draw.integers(0, len(variants), 400)
    rank = draw.permutation(400)
    place = np.array([(7 * i, column, count) for i in range(400)])
    first, kept = suffix.merged(np.concatenate([variants[v] for v in pick]), place, rank, length)
    earliest = {v: min(np.flatnonzero(pick == v), key=lambda i: rank[i]) for v in pick.tolist()}
    assert first.tolist() == [earliest[v] for v in pick.tolist()]
    assert kept.tolist() == sorted(i for v, i in earliest.items() if v < 20)


def ordered(rows):
    """Rows in the order of remove_earlier, each repeated row once."""
    return sorted({(LEAST if i is None else i, t) for i, t in rows}, key=lambda r: r[0])


def test_suffix_dedup_of_awkward_rows(spark, docs):
    # Two texts of one id are ordered by a hash; they share nothing here, so any order is right.
    rows = ordered(cases.collected(docs))
    masks = cases.earlier_bytes([t.encode() for _, t in rows], 100)
    want = {}
    for (i, t), mask in zip(rows, masks):
        data = t.encode()
        kept = bytes(b for b, m in zip(data, mask) if not m)
        want[i, hashlib.sha256(kept).hexdigest(), len(data), sum(mask)] = bytes(mask).count(b"\0\1") + mask[:1].count(b"\1")
    got = suffix.remove_earlier(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        key = (LEAST if r.doc_id is None else r.doc_id, hashlib.sha256(r.kept).hexdigest(), r.n_bytes, r.n_removed)
        assert want[key] == r.n_spans == len(r.spans)
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    assert suffix.remove_earlier(cases.nothing(spark)).count() == 0


@pytest.mark.parametrize("bits", [5, 20])
def test_suffix_dedup_is_exact_whatever_the_sketch(spark, bits):
    table = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text) for r in table.collect())
    masks = cases.earlier_bytes([t.encode() for _, t in rows], 60)
    got = {r.doc_id: r.kept for r in suffix.remove_earlier(table.repartition(5), 60, bits=bits).collect()}
    for (i, t), mask in zip(rows, masks):
        assert got[i] == bytes(b for b, m in zip(t.encode(), mask) if not m)


def test_cut_texts_keep_columns_and_whole_characters(spark, docs):
    a = "é" * 10 + cases.prose(30, 60) + "ä"
    table = spark.createDataFrame([(1, a, "c"), (2, "ü" + a[1:] + "ö", "c"), (3, None, "c")], "doc_id bigint, text string, k string")
    cut = {r.doc_id: r for r in suffix.cut_texts(table).collect()}
    assert cut[1].text == a and cut[3].text is None and cut[2].text.startswith("ü") and len(cut[2].text) < 30
    assert suffix.cut_texts(docs).columns == docs.columns


def test_column_classes_against_plain():
    draw = np.random.default_rng(1)
    lead, length, n = 6, 8, 400
    rows = draw.integers(97, 99, (n, lead + length)).astype(np.uint8)
    rank = draw.permutation(n)
    got = suffix.column_classes(list(rows.T), rank, lead, length)
    for c in range(lead + 1):
        least = {}
        for i in range(n):
            part = rows[i, c:c + length].tobytes()
            least[part] = min(least.get(part, n), rank[i])
        assert got[c].tolist() == [rank[i] > least[rows[i, c:c + length].tobytes()] for i in range(n)]


def test_substring_dedup_of_awkward_rows(spark, docs):
    rows = cases.collected(docs)
    want = Counter()
    for (i, t), gone in zip(rows, cases.repeated_words([t for _, t in rows], 35)):
        kept = " ".join(w for w, g in zip(cases.words(t), gone) if not g)
        want[(i, len(gone), sum(gone), kept)] += 1
    assert Counter(map(tuple, substrings.remove_repeats(docs.repartition(4)).collect())) == want
    assert substrings.remove_repeats(cases.nothing(spark)).count() == 0


@pytest.mark.parametrize("window,bits", [(35, 5), (9, 22), (2, 16)])
def test_substring_dedup_is_exact_whatever_the_sketch(spark, window, bits):
    table = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 80").select("doc_id", "text")
    rows = cases.collected(table)
    got = {r.doc_id: r.kept_text for r in substrings.remove_repeats(table.repartition(6), window, bits=bits).collect()}
    for (i, t), gone in zip(rows, cases.repeated_words([t for _, t in rows], window)):
        assert got[i] == " ".join(w for w, g in zip(cases.words(t), gone) if not g)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(7, 3), (200, 200)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 120)) and got[200] == 200


def test_near_duplicates_of_given_documents(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    want = cases.near_classes(dict(cases.collected(table)))
    rows = neardup.near_duplicates(table).collect()
    assert {r.doc_id: r.class_id for r in rows} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] for r in rows)


def edited(text, draw, changes):
    w = text.split()
    for _ in range(changes):
        w[draw.integers(len(w))] = "edit%d" % draw.integers(1 << 30)
    return " ".join(w)


def test_large_group_of_near_copies_is_one_class(spark):
    draw = np.random.default_rng(2)
    base = cases.prose(50, 200)
    texts = [edited(base, draw, 5) for _ in range(150)] + [cases.prose(1000 + i, 80) for i in range(150)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = cases.near_classes(dict(enumerate(texts)))
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(table).collect()} == want


def test_near_duplicates_of_awkward_rows(spark, docs):
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, set()).add((r.class_id, r.class_size))
    assert got[2] == {(-14, 4)} and (-14, 4) in got[1] and (1, 1) in got[1]
    assert got[9] == got[10] == {(9, 2)} and got[3] == {(3, 1)} and got[4] == {(4, 1)} and got[5] == {(5, 1)}
    assert neardup.near_duplicates(cases.nothing(spark)).count() == 0
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-14, 1, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13, 15]


def test_near_copies_within_a_group_of_similar_texts(spark):
    """3,000 texts at 0.75 to each other, of which 400 pairs are at 0.82 or 0.9: no link is lost."""
    n, template, tail, planted = 3000, 448, 20, 400
    draw = np.random.default_rng(8)
    base = " ".join("t%d" % x for x in draw.integers(1 << 40, size=template))
    tails = [["u%d" % x for x in draw.integers(1 << 40, size=tail)] for _ in range(n)]
    for pair in range(planted):
        same = 6 if pair % 2 else 13
        tails[2 * pair + 1][:same] = tails[2 * pair][:same]
    common, rare = np.log1p(1 / (1 + neardup.SHARE_FLOOR)), np.log1p(1 / (2 / n + neardup.SHARE_FLOOR))
    for same, similar in ((0, 0.75), (6, 0.82), (13, 0.9)):
        shared = (template - 4) * common + same * rare
        assert shared / (shared + 2 * (tail - same) * rare) == pytest.approx(similar, abs=0.01)
    texts = [(i, " ".join([base, *t])) for i, t in enumerate(tails)]
    table = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(8, "doc_id")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(table).collect()}
    assert got == {i: i - i % 2 if i < 2 * planted else i for i in range(n)}


def test_rare_pairs_meet_whatever_their_labels_and_blocks(spark, monkeypatch):
    """Twelve texts of five classes on one key: all pairs of two classes meet, and on a second key they do not meet again."""
    label = [b"a"] * 5 + [b"b"] * 3 + [b"c"] * 2 + [b"d", b"e"]
    nodes = [b"%02d" % i for i in range(len(label))]
    rows = [(n, x, 10.0, 10.0 - key, key) for n, x in zip(nodes, label) for key in (0, 1)]
    table = spark.createDataFrame(rows, "node binary, label binary, total double, after double, key bigint")
    want = sorted((x, y) for i, x in enumerate(nodes) for j, y in enumerate(nodes) if i < j and label[i] != label[j])
    for block in (500, 2):
        monkeypatch.setattr(neardup, "KEY_BLOCK", block)
        got = [sorted(map(bytes, r)) for r in neardup.rare_pairs(table, 0.8).collect()]
        assert sorted(map(tuple, got)) == want


def test_borderline_group_equals_all_pairs_and_few_are_verified(spark, monkeypatch):
    """400 edits of one text, pairs about the threshold: the classes are those of all pairs, and few pairs are compared."""
    draw = np.random.default_rng(5)
    base = cases.prose(77, 600)
    texts = [edited(base, draw, int(draw.integers(2, 5))) for _ in range(400)] + [cases.prose(3000 + i, 60) for i in range(100)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4, "doc_id")
    known = neardup.frequencies(table, "text", 5, 16).value
    _, _, shingle, doc, times = neardup.shingles(blocks.Block([t.encode() for t in texts]), 5)
    weight = neardup.weights(shingle, times, known)
    sets = []
    for i in range(len(texts)):
        order = np.argsort(shingle[doc == i])
        sets.append((shingle[doc == i][order], weight[doc == i][order]))
    want = list(range(len(texts)))
    links = [(i, j) for i in range(400) for j in range(i) if neardup.weighted_jaccard(sets[i], sets[j]) >= 0.8]
    for i, j in links:
        a, b = sorted((want[i], want[j]))
        want = [a if x == b else x for x in want]
    compared, real = [], neardup.verified
    monkeypatch.setattr(neardup, "verified", lambda pairs, *a: (compared.append(pairs.count()), real(pairs, *a))[1])
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(table).collect()}
    assert got == dict(enumerate(want))
    assert len(links) > 2_000
    assert sum(compared[1:]) < 4 * 400


def test_samples_agree_as_often_as_the_sets_do():
    draw = np.random.default_rng(4)
    a = draw.integers(0, 1 << 63, 300).astype(np.uint64)
    b = np.append(a[:240], draw.integers(0, 1 << 63, 60).astype(np.uint64))
    w = draw.uniform(0.5, 3, 360)
    doc = np.repeat([0, 1], 300)
    wa, wb = w[:300], np.append(w[:240], w[300:])
    drawn = neardup.samples(np.append(a, b), doc, np.append(wa, wb), 2, 2000, 1)
    shared = w[:240].sum()
    assert (drawn[0] == drawn[1]).mean() == pytest.approx(shared / (wa.sum() + wb.sum() - shared), abs=0.04)
    order_a, order_b = np.argsort(a), np.argsort(b)
    exact = neardup.weighted_jaccard((a[order_a], wa[order_a]), (b[order_b], wb[order_b]))
    assert exact == pytest.approx(shared / (wa.sum() + wb.sum() - shared))
