"""Token counts, fertility rules, quality classifier and language identification."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import regex
from tokenizers import Tokenizer

from llm import cases
from opslake.llm import blocks, fertility, langid, quality, token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return cases.awkward(spark).cache()


def odd_texts():
    draw = random.Random(3)
    return ["", " ", "  two  spaces ", "it's we'll I'M", "<|endoftext|>", "a<|endoftext|><|endoftext|> b ", "tab\tand\r\n\n line ",
            "՘࢏ x", "日本語 текст ελληνικά", "x\x1c\x1fy\u0085z  w", "½ ² ٣ 3rd",
            *("".join(chr(draw.choice([32, 10, 39, 97, 115, 65, 49, 33, 233, 0x3B1, 0x4E00, 0x1F600])) for _ in range(60))
              for _ in range(40))]


def test_token_counts_equal_the_library():
    library = Tokenizer.from_file(BYTES)
    ours = token_counts.PretokenCounts(BYTES, {}, 5)
    for text in odd_texts() + [cases.prose(1, 300), cases.prose(2, 300, "fr")]:
        assert ours.of(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_pretoken_pattern_agrees_on_every_sure_code_point():
    library = Tokenizer.from_file(BYTES)
    for c in range(0x2071):
        text = f"a{chr(c)}1{chr(c)}!{chr(c)}  x"
        if not token_counts.UNSURE.search(text):
            spans = [s for _, s in library.pre_tokenizer.pre_tokenize_str(text)]
            assert spans == [m.span() for m in token_counts.PRETOKEN.finditer(text)], hex(c)


def test_token_counts_of_awkward_rows(spark, docs):
    library = Tokenizer.from_file(BYTES)
    got = Counter(map(tuple, token_counts.count_tokens(docs, BYTES, table_size=10).collect()))
    want = Counter()
    for i, t in cases.collected(docs):
        n = len(library.encode(t, add_special_tokens=False).ids)
        want[(i, len(t.encode()), n, n > 512)] += 1
    assert got == want
    assert token_counts.count_tokens(cases.nothing(spark), BYTES).count() == 0


def plain_base(text):
    w = cases.words(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    again = [False] * len(w)
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            again[i:i + 8] = [True] * 8
    lines = [x for x in text.split("\n") if cases.words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(again))


def test_fertility_base_counts(spark, docs):
    extra = spark.createDataFrame([(50, "a # b\n\na # b\r\n x|y \n x|y\n<b> é日 ***"), (51, "same line\n" * 30)], "doc_id bigint, text string")
    table = docs.select("doc_id", "text").unionByName(extra)
    got = Counter()
    for r in fertility.fertility_rules(table, PIECES).collect():
        got[(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)] += 1
        assert not (r.kept and r.base_failed)
    want = Counter()
    for i, t in cases.collected(table):
        base = plain_base(t)
        want[(i, *base, base[0] < 20 or 100 * base[4] > 30 * base[0])] += 1
    assert got == want
    assert fertility.fertility_rules(cases.nothing(spark), PIECES).count() == 0


def test_fertility_figures_and_bands(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    clean, odd = cases.prose(1, 200), " ".join(chr(0x1F300 + i) for i in range(200))
    rows = {r.doc_id: r for r in fertility.fertility_rules(
        spark.createDataFrame([(1, clean), (2, odd)], "doc_id bigint, text string"), PIECES).collect()}
    ids = [i for w in cases.words(clean) for i in model.encode(w)]
    shares = [n / len(ids) for n in Counter(ids).values()]
    assert rows[1].chars_per_token == pytest.approx(sum(map(len, cases.words(clean))) / len(ids))
    assert rows[1].token_entropy == pytest.approx(-sum(s * math.log2(s) for s in shares))
    assert rows[1].kept and rows[1].script == "latin" and rows[1].byte_share == 0
    assert rows[2].byte_share > 0.7 and rows[2].script == "other"
    narrow = {**fertility.BANDS, "latin": (3.9, 4.0, 0.1, 3.0)}
    again = fertility.fertility_rules(spark.createDataFrame([(1, clean)], "doc_id bigint, text string"), PIECES, narrow)
    assert not again.first().kept


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    train = docs.where("crc32(cast(doc_id as string)) % 5 <> 0")
    scored = quality.classify(docs, train, labels).join(labels, "doc_id").where(
        "crc32(cast(doc_id as string)) % 5 = 0").collect()
    good = np.array([r.score for r in scored if r.quality == 1])
    bad = np.array([r.score for r in scored if r.quality == 0])
    assert (good[:, None] > bad[None]).mean() > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in scored)


def test_quality_of_awkward_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1, "x"), (7, 1, "x"), (15, 0, "x"), (15, None, "x"), (None, 1, "x"), (6, 5, "x")],
                                   "doc_id bigint, quality int, score string")
    rows = quality.classify(docs, docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    unlabelled = quality.classify(docs, docs, labels.where("quality > 9")).collect()
    assert {r.score for r in unlabelled} == {0.5}
    assert quality.classify(cases.nothing(spark), docs, labels).count() == 0


def test_subwords_of_a_word():
    ids, owner = quality.subwords([b"ab", b"ab", b"c"], 18)
    assert Counter(ids[owner == 0]) == Counter(ids[owner == 1])
    assert (owner == 0).sum() == 1 + 3 + 2 + 1  # the word and the grams of ^ab$


def greedy(parts: list[str], text: str) -> int:
    """Phrases of a cross-parse: longest matches with any of the parts, or one symbol."""
    n = i = 0
    while i < len(text):
        j = i + 1
        while j < len(text) and any(text[i:j + 1] in p for p in parts):
            j += 1
        n, i = n + 1, j
    return n


def test_phrases_are_those_of_a_greedy_parse():
    samples = {"en": [b"the thing on earth", b"where there"], "fr": ["la même eau où".encode()]}
    known = langid.Languages.learn(samples, 10_000)
    texts = ["the earth", "eau eau là", "zzz the", "où where", "x"]
    block = blocks.Block([t.encode() for t in texts])
    symbols, starts, sizes = langid.clean(block, known.bytes_to)
    got = known.phrases(symbols, starts, sizes)
    for row, name in enumerate(known.names):
        # A symbol of its own for each byte; unknown ones never match.
        parts = ["".join(map(chr, langid.clean(blocks.Block([t]), known.bytes_to)[0] + 100)) for t in samples[name]]
        for i in range(len(texts)):
            text = "".join(map(chr, symbols[starts[i]:starts[i] + sizes[i]] + 100))
            text = text.replace(chr(100 + langid.UNKNOWN), "\x01")
            assert got[row, i] == greedy(parts, text), (name, texts[i])


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r for r in langid.identify(docs, docs.where("crc32(cast(doc_id as string)) % 3 <> 1")).collect()}
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "lang"]).to_pylist()
    held = [r for r in table if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert sum(found[r["doc_id"]].lang_pred == r["lang"] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_of_awkward_rows(spark, docs):
    rows = langid.identify(docs, docs).collect()
    assert len(rows) == docs.count()
    by_text = {}
    for r, (_, t) in zip(rows, cases.collected(docs)):
        by_text.setdefault(r.doc_id, []).append(r.lang_pred)
        assert (r.lang_pred == "und") == (not regex.search(r"\p{L}", t))
    assert by_text[11] == ["fr"] and by_text[7] == ["en"]
    assert {r.lang_pred for r in langid.identify(docs, cases.nothing(spark)).collect()} == {"und"}
    kept = langid.keep_languages(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in rows if r.lang_pred != "und" and r.phrase_rate <= 8)


def test_held_out_documents_take_no_place_in_the_sample(spark):
    texts = [(i, f"text number {i} " + "word " * 4_000) for i in range(60)]
    table = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    found, y = quality.labelled_sample(table.where("doc_id >= 40"), labels, 20, "doc_id", "text", "quality")
    assert len(found) == 20 and sorted(y.tolist()) == [0] * 10 + [1] * 10
    assert {len(t) for t in found} == {len(texts[50][1])}
