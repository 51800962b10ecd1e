"""Suffix tree language model, packing, decontamination, registry and pipeline."""

import math
import bisect
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from llm import cases
from opslake.llm import decontam, langid, neardup, packing, queries, suffix_tree

WORDS = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return cases.awkward(spark).cache()


def tokens(text):
    return [*text.encode().lower().split(), None]


def test_base_scores_of_awkward_rows(spark, docs):
    learns = F.col("doc_id") % 2 == 1
    rows = suffix_tree.score_texts(docs, learns).collect()
    texts = cases.collected(docs)
    c = Counter(w for i, t in texts if i is not None and i % 2 == 1 for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in texts:
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))
        want[(i, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert {r.score for r in suffix_tree.score_texts(docs, F.lit(False)).collect()} == {0.0}
    assert suffix_tree.score_texts(cases.nothing(spark), F.lit(True)).count() == 0


def plain_chance(tree, history, word):
    """Chance of a frequent word (by number) after frequent words, from the layers as they are defined."""
    chance = tree.root(tree.counts[word])
    for depth, layer in enumerate(tree.layers, start=1):
        if len(history) < depth:
            break
        context = history[-depth]
        for level, w in zip(tree.layers, history[len(history) - depth + 1:]):
            context = int(level.find(np.array([context << 32 | w]))[0])
            if context < 0:
                return chance
        if layer.kept[context]:
            at = int(layer.find(np.array([context << 32 | word]))[0])
            chance = layer.chance[at] if at >= 0 else layer.rest[context] * chance
    return chance


def test_tree_is_a_distribution_and_scores_by_the_longest_suffix(spark):
    draw = random.Random(1)
    phrases = ["a b c", "a x y", "q b z"]
    lines = [" ".join(draw.choice(phrases) for _ in range(40)) for _ in range(60)]
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    tree, _ = suffix_tree.learn(table.select("text"), 3, 1e-7, 1e-6, 0.75, 0.01)
    assert len(tree.layers) == 3 and all(layer.kept.any() for layer in tree.layers[:2])
    every = range(len(tree.words))
    unknown = tree.root(0)
    number = {w: i for i, w in enumerate(tree.words.tolist())}
    block = suffix_tree.Tokens(suffix_tree.Block([b"a b"]), None)
    a, b = (number[int(h)] for h in block.hash[:2])
    for history in ([], [a], [b], [a, b], [b, a], [a, b, a]):
        total = sum(plain_chance(tree, history, w) for w in every)
        # What is left for the unknown word is scaled with every kept state.
        left, scale = unknown, 1.0
        for depth, layer in enumerate(tree.layers, start=1):
            if len(history) >= depth:
                context = history[-depth]
                for level, w in zip(tree.layers, history[len(history) - depth + 1:]):
                    context = int(level.find(np.array([context << 32 | w]))[0]) if context >= 0 else -1
                if context >= 0 and layer.kept[context]:
                    scale *= layer.rest[context]
        assert total + left * scale == pytest.approx(1, abs=1e-6)
    scored = {r.doc_id: r.score for r in suffix_tree.score_texts(
        table, F.lit(True), depth=3, least_share=1e-7, context_share=1e-6).collect()}
    for i, text in list(enumerate(lines))[:5]:
        seq = [number[int(h)] for h in suffix_tree.Tokens(suffix_tree.Block([text.encode()]), None).hash]
        history, total = [len(tree.words)], 0.0
        for w in seq:
            total += math.log10(plain_chance(tree, history, w))
            history.append(w)
        assert scored[i] == pytest.approx(total)


def test_held_out_texts_score_better_than_the_base(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    sums = suffix_tree.score_texts(table, ~held).where(held).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert sums[0] > sums[1] + 0.1 * sums[2]


def plain_pieces(texts, capacity):
    library, out = Tokenizer.from_file(WORDS), Counter()
    for i, t in texts:
        ids = library.encode(t, add_special_tokens=False).ids + [0]
        for p, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4")
            out[(i, p, at, len(part), zlib.crc32(part.tobytes()))] += 1
    return out


@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing_of_awkward_rows(spark, docs, capacity):
    odd = spark.createDataFrame([(90, "İstanbul ΣΑΣ ﬁ é <|startoftext|>X<|endoftext|>"), (91, "it's Æon’s “q” 12")],
                                "doc_id bigint, text string")
    table = docs.select("doc_id", "text").unionByName(odd)
    pieces = packing.encode_pieces(table, WORDS, capacity).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")).checkpoint()
    rows = packing.pack(pieces, capacity, rows_per_share=50).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == plain_pieces(
        cases.collected(table), capacity)
    check_sequences(rows, capacity)
    assert packing.pack(packing.encode_pieces(cases.nothing(spark), WORDS)).count() == 0


def check_sequences(rows, capacity):
    inside = {}
    for r in rows:
        inside.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in inside.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(inside)


def test_plan_fills_exactly_where_it_can():
    plan = packing.Plan({60: 10, 40: 4, 25: 6, 15: 6, 20: 2, 10: 6, 100: 3}, 100)
    assert sum(t for t, _ in plan.sequences) == 14
    assert all(sum(x) == 100 for t, x in plan.sequences if t)


def best_fit(counts, capacity):
    """Number of sequences of plain best fit in decreasing order."""
    gaps = []
    for length in sorted(counts.elements(), reverse=True):
        at = bisect.bisect_left(gaps, length)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        bisect.insort(gaps, gap - length)
    return len(gaps)


@pytest.mark.parametrize("seed", [5, 1, 2, 3])
def test_plan_is_no_worse_than_best_fit(seed):
    draw = random.Random(seed)
    counts = Counter(draw.randint(1, 512) for _ in range(20_000))
    plan = packing.best_plan(dict(counts), 512)
    used = Counter()
    for times, lengths in plan.sequences:
        assert sum(lengths) <= 512
        for x in lengths:
            used[x] += times
    assert used == counts
    floor = max(sum(k * n for k, n in counts.items()) / 512, sum(n for k, n in counts.items() if k > 256) + counts[256] / 2)
    assert floor <= plan.size <= best_fit(counts, 512)


def test_pretokens_equal_the_pattern_on_every_sure_character():
    whole = regex.compile(packing.PRETOKEN_SOURCE)
    for c in packing.SURE:
        if not packing.UNSURE.search(c):
            text = f"a{c}1{c}!{c}  x'{c} {c}s'll".lower()
            assert packing.PRETOKEN.findall(text) == whole.findall(text), hex(ord(c))


def test_texts_come_in_small_batches(spark):
    """Encoding, language and near-duplicate steps hold few texts at once, whatever the session's batch size was."""
    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.createDataFrame([(i, "some words", "en") for i in range(3000)], "doc_id bigint, text string, lang string").coalesce(1)
    steps = [lambda: packing.encode_pieces(docs, WORDS), lambda: langid.identify(docs, docs), lambda: neardup.near_duplicates(docs)]
    for step in steps:
        spark.conf.unset(key)
        table = step()
        assert int(spark.conf.get(key)) <= 1000
        if "piece" in table.columns:
            assert max(r.n for r in table.mapInArrow(rows, "n bigint").collect()) <= 1000


def verdicts(spark, texts, items, **options):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return {r.doc_id: r for r in decontam.contaminated(d, b, **options).collect()}


def test_reparameterised_questions_are_caught_if_slots_agree(spark):
    item = ("If a train with Anna leaves the station at 12 km per hour and Boris follows Anna after 30 minutes, "
            "how far does Anna get before Boris waves?")
    same = item.replace("Anna", "Zoe").replace("Boris", "Karl").replace("12", "95").replace("30", "7")
    crossed = ("If a train with Zoe leaves the station at 12 km per hour and Zoe follows Karl after 30 minutes, "
               "how far does Karl get before Zoe waves?")
    other = "If a boat with Anna enters the harbour at 12 km per day and nobody follows, what does Anna do before Boris sleeps there?"
    got = verdicts(spark, ["Intro. " + item + " End.", "x y z. " + same, crossed, other, None, "", item.lower()], [item, None, ""])
    assert got[0].contaminated and got[1].contaminated and got[1].item_id == 0
    assert got[1].n_windows > got[2].n_windows
    assert not got[3].contaminated and not got[4].contaminated and not got[5].contaminated
    short = verdicts(spark, ["well, the quick red fox said so", "the quick red fax said so"], ["the quick red fox said so"])
    assert short[0].contaminated and not short[1].contaminated


def test_decontamination_of_awkward_rows(spark, docs):
    bench = spark.createDataFrame([(1, cases.prose(900, 60), "x"), (0, cases.prose(900, 60), "x"), (None, cases.prose(3, 80, "fr"), "x")],
                                  "item_id bigint, text string, size string")
    rows = decontam.contaminated(docs, bench).collect()
    assert len(rows) == docs.count()
    hit = {r.doc_id: r.item_id for r in rows if r.contaminated}
    assert hit == {7: 0, 8: 0, 1: None}
    assert not any(r.contaminated for r in decontam.contaminated(docs, bench.limit(0)).collect())
    assert decontam.contaminated(cases.nothing(spark), bench).count() == 0
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not r.contaminated for r in rows)


def test_queries_are_registered():
    assert [int(name[2:].split("_")[0]) for name in queries.QUERIES] == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    stage = {}
    current = docs
    for name, step in corpus_pipeline.STAGES:
        current = stage[name] = step(spark, current, SF).cache()
        if name != "best_fit_packing":
            assert current.schema.names == docs.schema.names
    texts = dict(cases.collected(docs))
    found = {r.doc_id: r for r in langid.identify(docs, docs).collect()}
    after = {i: t for i, t in texts.items() if found[i].lang_pred != "und" and found[i].phrase_rate <= 8}
    assert dict(cases.collected(stage["language_id"])) == after
    classes = cases.near_classes(after)
    after = {i: t for i, t in after.items() if classes[i] == i}
    assert dict(cases.collected(stage["minhash_neardup"])) == after
    order = sorted(after)
    masks = cases.earlier_bytes([after[i].encode() for i in order], 100)
    after = {i: bytes(b for b, m in zip(after[i].encode(), mask) if not m).decode("utf-8", "ignore")
             for i, mask in zip(order, masks)}
    assert dict(cases.collected(stage["suffix_dedup"])) == after
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(after.items()))
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF}/benchmark.parquet')")
    dirty = {r[0] for r in con.execute(decontam.SQL).fetchall() if r[3]}
    after = {i: t for i, t in after.items() if i not in dirty}
    assert dict(cases.collected(stage["decontamination"])) == after and dirty
    rows = stage["best_fit_packing"].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == plain_pieces(after.items(), 2048)
    n = check_sequences(rows, 2048)
    assert n <= 1.02 * sum(r.length for r in rows) / 2048 + 1
    assert len(steps) == 5


def test_decontamination_equals_its_sql(spark):
    import compare

    key = "op10_decontamination"
    assert compare.compare(spark, compare.connect(SF), key, entry.queries()[key], entry.oracle_sql()[key], SF) is None


def test_native_plan_has_no_python(spark):
    frame = entry.queries()["op10_decontamination"](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
