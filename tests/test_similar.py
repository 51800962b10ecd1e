"""Near-duplicate documents, hot-key joins and generic reach against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from opslake.operators import graph, hot, similar


def sets_of(texts, size=5):
    out = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        out[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    return out


def plain_groups(texts, threshold=0.8):
    """Document to (smallest document of its group, similarity to it), from all pairs."""
    sets = sets_of(texts)
    top = {i: i for i in texts}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    def alike(a, b):
        return len(sets[a] & sets[b]) / len(sets[a] | sets[b]) if sets[a] | sets[b] else 0.0

    names = sorted(texts)
    for k, a in enumerate(names):
        for b in names[:k]:
            if alike(a, b) >= threshold:
                low, high = sorted((root(a), root(b)))
                top[high] = low
    return {i: (root(i), 1.0 if root(i) == i else alike(i, root(i))) for i in texts}


def variants(draw, base, n, changed):
    """Texts that differ from the base in so many words each."""
    out = []
    for _ in range(n):
        w = base.copy()
        for at in draw.sample(range(len(w)), changed):
            w[at] = f"x{draw.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def mixed_texts(seed):
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(400)}"
    base = [word() for _ in range(120)]
    texts = variants(draw, base, 40, 1) + variants(draw, base, 30, 3) + variants(draw, base, 20, 6)
    texts += [" ".join(base)] * 5 + [" ".join(word() for _ in range(60)) for _ in range(40)]
    chain = [word() for _ in range(100)]
    for step in range(8):  # each text is near the next one only
        texts.append(" ".join(chain[step * 4:] + [f"c{k}" for k in range(step * 4)]))
    texts += ["", None, "one two", "one  TWO", "Two one", "a b c d e", " \t "]
    draw.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("share", [1e-4, 0.01])
def test_groups_equal_all_pairs(spark, share, monkeypatch):
    monkeypatch.setattr(hot, "HOT_SHARE", share)
    texts = mixed_texts(3)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.representative, r.score) for r in similar.near_duplicates(docs).collect()}
    want = plain_groups(texts)
    assert {i: r for i, (r, _) in got.items()} == {i: r for i, (r, _) in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 1e-12 for i in texts)
    assert len({r for r, _ in want.values()}) < len(texts) - 40
    assert similar.near_duplicates(docs.limit(0)).count() == 0


def test_a_large_group_costs_comparisons_in_proportion(spark, monkeypatch):
    draw = random.Random(4)
    base = [f"w{draw.randrange(5000)}" for _ in range(300)]
    compared = []
    real = similar.similarities
    monkeypatch.setattr(similar, "similarities", lambda pairs, nodes: compared.append(pairs.count()) or real(pairs, nodes))
    for n in (100, 400):
        docs = spark.createDataFrame(list(enumerate(variants(draw, base, n, 1))), "doc_id bigint, text string")
        found = similar.near_duplicates(docs)
        assert found.select("representative").distinct().count() == 1
    assert sum(compared[len(compared) // 2:]) < 6 * sum(compared[:len(compared) // 2])


def test_short_texts_meet_and_only_sets_that_met_are_stored_whole(spark, monkeypatch):
    """Sets with few shingles in the common part, texts without a match, and the rows of the whole sets that were kept."""
    draw = random.Random(9)
    word = lambda: f"w{draw.randrange(10**6)}"
    texts = []
    for n in (5, 6, 8, 9, 10, 12, 14, 20) * 12:
        base = [word() for _ in range(n + 4)]
        texts += [" ".join(base), " ".join(base + [word()])]  # n and n + 1 shingles: n / (n + 1) is near from n = 4 on
    lone = [" ".join(word() for _ in range(80)) for _ in range(400)]
    texts = dict(enumerate(texts + lone))
    paths = []
    real = similar.shared_dir
    monkeypatch.setattr(similar, "shared_dir", lambda spark, name: paths.append(real(spark, name)) or paths[-1])
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.representative, r.score) for r in similar.near_duplicates(docs).collect()}
    want = plain_groups(texts)
    assert {i: r for i, (r, _) in got.items()} == {i: r for i, (r, _) in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 1e-12 for i in texts)
    assert sum(r != i for i, (r, _) in want.items()) == 96
    whole = [p for p in paths if "/sets-" in p]
    assert whole and sum(spark.read.parquet(p).count() for p in whole) == 192


@pytest.mark.parametrize("share", [1e-4, 0.3, 1.0])
def test_lookup_is_a_join_whatever_counts_as_hot(spark, share):
    rows = spark.range(1000).select((F.col("id") % 7 * F.when(F.col("id") % 2 == 0, 0).otherwise(1)).alias("k"), "id")
    table = rows.where("k <> 3").groupBy("k").agg(F.count("*").alias("held"), F.max("id").alias("top")).cache()
    got = sorted(map(tuple, hot.lookup(rows, table, ["k"], share=share).select("k", "id", "top").collect()))
    assert got == sorted(map(tuple, rows.join(table, "k").select("k", "id", "top").collect()))


def test_pairs_by_key_gives_each_pair_once(spark):
    rows = spark.range(60).select((F.col("id") % 3).alias("k"), "id")
    sizes = rows.groupBy("k").agg(F.count("*").alias("held")).cache()
    pairs = hot.pairs_by_key(rows, sizes, "k", F.col("l.id") < F.col("r.id"), most=7).select("l.id", "r.id").collect()
    assert sorted(map(tuple, pairs)) == [(a, b) for a in range(60) for b in range(a + 1, 60) if a % 3 == b % 3]


@pytest.mark.parametrize("hops", [1, 3, 20])
def test_reach_with_cycles_and_branches(spark, hops):
    draw = random.Random(hops)
    edges = [(a, draw.randrange(30)) for a in range(30) for _ in range(2)] + [(5, 5), (1, 2), (2, 1)]
    frame = spark.createDataFrame(edges, "src int, dst int")
    seeds = spark.createDataFrame([(1,), (5,), (99,)], "src int")
    want = set()
    for seed in (1, 5, 99):
        seen, newest = {seed}, {seed}
        for distance in range(1, hops + 1):
            newest = {b for a, b in edges if a in newest} - seen
            seen |= newest
            want |= {(seed, node, distance) for node in newest}
    got = graph.reach(seeds, frame, hops).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_reach_does_not_store_its_last_round(spark, monkeypatch):
    stored = []
    frame = spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "a"), ("c", "d")], "src string, dst string")
    kind = type(frame)
    checkpoint = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *args, **given: stored.append(1) or checkpoint(self, *args, **given))
    got = graph.reach(frame.where("src = 'a'"), frame, 2).collect()
    assert {(r.node, r.distance) for r in got} == {("b", 1), ("c", 2)} and len(stored) == 2


def test_reach_shuffles_no_pairs(spark):
    """Each of 40 seeds has 5 hubs, each hub 200 nodes: lists are dealt out by lot, never 40,000 pairs by (seed, node)."""
    edges = [(f"s{i}", f"h{(i + k) % 20}") for i in range(40) for k in range(5)]
    edges += [(f"h{j}", f"n{(31 * j + m) % 500}") for j in range(20) for m in range(200)]
    frame = spark.createDataFrame(edges, "src string, dst string")
    got = graph.reach(frame.where("src like 's%'"), frame, 2)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_lot" in plan and "hashpartitioning(seed" not in plan
    nexts = {}
    for a, b in edges:
        nexts.setdefault(a, set()).add(b)
    want = {(s, h, 1) for s in nexts if s[0] == "s" for h in nexts[s]}
    want |= {(s, n, 2) for s, h, _ in want for n in nexts[h]}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)
