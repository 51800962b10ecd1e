"""Nearest vectors: all paths against brute force."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from opslake import inputs, registry
from opslake.functions import vector as vec
from opslake.operators import vectors
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    corpus = rng.normal(size=(400, 8)).astype(np.float32)
    corpus[50:150] = corpus[50]  # a third of all rows are copies of one
    corpus[7] = 0
    queries = rng.normal(size=(30, 8)).astype(np.float32)
    queries[3] = corpus[50]
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id long, vector array<float>")
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "id long, vector array<float>").repartition(5)
    return q, c, queries.astype(float), corpus.astype(float)


def brute(queries, corpus, k, metric, threshold=None):
    found = {}
    for i, q in enumerate(queries):
        for j, c in enumerate(corpus):
            n = np.linalg.norm(q) * np.linalg.norm(c)
            s = {"dot": q @ c, "l2": -((q - c) ** 2).sum(), "cosine": q @ c / n if n else 0.0}[metric]
            if threshold is None or round(s, 6) >= threshold:
                found.setdefault(i, []).append((-round(s, 6), j))
    return {(i, j, r + 1) for i, hits in found.items() for r, (_, j) in enumerate(sorted(hits)[:k])}


@pytest.mark.parametrize("metric, threshold", [("cosine", None), ("cosine", 0.75), ("dot", None), ("l2", None)])
@pytest.mark.parametrize("shared", [1000, 7])
def test_nearest(data, metric, threshold, shared):
    q, c, queries, corpus = data
    rows = vectors.nearest(q, c, 5, metric, threshold, shared_queries=shared).collect()
    assert {(r.query_id, r.id, r.rank) for r in rows} == brute(queries, corpus, 5, metric, threshold)


def test_many_queries_are_dealt_without_a_join(data):
    q, c, _, _ = data
    plan = vectors.nearest(q, c, 5, shared_queries=7)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan
    few, many = ({tuple(r) for r in vectors.ann_candidates(q, c, 10, cells=6, probe=4, shared_queries=n).collect()} for n in (1000, 7))
    assert few == many


def test_ids_may_be_texts_repeat_or_be_missing(spark):
    one, other = [1.0, 0.0], [0.0, 1.0]
    q = spark.createDataFrame([(i, one) for i in range(40)], "query_id int, vector array<float>")
    rows = [("b", one), (None, one), ("a", one), ("a", one), ("c", other)] + [(f"x{i}", [-1.0, 0.0]) for i in range(30)]
    c = spark.createDataFrame(rows, "id string, vector array<float>").repartition(3)
    for shared in (1000, 7):
        found = {i: [] for i in range(40)}
        for r in vectors.nearest(q, c, 5, shared_queries=shared).orderBy("query_id", "rank").collect():
            found[r.query_id].append((r.id, r.score))
        assert set(map(tuple, found.values())) == {((None, 1.0), ("a", 1.0), ("a", 1.0), ("b", 1.0), ("c", 0.0))}


def test_scoring_holds_a_tile_at_a_time():
    rng = np.random.default_rng(1)
    queries, rows = rng.normal(size=(2_000, 8)), rng.normal(size=(10_000, 8)).astype(np.float32)
    rows[100:] = rows[100]  # ties with all that follow
    tracemalloc.start()
    best = vectors._Best(queries, 5, "cosine", None)
    best.add(pa.array(np.arange(10_000)), rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20  # rows × queries alone are 160 MB
    found = pa.Table.from_batches(best.hits(pa.array(np.arange(2_000)))).to_pydict()
    assert {(q, i) for q, i in zip(found["query_id"], found["id"])} == {(q, i) for q, i, _ in brute(queries, rows[:110].astype(float), 5, "cosine")}


def test_empty_sides(data):
    q, c, _, _ = data
    assert vectors.nearest(q.limit(0), c, 5).isEmpty()
    assert vectors.nearest(q, c.limit(0), 5).isEmpty()


def test_zero_vector_has_no_similarity(spark):
    row = spark.range(1).select(vec.cosine(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(2.0))).alias("c")).first()
    assert row.c == 0.0


def test_ann_recall(data):
    q, c, _, _ = data
    exact = {(r.query_id, r.id) for r in vectors.nearest(q, c, 10).collect()}
    near = {(r.query_id, r.id) for r in vectors.ann_candidates(q, c, 10, cells=6, probe=4).collect()}
    assert len(exact & near) / len(exact) > 0.7


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_registered_ann_recall(spark, sf):
    path = f"/root/testdata/{sf}"
    exact = vectors.nearest(inputs.query_vectors(spark, path), inputs.corpus_vectors(spark, path), 10)
    near = {(r.query_id, r.id) for r in registry.queries()["ann_candidates"](spark, path).collect()}
    exact = {(r.query_id, r.id) for r in exact.collect()}
    assert len(exact & near) >= 0.9 * len(exact)


def test_model_and_hash_embedding_agree(spark):
    rows = spark.createDataFrame([("abc",), ("",)], "t string")
    embed = vec.model_embed(vec.hash_encoder)
    for r in rows.select(embed("t").alias("m"), vec.hash_embed(F.col("t")).alias("h")).collect():
        assert np.allclose(r.m, r.h, atol=1e-6) and len(r.h) == 32
