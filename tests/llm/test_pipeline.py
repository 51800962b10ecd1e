"""The pipeline over awkward rows, with clashing column names, and over nothing."""

import pytest

import corpus_pipeline
from llm import cases


def stored(spark, docs, path):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, cases.prose(60, 30)), (2, None), (3, "")], "item_id bigint, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return str(path)


def test_stages_over_awkward_rows(spark, tmp_path):
    item = cases.prose(60, 30)
    more = spark.createDataFrame([(30, item + " " + cases.prose(61, 40), "en", "s", 1) + cases.CLASH], cases.SCHEMA)
    awkward = cases.awkward(spark).unionByName(more)
    sf = stored(spark, awkward, tmp_path)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{sf}/{i}.parquet")
        docs = spark.read.parquet(f"{sf}/{i}.parquet")
        kept.append([r.doc_id for r in docs.select("doc_id").collect()])
    language, near, cut, clean, packed = kept
    # Rows without letters go first: null, empty and blank texts, digits.
    assert not {3, 4, 5, 6} & set(language) and {1, 2, 7, 8, 11, 30} <= set(language)
    # One of the copies of a text stays, the one with the smallest id; two texts of one id are two documents.
    assert -14 in near and 2 not in near and near.count(1) == 1 and near.count(None) == 1
    assert len({9, 10} & set(near)) <= 1 and sorted(map(str, cut)) == sorted(map(str, near))
    assert 30 in cut and 30 not in clean and set(map(str, cut)) - set(map(str, clean)) == {"30"}
    assert set(map(str, packed)) == set(map(str, clean))
    places = {}
    for r in docs.collect():
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_pipeline_over_nothing(spark, tmp_path):
    sf = stored(spark, cases.nothing(spark), tmp_path)
    assert corpus_pipeline.run(spark, sf).count() == 0
