"""Cases that used to give wrong rows or fail: NaN, infinities, long sessions, repeated cache rows, kept API columns."""

import math

from pyspark.sql import functions as F

from opslake.functions.quantiles import exact_quantiles
from opslake.operators import releases, sessions
from opslake.sources import files, tables


def test_quantiles_with_nan_and_infinities(spark):
    rows = spark.createDataFrame(
        [("a", float(v)) for v in range(9)] + [("a", float("nan"))] + [("b", float("inf")), ("b", float("-inf")), ("b", 1.0)],
        "k string, v double")
    got = {r.k: r for r in exact_quantiles(rows, ["k"], F.col("v"), {"p50": 0.5, "top": 1.0}).collect()}
    assert got["a"].p50 == 4.5 and math.isnan(got["a"].top)
    assert got["b"].p50 == 1.0 and got["b"].top == float("inf")


def test_a_long_session_is_one_row_unless_parts_are_asked_for(spark):
    turns = spark.range(1001).select(F.lit("s").alias("session_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
                                     F.lit("x").alias("content"))
    assert sessions.render_chat(turns).count() == 1
    assert sessions.session_documents(turns).count() == 1
    assert sessions.render_chat(turns, part_turns=500).count() == 3


def test_a_prompt_stored_twice_answers_once(spark):
    cache = spark.createDataFrame([("p", "b"), ("p", "a"), (None, "c")], "prompt string, response string")
    asked = spark.createDataFrame([(1, "p"), (2, "q"), (3, None)], "request_id int, prompt string")
    got = {r.request_id: (r.response, r.hit) for r in sessions.cache_lookup(asked, cache).collect()}
    assert got == {1: ("a", True), 2: (None, False), 3: (None, False)}


def test_api_rows_keep_what_addresses_a_document(spark):
    body = '{"data":[{"id":7,"title":"t","typeName":"law","status":"valid","acceptDate":"2020","number":"1","rowNum":3}]}'
    row = files.flatten_api(spark.createDataFrame([(body,)], "body string")).first()
    assert row.asDict() == {"id": 7, "title": "t", "typeName": "law", "status": "valid", "acceptDate": "2020", "number": "1"}


def test_a_changed_day_without_rows_loses_its_partition(spark, tmp_path):
    path = str(tmp_path / "mart")
    rows = spark.createDataFrame([("2024-01-01 10:00:00", 1), ("2024-01-02 00:00:00", 2), ("2024-01-03 23:59:59", 3)],
                                 "ts string, n int").withColumn("ts", F.col("ts").cast("timestamp"))

    def build(source):
        return source.groupBy(F.to_date("ts").alias("dt")).agg(F.sum("n").alias("n"))

    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-03",)], "dt string")
    tables.rebuild_days(rows, days, build, path, "ts")
    tables.rebuild_days(rows.where("n <> 2").withColumn("n", F.col("n") * 10), days.where("dt < '2024-01-03'"), build, path, "ts")
    assert {(str(r.dt), r.n) for r in spark.read.parquet(path).collect()} == {("2024-01-01", 10), ("2024-01-03", 3)}


def test_text_tree_cuts_its_own_root_only(spark, tmp_path, monkeypatch):
    (tmp_path / "docs/sub/docs").mkdir(parents=True)
    (tmp_path / "docs/sub/docs/y.md").write_text("propulsion")
    monkeypatch.chdir(tmp_path)
    for root in (str(tmp_path / "docs"), f"file://{tmp_path}/docs/"):
        assert [tuple(r) for r in files.read_text_tree(spark, root).collect()] == [("sub/docs/y.md", "propulsion")]


def test_rationale_names_the_given_factors(spark):
    row = spark.createDataFrame([(0.01, 0.8, 100.0, 0.04, 0.9, 100.0, 0.0)], "blue_error_rate double, blue_quality_score double, "
                                "blue_latency_p99_ms double, green_error_rate double, green_quality_score double, "
                                "green_latency_p99_ms double, drift_score double")
    got = releases.decide(row, releases.Criteria(max_error_rate=0.5, error_factor=2.5)).first()
    assert got.decision == "hold_for_review" and ">2.5x" in got.rationale
