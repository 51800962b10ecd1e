"""Streams against their batch operators; sinks repeat without adding anything."""

import json

import pytest
from pyspark.sql import functions as F

from opslake import inputs as src
from opslake.operators import telemetry as tel
from opslake.sources import files, tables
from opslake.streaming import pipeline as st

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def readings(spark):
    return src.telemetry(spark, SF).persist()


def write_lines(rows, path):
    files.telemetry_json(rows).coalesce(1).write.mode("append").text(path)


def key_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_windows_over_several_batches_equal_the_batch_operator(spark, readings, tmp_path):
    lines, out = str(tmp_path / "lines"), str(tmp_path / "out")
    for first, last in (("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2024-02-01")):
        write_lines(readings.where(f"event_time >= '{first}' AND event_time < '{last}'"), lines)
        query = st.run_available(st.minute_aggregates(st.parsed(st.file_lines(spark, lines))), out, f"{out}-ckpt")
        assert st.late_rows(query) == 0
    got = spark.read.parquet(out)
    want = tel.minute_aggregates(readings)
    closed = readings.agg(F.max("event_time") - F.expr("INTERVAL 10 SECONDS")).scalar()
    columns = ["device_id", "event_count", "window_start"]
    assert key_rows(got.select(columns)) == key_rows(want.where(F.col("window_end") <= closed).select(columns))


def test_malformed_lines_are_left_out(spark, tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    good = {"event_id": 1, "device_id": "d", "timestamp": "2024-01-01T00:00:00.5+00:00", "temperature": 99.0}
    (lines / "a.txt").write_text("\n".join([json.dumps(good), "{broken", "[]", '{"event_id": 2}', ""]))
    out = str(tmp_path / "out")
    st.run_available(st.parsed(st.file_lines(spark, str(lines))), out, f"{out}-ckpt")
    assert [r.event_id for r in spark.read.parquet(out).collect()] == [1]


def test_two_sinks_repeat_a_batch_without_copies(spark, readings, tmp_path):
    lake, serving = str(tmp_path / "lake"), str(tmp_path / "serving")
    handle = st.two_sinks(lake, serving, lambda b: b.where("error_code IS NOT NULL"))
    handle(readings, 0)
    handle(readings, 0)
    handle(readings.limit(0), 1)
    assert spark.read.parquet(lake).count() == readings.count()
    assert spark.read.parquet(serving).count() == readings.where("error_code IS NOT NULL").count()


def test_dead_letters_after_the_last_attempt(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("ok", "retry", "dead")}
    handle = st.dead_letter(paths, F.col("action") == "fail")
    tasks = spark.createDataFrame([("a", "run", 0), ("b", "fail", 0), ("c", "fail", 3), ("d", None, 1)],
                                  "job_id string, action string, attempt int")
    handle(tasks, 0)
    got = {n: {(r.job_id, r.attempt) for r in spark.read.parquet(p).collect()} for n, p in paths.items()}
    assert got == {"ok": {("a", 0)}, "retry": {("b", 1), ("d", 2)}, "dead": {("c", 3)}}


def test_stream_of_breaches_equals_batch(spark, readings, tmp_path):
    lines, out = str(tmp_path / "lines"), str(tmp_path / "out")
    for part in ("event_time < '2024-01-15'", "event_time >= '2024-01-15'"):
        write_lines(readings.where(part), lines)
        found = st.consecutive_breaches(st.parsed(st.file_lines(spark, lines)), limit=70.0, k=2)
        st.run_available(found, out, f"{out}-ckpt")
    columns = ["event_id", "run_length"]
    want = tel.consecutive_breaches(readings, limit=70.0, k=2).select(columns)
    assert key_rows(spark.read.parquet(out).select(columns)) == key_rows(want)


def test_sessions_are_capped_isolated_and_forgotten(spark, tmp_path):
    lines, out = str(tmp_path / "lines"), str(tmp_path / "out")
    kind = "session_id string, turn long, role string, content string, created_at timestamp"

    def feed(rows):
        spark.createDataFrame(rows, "session_id string, turn long, role string, content string, at string").withColumn(
            "created_at", F.col("at").cast("timestamp")).drop("at").coalesce(1).write.mode("append").json(lines)
        history = st.session_history(spark.readStream.schema(kind).json(lines), keep=3, idle_seconds=3600)
        st.for_each_batch(history, f"{out}-ckpt", lambda b, i: b.withColumn("b", F.lit(i)).write.mode("append").parquet(out),
                          mode="update")

    feed([("s", t, "user", f"msg{t}", "2024-01-01 00:00:00") for t in range(4)])
    feed([("s", 4, "user", "msg4", "2024-01-01 00:10:00"), ("t", 0, "user", "x", "2024-01-01 00:10:00")])
    feed([("t", 1, "user", "y", "2024-01-01 06:00:00")])
    feed([("s", 5, "user", "msg5", "2024-01-01 06:00:30")])
    rows = spark.read.parquet(out).orderBy("b").collect()
    of_s = [r for r in rows if r.session_id == "s"]
    assert [m[2] for m in json.loads(of_s[1].history)] == ["msg2", "msg3", "msg4"]
    assert [m[2] for m in json.loads(of_s[2].history)] == ["msg5"]
    assert [r.messages for r in rows if r.session_id == "t"][0] == 1


def test_stream_dedup(spark, readings, tmp_path):
    lines, out = str(tmp_path / "lines"), str(tmp_path / "out")
    write_lines(readings.limit(50).unionByName(readings.limit(50)), lines)
    st.run_available(st.dedup(st.parsed(st.file_lines(spark, lines))), out, f"{out}-ckpt")
    rows = spark.read.parquet(out)
    assert rows.count() == rows.select("event_id").distinct().count() == 50


def test_daily_layout_prunes_and_incremental_equals_full(spark, readings, tmp_path):
    path = str(tmp_path / "daily")
    tables.write_daily(readings, path, "event_time", ["device_id"], files_per_day=2)
    day = spark.read.parquet(path).where("dt = DATE '2024-01-05'")
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString()
    assert day.count() == readings.where("to_date(event_time) = DATE '2024-01-05'").count()


def test_missing_history_is_skipped(spark, tmp_path):
    assert files.read_history(spark, str(tmp_path / "none"), "2024-01-31 00:00:00") is None
