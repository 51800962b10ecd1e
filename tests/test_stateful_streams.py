"""State over several micro-batches: sessions with timers, and figures that outlive the kept progress."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from opslake.streaming import pipeline as st
from opslake.streaming import sessions as ss
from opslake.streaming import watch

CHAT = "session_id string, turn bigint, role string, content string, created_at timestamp"


def chat_rows(spark, rows):
    frame = spark.createDataFrame(rows, "session_id string, turn bigint, at bigint")
    return frame.select("session_id", "turn", F.lit("user").alias("role"), F.concat(F.lit("m"), "turn").alias("content"),
                        F.timestamp_seconds(1_704_067_200 + F.col("at")).alias("created_at"))


def newest(spark, path):
    rows = spark.read.schema(f"{ss.HISTORY}, batch_id bigint").parquet(path).groupBy("session_id").agg(
        F.max_by(F.struct("messages", "first_turn", "last_turn"), "batch_id").alias("r"))
    return {r.session_id: tuple(r.r) for r in rows.collect()}


def run(spark, lines, path, **options):
    with ss.with_state_store(spark):
        history = ss.session_messages(spark.readStream.schema(CHAT).json(lines), **options)
        return st.for_each_batch(history, f"{path}-ckpt", st.one_sink(path), mode="update")


def test_a_session_over_five_batches_with_a_pause(spark, tmp_path):
    lines, path = str(tmp_path / "chat"), str(tmp_path / "history")
    batches = [[("a", 0, 0), ("b", 0, 5)], [("a", 1, 600), ("a", 2, 700)], [("a", 3, 9_000), ("c", 0, 9_000)],
               [("a", 4, 9_100), ("a", 5, 9_200), ("a", 6, 9_300)], [("b", 1, 40_000), ("a", 7, 9_400 + 30_000)]]
    seen = []
    for batch in batches:
        chat_rows(spark, batch).coalesce(1).write.mode("append").json(lines)
        run(spark, lines, path, keep=3, delay="10 hours")
        seen.append(newest(spark, path)["a"])
    # Three messages, a pause beyond an hour, three of four, and a pause again.
    assert seen == [(1, 0, 0), (3, 0, 2), (1, 3, 3), (3, 4, 6), (1, 7, 7)]
    assert newest(spark, path)["b"] == (1, 1, 1) and newest(spark, path)["c"] == (1, 0, 0)
    before = spark.read.parquet(path).count()
    run(spark, lines, path, keep=3, delay="10 hours")
    assert spark.read.parquet(path).count() == before


def test_timers_drop_what_is_idle_and_a_time_to_live_needs_no_watermark(spark, tmp_path):
    lines, path = str(tmp_path / "chat"), str(tmp_path / "history")
    for batch in ([("a", 0, 0)], [("b", 0, 90_000)], [("b", 1, 90_010)]):
        chat_rows(spark, batch).coalesce(1).write.mode("append").json(lines)
        last = run(spark, lines, path, delay="10 seconds")
    kept = [int(s["numRowsTotal"]) for p in last.recentProgress for s in p["stateOperators"]] if isinstance(
        last.recentProgress[0], dict) else [s.numRowsTotal for p in last.recentProgress for s in p.stateOperators]
    # Two messages and one timer of b are left of the three messages.
    assert kept and max(kept) <= 4
    other = str(tmp_path / "ttl")
    with ss.with_state_store(spark):
        history = ss.session_messages(spark.readStream.schema(CHAT).json(lines), event_time=False)
        one = history.writeStream.foreachBatch(st.one_sink(other)).outputMode("update").option(
            "checkpointLocation", f"{other}-ckpt").trigger(once=True).start()
        assert one.awaitTermination(100)
    assert newest(spark, other) == {"a": (1, 0, 0), "b": (2, 0, 1)}


def test_a_session_is_read_row_by_row_and_a_new_one_has_no_timers_to_look_for():
    class Handle:
        """A stand-in for the engine: one list and the timers."""
        def __init__(self):
            self.list, self.timers, self.looked = [], [], 0
            self.get, self.put = lambda: iter(self.list), lambda rows: setattr(self, "list", rows)
            self.clear = lambda: self.put([])

        def getListState(self, *_):
            return self

        def listTimers(self):
            self.looked += 1
            return iter(self.timers)

        def deleteTimer(self, at):
            self.timers.remove(at)

        def registerTimer(self, at):
            self.timers.append(at)

        def getCurrentWatermarkInMs(self):
            return 0

    def sent(turns):
        return (Row(at=t * 1000, turn=t, role="user", content=None) for t in turns)

    handle, session = Handle(), ss.SessionHistory(3, 3600, True)
    session.init(handle)
    first, = session.handleInputRows(("a",), sent(reversed(range(2 * ss.PART + 7))), handle)
    assert (first.messages, first.first_turn, first.last_turn) == (3, 2 * ss.PART + 4, 2 * ss.PART + 6) and not handle.looked
    second, = session.handleInputRows(("a",), sent([90_000]), handle)
    assert (second.messages, second.first_turn) == (1, 90_000)
    assert handle.timers == [90_000_000 + 3_600_000] and handle.looked == 1
    assert not list(session.handleExpiredTimer(("a",), handle, None)) and not handle.list


def test_latest_stretch():
    rows = [(t, i, "r", "c") for i, t in enumerate([0, 10, 20, 500, 510, 520])]
    assert [r[1] for r in ss.latest_stretch(rows[::-1], 50, 100)] == [3, 4, 5]
    assert [r[1] for r in ss.latest_stretch(rows, 2, 100)] == [4, 5]
    assert [r[1] for r in ss.latest_stretch(rows[:1], 2, 100)] == [0]


def test_figures_stay_complete_beyond_the_kept_progress(spark, tmp_path):
    raw, path = str(tmp_path / "raw"), str(tmp_path / "out")
    rows = spark.range(400).select("id", F.timestamp_seconds(1_704_067_200 + F.col("id") * 60).alias("event_time"))
    for part in range(8):  # the rows of every later file end before those of the first: all late but the first file's
        rows.where(f"id >= {(7 - part) * 50} AND id < {(8 - part) * 50}").coalesce(1).write.mode("append").parquet(raw)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        with watch.totals(spark) as heard:
            stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(raw)
            checked = watch.observed(stream, {"odd": F.col("id") % 2 == 1})
            counted = checked.withWatermark("event_time", "1 minute").groupBy("event_time").agg(F.count(F.lit(1)).alias("n"))
            done = st.run_available(counted, path, f"{path}-ckpt")
            heard.wait(done)
    finally:
        spark.conf.set(key, before)
    assert len(done.recentProgress) <= 2
    assert heard.rows[done.id] == 400 and dict(heard.observed[done.id]) == {"rows": 400, "odd": 200}
    assert heard.late[done.id] >= 300
