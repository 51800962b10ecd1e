"""Queries over streams that keep state over several micro-batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslake import inputs as src
from opslake.operators.quality import row_rules
from opslake.plans.catalog import VIEWS, oracle, query
from opslake.plans.telemetry import RULE_ROWS, dirty
from opslake.session import shared_dir
from opslake.sources import files
from opslake.streaming import pipeline as st
from opslake.streaming import sessions as ss
from opslake.streaming import watch


def appended(rows, path: str, parts) -> None:
    """The rows of each condition as JSON lines, one append after the other."""
    for part in parts:
        files.telemetry_json(rows.where(part)).write.mode("append").text(path)
        yield part


# All sessions begin together and bring a message every half hour; every third one pauses before its fifth message.
CHAT = """SELECT session_id, turn, role, content, TIMESTAMP '2024-01-01' + to_seconds(CAST(
    turn * 1800 + conv_id % 60 + CASE WHEN conv_id % 3 = 0 AND turn >= 4 THEN 7200 ELSE 0 END AS BIGINT)) AS moment FROM messages"""


@query("session_timers", oracle("session_id messages:i first_turn:i last_turn:i body", f"""
    SELECT session_id, count(*) AS messages, min(turn) AS first_turn, max(turn) AS last_turn,
           md5(string_agg(turn || ':' || role || ':' || content, chr(10) ORDER BY turn)) AS body
    FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) AS rn,
                 sum(pause) OVER (PARTITION BY session_id ORDER BY turn DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pauses
          FROM (SELECT *, CASE WHEN moment - lag(moment) OVER (PARTITION BY session_id ORDER BY turn) > INTERVAL 1 HOUR THEN 1 ELSE 0 END
                    AS pause FROM ({CHAT})))
    WHERE rn <= 3 AND coalesce(pauses, 0) = 0 GROUP BY session_id""", "messages"))
def _(spark, sf):
    """Every turn comes in a run of its own; the last run finds nothing new and adds nothing."""
    lines, path = shared_dir(spark, "turns"), shared_dir(spark, "turn-history")
    kind = "session_id string, turn bigint, role string, content string, created_at timestamp"
    seconds = F.col("turn") * 1800 + F.col("conv_id") % 60 + F.when((F.col("conv_id") % 3 == 0) & (F.col("turn") >= 4), 7200).otherwise(0)
    start = F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    chat = src.messages(spark, sf).withColumn("created_at", F.timestamp_seconds(start + seconds)).select(
        "session_id", "turn", "role", "content", "created_at")
    with ss.with_state_store(spark):
        for part in ("turn < 1", "turn = 1", "turn IN (2, 3)", "turn = 4", "turn > 4", "false"):
            chat.where(part).write.mode("append").json(lines)
            history = ss.session_messages(spark.readStream.schema(kind).json(lines), keep=3, delay="4 hours")
            st.for_each_batch(history, f"{path}-ckpt", st.one_sink(path), mode="update")
    newest = spark.read.schema(f"{ss.HISTORY}, batch_id bigint").parquet(path).groupBy("session_id").agg(
        F.max_by(F.struct("messages", "first_turn", "last_turn", "history"), "batch_id").alias("r"))
    shown = F.transform("r.history", lambda m: F.concat_ws(":", m["turn"].cast("string"), m["role"], m["content"]))
    return newest.select("session_id", "r.messages", "r.first_turn", "r.last_turn", F.md5(F.array_join(shown, "\n")).alias("body"))


SENT = """
    SELECT event_id, event_time FROM telemetry
    UNION ALL SELECT event_id, event_time + INTERVAL 1 HOUR FROM telemetry WHERE event_id % 4 = 0
    UNION ALL SELECT event_id, event_time + INTERVAL 10 DAY FROM telemetry WHERE event_id % 4 = 1"""
SLICE = "(epoch_us({}) - epoch_us(TIMESTAMP '2024-01-01')) // 864000000000"


@query("dedup_stream", oracle("event_id rows:i", f"""
    WITH sent AS ({SENT}), tops AS (SELECT s, max(top) OVER (ORDER BY s) AS top FROM (
        SELECT {SLICE.format('event_time')} AS s, max(event_time) AS top FROM sent GROUP BY 1))
    SELECT event_id, 1 + CASE WHEN event_id % 4 = 1 AND event_time + INTERVAL 2 DAY <= top - INTERVAL 2 DAY THEN 1 ELSE 0 END AS rows
    FROM telemetry JOIN tops ON s = {SLICE.format('event_time')}""", "telemetry"))
def _(spark, sf):
    """Events sent again after an hour are dropped; those sent again after ten days pass once their state is gone.

    The stream comes in runs of ten days with a delay of two, so an event is forgotten at the end of its run unless it is among
    the last four days.
    """
    rows = src.telemetry(spark, sf)
    sent = rows.unionByName(rows.where("event_id % 4 = 0").withColumn("event_time", F.expr("event_time + INTERVAL 1 HOUR"))).unionByName(
        rows.where("event_id % 4 = 1").withColumn("event_time", F.expr("event_time + INTERVAL 10 DAYS")))
    lines, path = shared_dir(spark, "sent"), shared_dir(spark, "once")
    first = F.unix_date(F.lit("2024-01-01").cast("date"))
    run = F.floor((F.unix_date(F.to_date("event_time")) - first) / 10)
    for _ in appended(sent, lines, [run == i for i in range(4)]):
        once = st.dedup(st.parsed(st.file_lines(spark, lines)), "2 days")
        st.run_available(once.select("event_id", "event_time"), path, f"{path}-ckpt")
    return spark.read.schema("event_id bigint, event_time timestamp").parquet(path).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("rows"))


@query("stream_expectations", oracle("rule violations:i", f"""
    SELECT rule, violations FROM ({RULE_ROWS}) WHERE rule <> 'data_freshness' UNION ALL SELECT 'rows', count(*) FROM telemetry
    """, "telemetry"))
def _(spark, sf):
    """The report on broken rules, counted in the pass that writes the stream in several micro-batches."""
    raw, path = shared_dir(spark, "dirty"), shared_dir(spark, "checked")
    rows = dirty(spark, sf)
    rows.repartition(6, "event_id").write.parquet(raw)
    with watch.totals(spark) as heard:
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(raw)
        done = st.run_available(watch.observed(stream, row_rules()), path, f"{path}-ckpt")
        heard.wait(done)
    return spark.createDataFrame(list(heard.observed[done.id].items()), "rule string, violations bigint")
