"""Queries that write and read files and run streams. Each works in its own folder of the shared scratch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake import inputs as src
from opslake import schemas
from opslake.inputs import AS_OF
from opslake.operators import scoring, sessions, sketches
from opslake.plans.catalog import oracle, query
from opslake.plans.telemetry import MINUTE, MINUTES, dimension, staged_devices
from opslake.session import shared_dir
from opslake.sources import files, tables
from opslake.sources.ledger import Ledger
from opslake.streaming import pipeline as st
from opslake.streaming import watch

BASIC = ["event_id", "device_id", "event_time", "temperature", "error_code"]
BASIC_SQL = "event_id device_id event_time:t temperature:r error_code"
CLOSED = "window_end <= (SELECT max(event_time) - INTERVAL 10 SECOND FROM telemetry)"


def staged(spark, sf) -> str:
    """Folder of telemetry messages as JSON lines."""
    path = shared_dir(spark, "messages")
    files.telemetry_json(src.telemetry(spark, sf)).write.text(path)
    return path


def counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


# Sources

@query("parse_telemetry", oracle(BASIC_SQL + " vibration:r rpm:r", "SELECT * FROM telemetry", "telemetry"))
def _(spark, sf):
    lines = files.telemetry_json(src.telemetry(spark, sf))
    return files.parse_telemetry(lines, AS_OF).select(*BASIC, "vibration", "rpm")


def with_broken(spark, sf):
    """Messages of which some are cut off and some lack their time."""
    lines = files.telemetry_json(src.telemetry(spark, sf)).withColumn("n", F.get_json_object("value", "$.event_id").cast("long"))
    return lines.select(F.when(F.col("n") % 50 == 0, F.left("value", F.lit(25)))
                        .when(F.col("n") % 50 == 1, F.regexp_replace("value", '"timestamp":"[^"]*",', ""))
                        .otherwise(F.col("value")).alias("value"))


@query("tolerant_parse", oracle(BASIC_SQL, "SELECT * FROM telemetry WHERE event_id % 50 > 1", "telemetry"))
def _(spark, sf):
    return files.tolerant_parse(with_broken(spark, sf), AS_OF).select(*BASIC)


@query("src_devices_csv", oracle(
    "device_id device_type install_date:d maintenance_interval_days:i last_maintenance_date:d status",
    "SELECT * FROM device_latest", "device_latest"))
def _(spark, sf):
    path = shared_dir(spark, "devices-csv")
    staged_devices(spark, sf).drop("updated_at", "days_since_maintenance").write.option("header", True).csv(path)
    return files.read_devices_csv(spark, path, AS_OF).select(
        "device_id", "device_type", "install_date", "maintenance_interval_days", "last_maintenance_date", "status")


@query("src_history", oracle(BASIC_SQL, "SELECT * FROM telemetry", "telemetry"))
def _(spark, sf):
    path = shared_dir(spark, "history")
    files.telemetry_json(src.telemetry(spark, sf)).select(
        F.from_json("value", schemas.TELEMETRY_MESSAGE).alias("m")).select("m.*").write.parquet(path)
    return files.read_history(spark, path, AS_OF).select(*BASIC)


@query("src_manuals", oracle("id title content_hash", """
    SELECT coalesce(CASE WHEN doc_id % 7 <> 0 THEN 'm' || CAST(doc_id AS VARCHAR) END,
               left(sha256('Manual ' || source || '|' || text), 32)) AS id,
           'Manual ' || source AS title, md5(text) AS content_hash FROM documents"""))
def _(spark, sf):
    # Arrays of at most 500 manuals; some carry their body under "text", some have no id.
    body = F.col("text")
    manual = F.struct(
        F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("m"), F.col("doc_id").cast("string"))).alias("id"),
        F.concat(F.lit("Manual "), "source").alias("title"),
        F.when(F.col("doc_id") % 2 == 0, body).alias("content"), F.when(F.col("doc_id") % 2 == 1, body).alias("text"))
    path = shared_dir(spark, "manuals")
    src.table(spark, sf, "documents").groupBy(F.floor(F.col("doc_id") / 500).alias("share")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(manual)), ","), F.lit("]")).alias("value")
    ).write.partitionBy("share").text(path)
    return files.read_manuals(spark, f"{path}/*").select("id", "title", F.md5("content").alias("content_hash"))


@query("compact_small_files", oracle("doc_id lang source", "SELECT doc_id, lang, source FROM documents"))
def _(spark, sf):
    rows = src.table(spark, sf, "documents").select("doc_id", "lang", "source")
    csv, parquet = shared_dir(spark, "small-csv"), shared_dir(spark, "small-parquet")
    rows.where("doc_id % 2 = 0").repartition(20).write.option("header", True).csv(csv)
    rows.where("doc_id % 2 = 1").repartition(20).write.parquet(parquet)
    return files.compact(spark, [("csv", csv), ("parquet", parquet)], "doc_id bigint, lang string, source string",
                         shared_dir(spark, "compacted"), 4).drop("file_no")


@query("src_text_tree", oracle("source chars:i", """
    SELECT source, sum(length(CAST(doc_id AS VARCHAR)) + 1 + length(text) + 1) AS chars FROM documents GROUP BY 1"""))
def _(spark, sf):
    path = shared_dir(spark, "tree")
    src.table(spark, sf, "documents").select("source", F.concat_ws("|", "doc_id", "text").alias("value")).write.partitionBy(
        "source").text(path)
    found = files.read_text_tree(spark, path)
    return found.groupBy(F.regexp_extract("source", "source=([^/]+)/", 1).alias("source")).agg(
        F.sum(F.length("text")).alias("chars"))


@query("flatten_api_json", oracle(
    "id title typeName status acceptDate number", """
    SELECT doc_id AS id, 'Act ' || CAST(doc_id AS VARCHAR) AS title, lang AS typeName, 'valid' AS status,
           '2024-01-01' AS acceptDate, source AS number FROM documents"""))
def _(spark, sf):
    item = F.struct(
        F.col("doc_id").alias("id"), F.concat(F.lit("Act "), F.col("doc_id").cast("string")).alias("title"),
        F.col("lang").alias("typeName"), F.lit("valid").alias("status"), F.lit("2024-01-01").alias("acceptDate"),
        F.col("source").alias("number"), F.col("doc_id").alias("rowNum"), F.lit("x").alias("citation"))
    responses = src.table(spark, sf, "documents").groupBy(F.floor(F.col("doc_id") / 100)).agg(
        F.collect_list(item).alias("data")).select(F.to_json(F.struct("data")).alias("body"))
    return files.flatten_api(responses)


@query("file_check", oracle("name present:b", """
    SELECT 'src' || CAST(i AS VARCHAR) || '.txt' AS name, FALSE AS present FROM range(0, 3) AS g(i)
    UNION ALL SELECT '_SUCCESS', TRUE"""))
def _(spark, sf):
    path = shared_dir(spark, "checked")
    src.table(spark, sf, "documents").select(F.col("source").alias("value")).write.text(path)
    spark.range(1).selectExpr("'ok' AS value").coalesce(1).write.text(f"{path}/extra")
    found = files.list_files(spark, path, "*").select(F.when(
        F.col("extension") == "txt", F.lit("_SUCCESS")).otherwise(F.col("name")).alias("name"))
    return files.expected_files(found, ["src0.txt", "src1.txt", "src2.txt", "_SUCCESS"])


# Sinks

@query("sink_append", oracle("device_id n:i", "SELECT device_id, count(*) AS n FROM telemetry GROUP BY 1", "telemetry"))
def _(spark, sf):
    path, rows = shared_dir(spark, "append"), src.telemetry(spark, sf)
    tables.append(rows.where("event_id % 2 = 0"), path)
    tables.append(rows.where("event_id % 2 = 1"), path)
    return counts(spark.read.schema(schemas.TELEMETRY).parquet(path), "device_id")


@query("sink_replace_partitions", oracle("severity n:i", """
    SELECT severity, count(*) AS n FROM scored WHERE severity <> 'WARNING' OR event_id % 2 = 0 GROUP BY 1""", "scored"))
def _(spark, sf):
    path, rows = shared_dir(spark, "replace"), src.scored(spark, sf).select("event_id", "anomaly_score", "severity")
    tables.replace_partitions(rows, path, ["severity"])
    tables.replace_partitions(rows.where("severity = 'WARNING' AND event_id % 2 = 0"), path, ["severity"])
    return counts(spark.read.schema("event_id bigint, anomaly_score int, severity string").parquet(path), "severity")


@query("layout_daily", oracle("dt:d n:i", """
    SELECT CAST(event_time AS DATE) AS dt, count(*) AS n FROM telemetry WHERE event_time >= TIMESTAMP '2024-01-10'
    GROUP BY 1""", "telemetry"))
def _(spark, sf):
    path = shared_dir(spark, "daily")
    tables.write_daily(src.telemetry(spark, sf), path, "event_time", ["device_id"])
    rows = spark.read.schema(f"{schemas.TELEMETRY}, dt date").parquet(path)
    return counts(rows.where("dt >= DATE '2024-01-10'"), "dt")


@query("sink_serving", oracle("device_id n:i", "SELECT device_id, count(*) AS n FROM telemetry GROUP BY 1", "telemetry"))
def _(spark, sf):
    path = shared_dir(spark, "serving")
    tables.load_serving(src.telemetry(spark, sf), path)
    return counts(spark.read.schema(schemas.TELEMETRY).parquet(path), "device_id")


@query("sink_truncate_load", oracle("device_id status", "SELECT device_id, status FROM device_latest", "device_latest"))
def _(spark, sf):
    path, rows = shared_dir(spark, "dimension"), src.devices(spark, sf)
    tables.truncate_and_load(rows, path)
    tables.truncate_and_load(staged_devices(spark, sf).select(*rows.columns), path)
    return spark.read.schema(schemas.DEVICES).parquet(path).select("device_id", "status")


@query("session_archive", oracle("session_id n_messages:i", """
    SELECT session_id, count(*) AS n_messages FROM messages GROUP BY 1""", "messages"))
def _(spark, sf):
    path = shared_dir(spark, "archive")
    tables.write_session_archive(sessions.session_documents(src.messages(spark, sf)), path)
    archived = "session_id string, messages array<struct<turn:bigint,role:string,content:string>>"
    rows = spark.read.schema(archived).json(path)
    return rows.select("session_id", F.size("messages").alias("n_messages"))


@query("incremental_mart", oracle("device_id dt:d n:i", """
    SELECT device_id, CAST(event_time AS DATE) AS dt, count(*) AS n FROM telemetry GROUP BY ALL""", "telemetry"))
def _(spark, sf):
    """A mart built without two days' late rows, then brought up to date for those days only."""
    path, rows = shared_dir(spark, "mart"), src.telemetry(spark, sf)

    def build(part):
        return part.groupBy("device_id", F.to_date("event_time").alias("dt")).agg(F.count(F.lit(1)).alias("n"))

    changed = rows.where("to_date(event_time) IN (DATE '2024-01-05', DATE '2024-01-20')").select(
        F.to_date("event_time").alias("dt")).distinct()
    known = rows.where("event_id % 2 = 0 OR to_date(event_time) NOT IN (DATE '2024-01-05', DATE '2024-01-20')")
    tables.replace_partitions(build(known), path, ["dt"])
    tables.rebuild_days(rows, changed, build, path, "event_time")
    return spark.read.schema("device_id string, n bigint, dt date").parquet(path)


@query("layout_clustered", oracle("day:d device_id n:i", """
    SELECT CAST(event_time AS DATE) AS day, device_id, count(*) AS n FROM telemetry
    WHERE device_id < 'DEV-0050' AND hour(event_time) < 6 GROUP BY ALL""", "telemetry"))
def _(spark, sf):
    path = shared_dir(spark, "clustered")
    tables.write_clustered(src.telemetry(spark, sf), path, "event_time", "device_id", rows_per_file=2_000)
    rows = spark.read.schema(f"{schemas.TELEMETRY}, dt date").parquet(path)
    found = rows.where("device_id < 'DEV-0050' AND hour(event_time) < 6")
    return found.groupBy(F.col("dt").alias("day"), "device_id").agg(F.count(F.lit(1)).alias("n"))


@query("ledger_mart", oracle("device_id dt:d n:i temperature:r", """
    SELECT device_id, CAST(event_time AS DATE) AS dt, count(*) AS n, sum(temperature) AS temperature FROM telemetry
    GROUP BY ALL""", "telemetry"))
def _(spark, sf):
    """Three appends, each followed by a run that reads the new files only, and a run that finds none."""
    arrived, mart, rows = shared_dir(spark, "arrived"), shared_dir(spark, "ledger"), src.telemetry(spark, sf)
    ledger = Ledger(spark, mart)

    def read(paths):
        return spark.read.schema(schemas.TELEMETRY).parquet(*paths)

    def build(new):
        return new.groupBy("device_id", F.to_date("event_time").alias("dt")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("temperature").alias("temperature"))

    for part in range(3):
        tables.append(rows.where(f"event_id % 3 = {part}"), arrived)
        ledger.take(arrived, read, build)
    ledger.take(arrived, read, build)
    return ledger.total("device_id string, dt date, n bigint, temperature double", ["device_id", "dt"],
                        {"n": F.sum("n"), "temperature": F.sum("temperature")})


@query("distinct_sketches", oracle("name distinct_values:i within:b", """
    SELECT 'device_id' AS name, count(DISTINCT device_id) AS distinct_values, TRUE AS within FROM telemetry
    UNION ALL SELECT 'event_id', count(DISTINCT event_id), TRUE FROM telemetry
    UNION ALL SELECT 'temperature', count(DISTINCT temperature), TRUE FROM telemetry""", "telemetry"))
def _(spark, sf):
    """Sketches of the days before and after the fifteenth, stored apart; the estimates come from the stored sketches only."""
    path, rows = shared_dir(spark, "sketches"), src.telemetry(spark, sf).withColumn("dt", F.to_date("event_time"))
    names = ["device_id", "event_id", "temperature"]
    for part in ("dt <= DATE '2024-01-15'", "dt > DATE '2024-01-15'"):
        tables.append(sketches.daily_sketches(rows.where(part), "dt", names), path, partition_by=["dt"])
    estimates = sketches.distinct_estimates(spark.read.schema("name string, sketch binary, dt date").parquet(path))
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in names]).select(F.inline(F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).alias("distinct_values")) for c in names])))
    near = F.abs(F.col("estimate") - F.col("distinct_values")) <= F.col("distinct_values") * (3 * sketches.STANDARD_ERROR) + 1
    return exact.join(estimates, "name").select("name", "distinct_values", near.alias("within"))


# Streams

@query("src_stream", oracle(BASIC_SQL, "SELECT * FROM telemetry", "telemetry"))
def _(spark, sf):
    path = shared_dir(spark, "stream")
    st.run_available(st.parsed(st.file_lines(spark, staged(spark, sf))), path, f"{path}-ckpt")
    return spark.read.schema(schemas.TELEMETRY).parquet(path).select(*BASIC)


@query("event_time_watermark", oracle("hour:t n:i", """
    SELECT hour, n FROM (SELECT date_trunc('hour', event_time) AS hour, count(*) AS n FROM telemetry GROUP BY 1)
    WHERE hour + INTERVAL 1 HOUR <= (SELECT max(event_time) - INTERVAL 10 SECOND FROM telemetry)""", "telemetry"))
def _(spark, sf):
    path = shared_dir(spark, "watermark")
    stream = st.with_watermark(st.parsed(st.file_lines(spark, staged(spark, sf))))
    hours = stream.groupBy(F.window("event_time", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("hour"), "n")
    st.run_available(hours, path, f"{path}-ckpt")
    return spark.read.schema("hour timestamp, n bigint").parquet(path)


WINDOWS = ("window_start timestamp, window_end timestamp, device_id string, event_count bigint, avg_temperature double, "
           "max_vibration double, avg_pressure double, avg_humidity double, avg_power_usage double, avg_rpm double, dt string")


def minute_stream(spark, sf, runs: int = 1):
    path, lines = shared_dir(spark, "minutes"), staged(spark, sf)
    for _ in range(runs):
        st.run_available(st.minute_aggregates(st.parsed(st.file_lines(spark, lines))), path, f"{path}-ckpt")
    return spark.read.schema(WINDOWS).parquet(path)


CLOSED_MINUTES = oracle(MINUTE, f"SELECT * FROM ({MINUTES}) WHERE {CLOSED}", "telemetry")


@query("stream_minute_agg", CLOSED_MINUTES)
def _(spark, sf):
    return minute_stream(spark, sf)


@query("checkpointed_query", CLOSED_MINUTES)
def _(spark, sf):
    # The second run starts from the checkpoint of the first and has nothing to add.
    return minute_stream(spark, sf, runs=2)


@query("replay", CLOSED_MINUTES)
def _(spark, sf):
    # A fresh checkpoint reads from the earliest message again and gives the same windows.
    minute_stream(spark, sf)
    return minute_stream(spark, sf)


@query("late_rows", oracle("dropped:i", """
    SELECT count(DISTINCT date_trunc('minute', event_time)) AS dropped FROM telemetry WHERE event_id % 10 = 0
        AND date_trunc('minute', event_time) + INTERVAL 1 MINUTE <= (
            SELECT max(event_time) - INTERVAL 10 SECOND FROM telemetry WHERE event_id % 10 <> 0)""", "telemetry"))
def _(spark, sf):
    """Every tenth reading arrives after all the others; those behind the watermark are dropped.

    The engine counts what it drops after the partial aggregate: one per late window.
    """
    path, lines = shared_dir(spark, "late"), shared_dir(spark, "late-lines")
    rows = src.telemetry(spark, sf)
    with watch.totals(spark) as heard:
        for part in ("event_id % 10 <> 0", "event_id % 10 = 0"):
            files.telemetry_json(rows.where(part)).write.mode("append").text(lines)
            counted = st.with_watermark(st.parsed(st.file_lines(spark, lines))).groupBy(
                F.window("event_time", "1 minute")).agg(F.count(F.lit(1)).alias("n")).select("window.start", "n")
            query_run = st.run_available(counted, path, f"{path}-ckpt")
            heard.wait(query_run)
        dropped = heard.late[query_run.id]
    return spark.range(1).select(F.lit(dropped).cast("bigint").alias("dropped"))


@query("sink_foreach_batch", oracle("sink n:i", """
    SELECT 'lake' AS sink, count(*) AS n FROM telemetry UNION ALL
    SELECT 'serving', count(*) FROM telemetry WHERE error_code IS NOT NULL""", "telemetry"))
def _(spark, sf):
    lake, serving = shared_dir(spark, "lake"), shared_dir(spark, "served")
    handler = st.two_sinks(lake, serving, lambda b: b.where("error_code IS NOT NULL"))
    st.for_each_batch(st.parsed(st.file_lines(spark, staged(spark, sf), 3)), f"{lake}-ckpt", handler)
    parts = [spark.read.parquet(p).select(F.lit(n).alias("sink")) for n, p in (("lake", lake), ("serving", serving))]
    return counts(reduce(DataFrame.unionByName, parts), "sink")


@query("fanout_one_read", oracle("sink dt n:i", """
    SELECT 'raw' AS sink, strftime(event_time, '%Y-%m-%d') AS dt, count(*) AS n FROM telemetry GROUP BY ALL
    UNION ALL SELECT 'scored', strftime(event_time, '%Y-%m-%d'), count(*) FROM scored WHERE severity <> 'NORMAL'
    GROUP BY ALL""", "scored"))
def _(spark, sf):
    raw, flagged = shared_dir(spark, "raw"), shared_dir(spark, "flagged")
    handler = st.two_sinks(raw, flagged, lambda b: b.where(scoring.anomaly_score() >= 30))
    st.for_each_batch(st.parsed(st.file_lines(spark, staged(spark, sf))), f"{raw}-ckpt", handler)
    parts = [spark.read.parquet(p).select(F.lit(n).alias("sink"), F.date_format("event_time", "yyyy-MM-dd").alias("dt"))
             for n, p in (("raw", raw), ("scored", flagged))]
    return counts(reduce(DataFrame.unionByName, parts), "sink", "dt")


@query("sink_json_by_day", oracle("dt n:i", """
    SELECT strftime(event_time, '%Y-%m-%d') AS dt, count(*) AS n FROM telemetry GROUP BY 1""", "telemetry"))
def _(spark, sf):
    path = shared_dir(spark, "json-days")
    stream = st.parsed(st.file_lines(spark, staged(spark, sf)))
    stream = stream.withColumn("dt", F.date_format("event_time", "yyyy-MM-dd"))
    st.run_available(stream, path, f"{path}-ckpt", fmt="json", partition_by=["dt"])
    return counts(spark.read.schema(f"{schemas.TELEMETRY}, dt string").json(path), "dt")


@query("micro_batch_rollup", oracle("n:i", "SELECT count(*) AS n FROM telemetry", "telemetry"))
def _(spark, sf):
    # Each micro-batch of several files is rolled into files of the advisory size.
    path = shared_dir(spark, "rolled")
    stream = st.parsed(st.file_lines(spark, staged(spark, sf), 4))
    st.for_each_batch(stream, f"{path}-ckpt", lambda batch, i: st.one_sink(path)(batch.hint("rebalance"), i))
    return spark.read.schema(schemas.TELEMETRY).parquet(path).agg(F.count(F.lit(1)).alias("n"))


def upload_events(spark, sf):
    return src.table(spark, sf, "events").select(
        "event_type", F.concat(F.lit("doc-"), (F.col("event_id") % 500).cast("string")).alias("document_id"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user"),
        F.concat(F.lit("file-"), F.col("event_id").cast("string")).alias("filename"))


@query("fan_out_consumers", oracle("consumer item n:i", """
    SELECT 'analytics' AS consumer, event_type AS item, count(*) AS n FROM events GROUP BY ALL
    UNION ALL SELECT DISTINCT 'ingestion', 'doc-' || CAST(event_id % 500 AS VARCHAR), 1 FROM events
    UNION ALL SELECT 'notification', 'user-' || CAST(user_id AS VARCHAR) || ' uploaded file-' || CAST(event_id AS VARCHAR), 1
    FROM events"""))
def _(spark, sf):
    views = st.consumers(upload_events(spark, sf))
    one = F.lit(1).cast("bigint").alias("n")
    return views["analytics"].select(F.lit("analytics").alias("consumer"), F.col("event_type").alias("item"),
                                     F.col("events").alias("n")).unionByName(
        views["ingestion"].select(F.lit("ingestion").alias("consumer"), F.col("document_id").alias("item"), one)
    ).unionByName(views["notification"].select(F.lit("notification").alias("consumer"), F.col("message").alias("item"), one))


@query("dead_letter", oracle("job_id outcome attempt:i", """
    SELECT event_id AS job_id, CASE WHEN event_type <> 'error' THEN 'ok' WHEN event_id % 4 < 3 THEN 'retry' ELSE 'dead' END
        AS outcome, event_id % 4 + CASE WHEN event_type = 'error' AND event_id % 4 < 3 THEN 1 ELSE 0 END AS attempt
    FROM events"""))
def _(spark, sf):
    tasks = src.table(spark, sf, "events").select(
        F.col("event_id").alias("job_id"), "event_type", (F.col("event_id") % 4).alias("attempt"))
    return st.route_attempts(tasks, F.col("event_type") == "error").select("job_id", "outcome", "attempt")


@query("log_lines", oracle("service level n:i last:t", """
    SELECT endpoint AS service, CASE WHEN failed THEN 'ERROR' ELSE 'INFO' END AS level, count(*) AS n, max(ts) AS last
    FROM requests WHERE request_id % 20 <> 0 GROUP BY ALL""", "requests"))
def _(spark, sf):
    line = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"), F.col("endpoint").alias("service"),
        F.when(F.col("failed"), "ERROR").otherwise("INFO").alias("level"), F.col("status").alias("message")))
    lines = src.requests(spark, sf).select(
        F.when(F.col("request_id") % 20 == 0, F.lit("not json")).otherwise(line).alias("value"))
    return st.log_lines(lines).groupBy("service", "level").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_time").alias("last"))


@query("session_state", oracle("session_id messages:i first_turn:i last_turn:i", """
    SELECT session_id, least(count(*), 3) AS messages, greatest(max(turn) - 2, min(turn)) AS first_turn,
           max(turn) AS last_turn FROM messages GROUP BY 1""", "messages"))
def _(spark, sf):
    lines, path = shared_dir(spark, "chat"), shared_dir(spark, "history")
    kind = "session_id string, turn bigint, role string, content string, created_at timestamp"
    src.messages(spark, sf).select("session_id", "turn", "role", "content", "created_at").write.json(lines)
    history = st.session_history(spark.readStream.schema(kind).json(lines), keep=3)
    st.for_each_batch(history, f"{path}-ckpt", st.one_sink(path), mode="update")
    rows = spark.read.schema(
        "session_id string, messages bigint, first_turn bigint, last_turn bigint, batch_id bigint").parquet(path)
    newest = rows.groupBy("session_id").agg(F.max_by(F.struct("messages", "first_turn", "last_turn"), "batch_id").alias("r"))
    return newest.select("session_id", "r.*")


@query("stream_threshold_alerts", oracle("alert_id device_id severity timestamp:t", "SELECT * FROM alerts", "alerts"))
def _(spark, sf):
    path = shared_dir(spark, "stream-alerts")
    alerts = st.threshold_alerts(st.parsed(st.file_lines(spark, staged(spark, sf))), AS_OF)
    st.run_available(alerts, path, f"{path}-ckpt")
    kind = "alert_id string, device_id string, severity string, timestamp timestamp"
    return spark.read.schema(kind).parquet(path)


@query("enrich_stream", oracle("event_id manufacturer zone status maintenance_due:i", """
    SELECT event_id, manufacturer, zone, status, maintenance_due FROM telemetry t LEFT JOIN dim d ON d.device_id = t.device_id
    """, "telemetry", "dim"))
def _(spark, sf):
    path, dim_path = shared_dir(spark, "enriched"), shared_dir(spark, "dim")
    dimension(spark, sf).write.parquet(dim_path)
    enriched = st.enrich(st.parsed(st.file_lines(spark, staged(spark, sf))), spark.read.parquet(dim_path))
    st.run_available(enriched.select("event_id", "manufacturer", "zone", "status", "maintenance_due"), path, f"{path}-ckpt")
    kind = "event_id bigint, manufacturer string, zone string, status string, maintenance_due int"
    return spark.read.schema(kind).parquet(path)
